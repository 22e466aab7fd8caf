"""Publication tables to triples: a raw layer of all cells, and a semantic layer."""

from __future__ import annotations

import re
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from loomgraph.functions.identifiers import csv_doi, first_of, http_iri, joined, named_iri, orcid, person_iri
from loomgraph.functions.nt import strip
from loomgraph.functions.text import schema_type
from loomgraph.operators.graph import DCTERMS, RDF_TYPE, XSD, emitted, schema, triple

#: Licence codes and their addresses.
LICENSES = {
    "cc_0_1_0": "https://creativecommons.org/publicdomain/zero/1.0/",
    "cc_by_4_0": "https://creativecommons.org/licenses/by/4.0/",
    "cc_by_sa_4_0": "https://creativecommons.org/licenses/by-sa/4.0/",
    "cc_by_nd_4_0": "https://creativecommons.org/licenses/by-nd/4.0/",
    "cc_by_nc_4_0": "https://creativecommons.org/licenses/by-nc/4.0/",
    "cc_by_nc_sa_4_0": "https://creativecommons.org/licenses/by-nc-sa/4.0/",
    "cc_by_nc_nd_4_0": "https://creativecommons.org/licenses/by-nc-nd/4.0/",
    "cc_by_nc_sa_3_0": "https://creativecommons.org/licenses/by-nc-sa/3.0/",
    "cc_by_nc_nd_3_0": "https://creativecommons.org/licenses/by-nc-nd/3.0/",
    "cc_by_sa_3_0": "https://creativecommons.org/licenses/by-sa/3.0/",
    "cc_by_3_0": "https://creativecommons.org/licenses/by/3.0/",
}
PERSON = T.ArrayType(T.StructType([T.StructField("name", T.StringType()), T.StructField("meta", T.MapType(T.StringType(), T.StringType()))]))


def listed(x: Column) -> Column:
    """The trimmed, non-empty parts of a semicolon list."""
    return F.filter(F.transform(F.split(x, ";"), strip), lambda p: p != "")


def identifiers(x: Column) -> Column:
    """(typ, val) of each ``TYPE: value`` of a semicolon list, the type in capitals; parts of another form are UNKNOWN."""
    form = r"^([A-Za-z0-9_-]+)(?U:\s*):(?U:\s*)(\S.*)$"
    typed = lambda p: p.rlike(form)
    return F.transform(listed(x), lambda p: F.struct(F.when(typed(p), F.upper(F.regexp_extract(p, form, 1))).otherwise("UNKNOWN").alias("typ"), F.when(typed(p), strip(F.regexp_extract(p, form, 2))).otherwise(p).alias("val")))


_REMARK = re.compile(r"([A-Za-z0-9_-]+)\s*:\s*(\S.*)")


def person_cell(cell: str) -> list[dict]:
    """Persons ``Name (key: value, ...)`` of a semicolon list. The remarks begin at the first bracket after the name and
    end with the part; one that has no key and value is token_N, N its place among the keys. Parts with line breaks are
    no persons."""
    out = []
    for part in (p.strip() for p in cell.split(";")):
        if not part or "\n" in part:
            continue
        opening = part.find("(", 1) if part.endswith(")") else -1
        meta: dict[str, str] = {}
        if 0 < opening < len(part) - 2:
            for remark in filter(None, map(str.strip, part[opening + 1 : -1].split(","))):
                m = _REMARK.fullmatch(remark)
                meta[m[1] if m else f"token_{len(meta) + 1}"] = m[2] if m else remark
            part = part[:opening]
        out.append({"name": part.strip(), "meta": meta})
    return out


@pandas_udf(PERSON)
def persons(x: pd.Series) -> pd.Series:
    return x.map(lambda t: person_cell(t or ""))


def raw_layer(rows: DataFrame, base: str) -> DataFrame:
    """A triple for each non-empty cell of publications (id and any columns)."""
    pub = joined(base, F.concat(F.lit("id/publication/ris/"), F.trim("id")))

    def cell(c: str) -> list[Column]:
        v = strip(F.col(f"`{c}`"))
        kind = F.lit(None).cast("string")
        if c == "jahr":
            kind = F.when(v.rlike("^[0-9]{4}$"), XSD + "gYear")
        elif c in ("seitenbereichvon", "seitenbereichbis", "seitenanzahl"):
            kind = F.when(v.rlike("^[+-]?[0-9]+$"), XSD + "integer")
        elif c == "zugriffsbeschraenktbis":
            kind = F.when(v.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.try_to_date(v, "yyyy-MM-dd").isNotNull(), XSD + "date")
        t = triple(pub, joined(base, F.lit(f"vocab/csv/{c}")), v)
        return [F.when(t.isNotNull(), F.struct(t["s"].alias("s"), t["p"].alias("p"), t["o"].alias("o"), t["o_kind"].alias("o_kind"), t["o_lang"].alias("o_lang"), kind.alias("o_dt")))]

    return emitted(rows.where(F.coalesce(F.trim("id"), F.lit("")) != ""), *(x for c in rows.columns for x in cell(c)))


def semantic_layer(rows: DataFrame, base: str) -> DataFrame:
    """The schema.org triples of publications with the columns of the publication export; a bag."""
    col = lambda c: strip(F.coalesce(F.col(c) if c in rows.columns else F.lit(None).cast("string"), F.lit("")))
    pub = joined(base, F.concat(F.lit("id/publication/ris/"), F.trim("id")))
    lang = F.lower(F.get(listed(col("sprachen")), F.lit(0)))
    some = lambda c: F.when(c != "", c)
    journal = F.when(col("fachzeitschrift") != "", named_iri(base, "periodical", col("fachzeitschrift")))
    publisher = F.when(col("verlag") != "", named_iri(base, "org", col("verlag")))
    peer = F.lower(col("peerreviewed"))
    embargo = col("zugriffsbeschraenktbis")
    licence = F.try_element_at(F.create_map(*(F.lit(x) for kv in LICENSES.items() for x in kv)), F.lower(col("lizenz")))
    link = lambda s, p, x: F.coalesce(F.when(http_iri(x), triple(s, p, x, "iri")), triple(s, p, x))
    each = F.flatten(
        F.transform(
            identifiers(col("identifier")),
            lambda i: F.array(
                triple(pub, schema("identifier"), F.concat(i["typ"], F.lit(":"), i["val"])),
                F.when(i["typ"] == "DOI", link(pub, schema("sameAs"), F.concat(F.lit("https://doi.org/"), csv_doi(i["val"])))),
                F.when(i["typ"] == "URL", link(pub, schema("url"), i["val"])),
                F.when((i["typ"] == "ISSN") & journal.isNotNull(), triple(journal, schema("issn"), strip(i["val"]))),
                F.when(i["typ"] == "ISBN", triple(pub, schema("isbn"), strip(i["val"]))),
            ),
        )
    )
    text = lambda p, c, tag=None: triple(pub, p, some(c), lang=tag)
    return emitted(
        rows.where(F.coalesce(F.trim("id"), F.lit("")) != ""),
        triple(pub, RDF_TYPE, F.concat(F.lit(schema("")), schema_type(col("publikationstyp"), col("dokumententyp"))), "iri"),
        triple(pub, schema("identifier"), F.trim("id")),
        text(schema("name"), col("titel"), lang),
        text(schema("alternateName"), col("untertitel"), lang),
        triple(pub, schema("datePublished"), F.when(col("jahr").rlike("^[0-9]{4}$"), col("jahr")), datatype=XSD + "gYear"),
        text(schema("abstract"), col("zusammenfassung"), lang),
        text(schema("abstract"), col("DEzusammenfassung"), F.lit("de")),
        text(schema("abstract"), col("ENzusammenfassung"), F.lit("en")),
        triple(journal, RDF_TYPE, F.lit(schema("Periodical")), "iri"),
        triple(journal, schema("name"), col("fachzeitschrift")),
        triple(pub, schema("isPartOf"), journal, "iri"),
        triple(publisher, RDF_TYPE, F.lit(schema("Organization")), "iri"),
        triple(publisher, schema("name"), col("verlag")),
        triple(publisher, schema("location"), some(col("verlagsort"))),
        triple(pub, schema("publisher"), publisher, "iri"),
        text(schema("volumeNumber"), col("band")),
        text(schema("issueNumber"), col("heft")),
        text(schema("pageStart"), col("seitenbereichvon")),
        text(schema("pageEnd"), col("seitenbereichbis")),
        triple(pub, schema("numberOfPages"), F.when(col("seitenanzahl").rlike("^[+-]?[0-9]+$"), col("seitenanzahl")), datatype=XSD + "integer"),
        triple(pub, joined(base, "vocab/peerReviewed"), F.when(peer.isin("ja", "yes", "true"), "true").when(peer.isin("nein", "no", "false"), "false"), datatype=XSD + "boolean"),
        text(DCTERMS + "accessRights", col("zugangsrecht")),
        triple(pub, joined(base, "vocab/embargoUntil"), F.when(embargo.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & F.try_to_date(embargo, "yyyy-MM-dd").isNotNull(), embargo), datatype=XSD + "date"),
        F.coalesce(triple(pub, DCTERMS + "license", licence, "iri"), text(DCTERMS + "license", col("lizenz"))),
        text(joined(base, "vocab/publicationType"), col("publikationstyp")),
        text(joined(base, "vocab/documentType"), col("dokumententyp")),
        lists=(F.transform(listed(col("sprachen")), lambda x: triple(pub, schema("inLanguage"), F.lower(x))), F.transform(listed(col("keywords")), lambda x: triple(pub, schema("keywords"), x, lang=lang)), each),
    )


def publication_triples(rows: DataFrame, base: str, raw: bool = True, semantic: bool = True, limit: int = 0) -> DataFrame:
    """Both layers of publications and their persons, or one of the layers; of the first rows only if a limit is given."""
    if not base.startswith("http"):
        raise ValueError(f"not an http(s) base: {base!r}")
    rows = rows.limit(limit) if limit else rows
    layers = [raw_layer(rows, base)] if raw else []
    if semantic:
        layers.append(semantic_layer(rows, base))
        layers += [contributors(rows, base, column, role) for column, role in (("autoren", "author"), ("herausgeber", "editor")) if column in rows.columns]
    if not layers:
        raise ValueError("no layer asked for")
    return reduce(DataFrame.unionByName, layers)


def contributors(rows: DataFrame, base: str, column: str, predicate: str) -> DataFrame:
    """Person triples of a person cell, and the link of the publication to each: authors and editors alike."""
    pub = joined(base, F.concat(F.lit("id/publication/ris/"), F.trim("id")))
    each = rows.where(F.coalesce(F.trim("id"), F.lit("")) != "").select(pub.alias("pub"), F.explode(persons(F.col(column))).alias("x")).withColumn("who", person_iri(base, F.col("x.name"), F.col("x.meta")))
    meta, who = F.col("x.meta"), F.col("who")
    uni = F.try_element_at(meta, F.lit("UNI-ID"))
    oid = orcid(first_of(meta, "orcid", "ORCID"))
    rest = F.filter(F.map_entries(meta), lambda e: ~e["key"].isin("UNI-ID", "orcid", "ORCID"))
    return emitted(
        each,
        triple(who, RDF_TYPE, F.lit(schema("Person")), "iri"),
        triple(who, schema("name"), F.col("x.name")),
        triple(who, joined(base, "vocab/uniId"), F.when(F.upper(uni) != "NA", uni)),
        triple(who, schema("sameAs"), F.concat(F.lit("https://orcid.org/"), oid), "iri"),
        triple(F.col("pub"), schema(predicate), who, "iri"),
        lists=(F.transform(rest, lambda e: triple(who, joined(F.lit(base), F.concat(F.lit("vocab/personMeta/"), e["key"])), e["value"])),),
    )
