"""Enrichment from cached records: newest copies, author resolution, authorship and geography triples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from loomgraph.functions.identifiers import affiliation_iri, openalex_institution
from loomgraph.functions.payloads import INSTITUTION, institution_places
from loomgraph.operators.graph import RDF_TYPE, XSD, emitted, schema, triple


def newest(rows: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The last row of each key by an order that must be total."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")).select(*keys, "_row.*")


def upserted(store: DataFrame, new: DataFrame) -> DataFrame:
    """A key-value table (k, v, t) with newer values of new; on equal times new ones win."""
    both = store.withColumn("_n", F.lit(0)).unionByName(new.withColumn("_n", F.lit(1)))
    return newest(both, ["k"], "t", "_n", "v").drop("_n").select("k", "v", "t")


def looked_up(rows: DataFrame, variants: Column, cache: DataFrame) -> DataFrame:
    """rows (with id) and v, the cached value of the first key variant that the cache has."""
    keys = rows.select("id", F.posexplode(variants).alias("_i", "k")).join(cache.select("k", "v"), "k")
    return rows.join(keys.groupBy("id").agg(F.min_by("v", "_i").alias("v")), "id", "left")


def matched_titles(titles: DataFrame, works: DataFrame) -> DataFrame:
    """titles (id, key) with state and work: matched if one work has the key, ambiguous if several, else not_found."""
    one = works.where("key <> ''").groupBy("key").agg(F.count_distinct("work").alias("n"), F.min("work").alias("work"))
    state = F.when(F.col("n") == 1, "matched").when(F.col("n") > 1, "ambiguous").otherwise("not_found")
    return titles.join(one, "key", "left").select("id", state.alias("state"), F.when(F.col("n") == 1, F.col("work")).alias("work"))


def resolved_authors(candidates: DataFrame) -> DataFrame:
    """paper, author, person, method of candidates (paper, author, person, method, tier): the lowest tier of an author
    counts; accepted is one person for the author, proposed by that author of the paper alone."""
    low = F.min("tier").over(Window.partitionBy("paper", "author"))
    best = candidates.where("person is not null").distinct().withColumn("_low", low).where("tier = _low").drop("_low")
    mine, rivals = F.count("*").over(Window.partitionBy("paper", "author")), F.count("*").over(Window.partitionBy("paper", "person"))
    return best.select("paper", "author", "person", "method", mine.alias("_m"), rivals.alias("_r")).where("_m = 1 and _r = 1").drop("_m", "_r")


VOCAB = "https://loomgraph.example/vocab/"
PROVENANCE = "http://www.w3.org/ns/prov#wasDerivedFrom"


def authorships(works: DataFrame, base: str, mapped_only: bool = False) -> DataFrame:
    """Reified authorships of works (paper, work, date, year, authorships array of author, person, name, position,
    corresponding, affiliations array of string, institutions array of id, ror, name); a set of triples.

    person is the local identity of the author, if known. The order of an author is its place from 1.
    """
    each = works.select("paper", "work", "date", "year", F.posexplode("authorships").alias("_i", "a"))
    each = each.where("a.person is not null") if mapped_only else each
    person = F.coalesce("a.person", "a.author")
    last = lambda c: F.regexp_extract(F.regexp_replace(c, "/+$", ""), "([^/]*)$", 1)
    each = each.withColumn("_p", person).withColumn("_n", F.concat(F.regexp_replace("paper", "/+$", ""), F.lit("/authorship/"), F.coalesce(last(F.col("_p")), F.concat(F.lit("position-"), F.col("_i") + 1))))
    n, p, paper = F.col("_n"), F.col("_p"), F.col("paper")
    ror = lambda x: F.when(x["ror"].isNotNull(), F.concat(F.lit(base + "/ror/"), last(x["ror"]))).otherwise(x["id"])
    institutions = F.flatten(
        F.transform(
            F.coalesce("a.institutions", F.array().cast("array<struct<id:string,ror:string,name:string>>")),
            lambda x: F.array(
                triple(n, VOCAB + "affiliation", ror(x), "iri"),
                triple(ror(x), RDF_TYPE, F.lit(schema("Organization")), "iri"),
                F.when(x["ror"] != ror(x), triple(ror(x), schema("sameAs"), x["ror"], "iri")),
                F.when(x["id"] != ror(x), triple(ror(x), schema("sameAs"), x["id"], "iri")),
                triple(ror(x), schema("name"), x["name"]),
            ),
        )
    )
    raw = F.transform(F.coalesce(F.array_distinct("a.affiliations"), F.array().cast("array<string>")), lambda x: triple(n, VOCAB + "rawAffiliation", x))
    return emitted(
        each,
        triple(paper, PROVENANCE, F.col("work"), "iri"),
        triple(paper, VOCAB + "authorship", n, "iri"),
        triple(n, RDF_TYPE, F.lit(VOCAB + "Authorship"), "iri"),
        triple(n, VOCAB + "paper", paper, "iri"),
        triple(n, PROVENANCE, F.col("work"), "iri"),
        triple(n, VOCAB + "author", p, "iri"),
        triple(paper, schema("author"), p, "iri"),
        triple(p, RDF_TYPE, F.lit(schema("Person")), "iri"),
        triple(p, schema("name"), F.col("a.name")),
        triple(n, VOCAB + "authorOrder", F.col("_i") + 1, datatype=XSD + "integer"),
        triple(n, VOCAB + "authorPosition", F.col("a.position")),
        triple(n, VOCAB + "isCorresponding", F.col("a.corresponding").cast("string"), datatype=XSD + "boolean"),
        triple(n, VOCAB + "sourcePublicationDate", F.col("date"), datatype=XSD + "date"),
        triple(n, VOCAB + "sourcePublicationYear", F.col("year"), datatype=XSD + "gYear"),
        lists=(raw, institutions),
    ).distinct()


def geography(orgs: DataFrame) -> DataFrame:
    """Geography triples of organisations (org, city, country, code, continent, latitude, longitude)."""
    org, code = F.col("org"), F.upper(F.trim("code"))
    blank = lambda c: F.when(F.trim(c) != "", F.trim(c))
    return emitted(
        orgs,
        triple(org, schema("addressLocality"), blank("city")),
        triple(org, schema("addressCountry"), F.coalesce(blank("country"), F.when(code != "", code))),
        triple(org, schema("continent"), blank("continent")),
        triple(org, schema("latitude"), F.col("latitude").cast("string"), datatype=XSD + "double"),
        triple(org, schema("longitude"), F.col("longitude").cast("string"), datatype=XSD + "double"),
    )


def missing_institutions(orgs: DataFrame) -> DataFrame:
    """What geography() says, and the country code as a second country, type, name (else fallback) and sameAs of aliases, id and ror without
    the organisation itself; orgs also has name, fallback, aliases, id, ror."""
    org = F.col("org")
    same = F.array_except(F.array_union(F.coalesce("aliases", F.array().cast("array<string>")), F.array_compact(F.array("id", "ror"))), F.array("org", F.lit("")))
    own = emitted(
        orgs,
        triple(org, schema("addressCountry"), F.when(F.trim("code") != "", F.upper(F.trim("code")))),
        triple(org, RDF_TYPE, F.lit(schema("Organization")), "iri"),
        triple(org, schema("name"), F.coalesce(F.when(F.col("name") != "", F.col("name")), F.when(F.col("fallback") != "", F.col("fallback")))),
        lists=(F.transform(same, lambda x: triple(org, schema("sameAs"), x, "iri")),),
    )
    return own.unionByName(geography(orgs)).distinct()


def affiliations(rows: DataFrame, base: str) -> DataFrame:
    """Triples of persons' organisations (person, id, ror, name, code), a set: the organisation is named by ROR, else by
    identifier, else by the hash of name and country; what does not name it is a sameAs."""
    some = lambda c: F.when(F.trim(c) != "", F.trim(c))
    d = rows.withColumn("_org", affiliation_iri(base, F.col("ror"), F.col("id"), F.col("name"), F.col("code")))
    org = F.col("_org")
    return emitted(
        d,
        triple(F.col("person"), schema("affiliation"), org, "iri"),
        triple(org, RDF_TYPE, F.lit(schema("Organization")), "iri"),
        triple(org, schema("name"), some("name")),
        triple(org, schema("addressCountry"), some("code")),
        *(triple(org, schema("sameAs"), F.when(some(c) != org, some(c)), "iri") for c in ("id", "ror")),
    ).distinct()


def institution_records(rows: DataFrame, cache: DataFrame) -> DataFrame:
    """rows (institution, name, aliases, openalex_id) with status and inst (see functions.payloads.INSTITUTION) from
    cached payloads (k institution, v JSON). A payload is ``{status, openalex_sameas, institution}`` or an institution
    itself; one made for another identifier counts as a miss; an ok without an institution raises when it is read."""
    v = F.col("v")
    cached = openalex_institution(F.get_json_object(v, "$.openalex_sameas"))
    other = F.coalesce((F.col("openalex_id") != "") & (cached != F.col("openalex_id")), F.lit(False))
    met = rows.join(cache.select(F.col("k").alias("institution"), "v"), "institution", "left").withColumn("v", F.when(~other, v))
    inner = F.coalesce(F.from_json(F.get_json_object("v", "$.institution"), INSTITUTION), F.when(F.get_json_object("v", "$.id").isNotNull(), F.from_json("v", INSTITUTION)))
    bare = F.get_json_object("v", "$.institution").isNull() & F.get_json_object("v", "$.id").isNotNull()
    status = F.when(F.col("v").isNull(), "cache_miss").when(bare, "ok").otherwise(F.coalesce(F.get_json_object("v", "$.status"), F.lit("cache_miss")))
    done = met.withColumn("status", status).withColumn("inst", F.when(status == "ok", inner)).withColumn("cache_hit", F.col("v").isNotNull()).drop("v")
    broken = (F.col("status") == "ok") & F.col("inst.id").isNull()
    return done.withColumn("status", F.when(broken, F.raise_error(F.concat(F.lit("malformed payload of "), F.col("institution"))).cast("string")).otherwise(F.col("status")))


def institution_triples(records: DataFrame, continents: DataFrame) -> DataFrame:
    """The triples of the ok rows of institution_records; continents holds code and continent."""
    d = records.where("status = 'ok'").withColumn("_g", institution_places(F.col("inst")))
    d = continent_of(d.withColumn("code", F.col("_g.code")), "code", continents)
    return missing_institutions(
        d.select(F.col("institution").alias("org"), F.col("inst.display_name").alias("name"), F.col("name").alias("fallback"), "aliases", "inst.id", "inst.ror", "_g.city", "_g.country", "code", "continent", "_g.latitude", "_g.longitude")
    )


def continent_of(rows: DataFrame, code: str, continents: DataFrame) -> DataFrame:
    """rows with continent by a country code in any case, with spaces around or without; null for others. The table (code,
    continent) has a row for each country; territories that it leaves out are in OUTLYING."""
    table = continents.select(F.upper(F.trim("code")).alias("_code"), "continent").distinct()
    met = rows.withColumn("_code", F.upper(F.trim(code))).join(table, "_code", "left")
    for place, continent in OUTLYING.items():
        met = met.withColumn("continent", F.coalesce("continent", F.when(F.col("_code") == place, continent)))
    return met.drop("_code")


#: Codes that tables of continents leave out.
OUTLYING = {"UM": "Oceania"}


def topics(works: DataFrame) -> DataFrame:
    """paper, topic: field and subfield identifiers of works (paper, topics array<string>), a set."""
    clean = F.filter(F.transform("topics", lambda t: F.regexp_replace(F.trim(t), "/+$", "")), lambda t: t.rlike(r"^https?://openalex\.org/(fields|subfields)/[0-9]+$"))
    return works.select("paper", F.explode(F.array_distinct(clean)).alias("topic"))


def best_scored(rows: DataFrame, keys: list[str], score: str, position: str, at_least: float) -> DataFrame:
    """The best-scored candidate of each key, the first on ties, if it scores enough."""
    return newest(rows.where(F.col(score) >= at_least).withColumn("_p", -F.col(position)), keys, score, "_p").drop("_p")


def first_scored(rows: DataFrame, keys: list[str], score: str, position: str, at_least: float) -> DataFrame:
    """The first candidate of each key that scores enough."""
    return newest(rows.where(F.col(score) >= at_least).withColumn("_p", -F.col(position)), keys, "_p").drop("_p")
