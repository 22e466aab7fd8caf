"""Funded projects: programmes, partners matched to organisations, and triples."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions.identifiers import percent
from loomgraph.functions.similarity import indel_ratio_of
from loomgraph.functions.text import plain_text, slug
from loomgraph.operators.enrich import newest
from loomgraph.operators.graph import RDF_TYPE, emitted, schema, triple


def programme(funding: Column) -> Column:
    """label, name, first, last of a funding text that names the programme, else null; years like 2021-2027 go."""
    text = F.trim(funding)
    years = r"\b(20[0-9]{2})\s*[-–]\s*(20[0-9]{2})\b"
    year = lambda i: F.when(F.regexp_extract(text, years, i) != "", F.regexp_extract(text, years, i))
    name = F.regexp_replace(F.replace(F.regexp_replace(text, years, ""), F.lit("Erasmus +"), F.lit("Erasmus+")), r"(?U)\s+", " ")
    return F.when(F.lower(text).contains("erasmus"), F.struct(text.alias("label"), F.regexp_replace(name, r"^[ ,–-]+|[ ,–-]+$", "").alias("name"), year(1).alias("first"), year(2).alias("last")))


def partner_windows(projects: DataFrame, most: int = 4) -> DataFrame:
    """project, start, width, raw, norm: each run of up to ``most`` comma parts of partners, as names may hold commas."""
    parts = F.filter(F.transform(F.split("partners", ","), lambda p: F.trim(p)), lambda p: p != "")
    spans = F.flatten(F.transform(parts, lambda _, i: F.transform(F.sequence(F.lit(1), F.least(F.lit(most), F.size(parts) - i)), lambda w: F.struct(i.alias("start"), w.alias("width"), F.array_join(F.slice(parts, i + 1, w), ", ").alias("raw")))))
    return projects.select("project", F.inline(spans)).withColumn("norm", plain_text(F.col("raw"))).where(F.length("norm") >= 4)


def matched_partners(projects: DataFrame, organisations: DataFrame, threshold: float = 100) -> DataFrame:
    """project, start, raw, uri, score: partners (project, partners) matched to organisations (uri, norm, position).

    At 100 equal texts are joined. Below, only pairs whose lengths can reach the threshold are compared. Of a window the
    best organisation counts, the first on ties; then, project by project, the best windows that do not overlap and
    whose organisation is not taken yet. A project's partners are few: that choice is made in one place.
    """
    windows = partner_windows(projects)
    orgs = organisations.where(F.length("norm") > 0).select("uri", F.col("norm").alias("other"), "position")
    if threshold >= 100:
        pairs = windows.join(orgs, F.col("norm") == F.col("other")).withColumn("score", F.lit(100.0))
    else:
        n, m = F.length("norm"), F.length("other")
        buckets = lambda c, k: F.floor(F.length(c) / 16) + k
        # lengths within the bound differ by a bounded factor: equi-join on length buckets, then the exact bound
        reach = F.transform(F.sequence(F.floor(n * threshold / (200 - threshold) / 16), F.floor(n * (200 - threshold) / threshold / 16)), lambda b: b)
        near = windows.withColumn("bucket", F.explode(reach)).join(orgs.withColumn("bucket", buckets("other", 0)), "bucket").where(200 * F.least(n, m) >= threshold * (n + m))
        pairs = near.withColumn("score", indel_ratio_of("norm", "other")).where(F.col("score") >= threshold).drop("bucket")
    best = newest(pairs.withColumn("_p", -F.col("position")), ["project", "start", "width", "raw"], "score", "_p", "uri")

    def chosen(rows: pd.DataFrame) -> pd.DataFrame:
        taken, seen, out = set(), set(), []
        for r in sorted(rows.itertuples(index=False), key=lambda r: (-r.score, -r.width, -len(r.raw), r.start)):
            places = set(range(r.start, r.start + r.width))
            if not places & taken and r.uri not in seen:
                taken |= places
                seen.add(r.uri)
                out.append((r.project, r.start, r.raw, r.uri, r.score))
        return pd.DataFrame(out, columns=["project", "start", "raw", "uri", "score"])

    kinds = {f.name: f.dataType.simpleString() for f in best.schema.fields}
    return best.select("project", "start", "width", "raw", "uri", "score").groupBy("project").applyInPandas(chosen, f"project {kinds['project']}, start int, raw string, uri string, score double")


def project_triples(rows: DataFrame, base: str) -> DataFrame:
    """Triples of projects (row_no, number, title, short, begin, end, funding) of the programme; the label of a programme
    is that of its first row."""
    d = rows.withColumn("_g", programme(F.col("funding"))).where("_g is not null")
    d = d.withColumn("_p", F.concat(F.lit(f"{base}/project/"), F.when(F.trim("number") != "", percent(F.trim("number"), "/")).otherwise(slug(F.trim("title")))))
    d = d.withColumn("_u", F.concat(F.lit(f"{base}/funding-program/"), slug(F.col("_g.name")), F.when(F.col("_g.first").isNotNull(), F.concat(F.lit("-"), F.col("_g.first"), F.lit("-"), F.col("_g.last"))).otherwise("")))
    date = lambda c: F.when(F.try_to_date(F.col(c), "yyyy-MM-dd").isNotNull(), F.col(c))
    p, u = F.col("_p"), F.col("_u")
    own = emitted(
        d,
        triple(p, RDF_TYPE, F.lit(schema("ResearchProject")), "iri"),
        triple(p, schema("name"), F.trim("title")),
        triple(p, schema("alternateName"), F.trim("short")),
        triple(p, schema("startDate"), date("begin"), datatype="http://www.w3.org/2001/XMLSchema#date"),
        triple(p, schema("endDate"), date("end"), datatype="http://www.w3.org/2001/XMLSchema#date"),
        triple(p, schema("funding"), u, "iri"),
    )
    first = d.groupBy("_u").agg(F.min_by("_g", "row_no").alias("_g"))
    programmes = emitted(first, triple(u, RDF_TYPE, F.lit(schema("FundingScheme")), "iri"), triple(u, schema("name"), F.col("_g.name")), triple(u, schema("alternateName"), F.col("_g.label")), triple(u, schema("startDate"), F.col("_g.first")), triple(u, schema("endDate"), F.col("_g.last")))
    return own.unionByName(programmes)
