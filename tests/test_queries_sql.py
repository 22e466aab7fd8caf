"""Registered queries against their SQL on small odd tables."""

import random

import duckdb
import pytest

from loomgraph.operators import linking
from loomgraph.plans import queries

PART = "p_partkey long, p_name string, p_brand string, p_size int"


def both(spark, tmp_path, name, table, data, schema):
    """The rows of a query and of its SQL over one table, as sorted lists."""
    spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{table}.parquet")
    con = duckdb.connect()
    con.sql(f"create view {table} as from '{tmp_path}/{table}.parquet/*.parquet'")
    mine = queries.QUERIES[name](spark, str(tmp_path))
    want = con.sql(queries.SQL[name])
    assert mine.columns == want.columns
    return sorted(map(tuple, mine.collect()), key=str), sorted(want.fetchall(), key=str)


def test_titles_keep_what_the_sql_keeps(spark, tmp_path):
    titles = ["a &amp; b", "cut &amp", "cut &am", "&quot;q&quot; &lt;x&gt;", "&amp;amp; &amp;lt;", r"\&amp; \\&quot;", "&#38; &#x26; &copy 1", "&AMP; &Amp;", "&&amp;;", "línea\n&amp; zwei", "", "$1 \\0 &amp;"]
    data = [(i, f"<head><title>{t}</title></head>") for i, t in enumerate(titles)] + [(90, None), (91, "no title &amp;"), (92, "<title>a &amp; <b>"), (93, "<title>1 &amp</title><title>2</title>")]
    mine, want = both(spark, tmp_path, "q20_entities", "pages", data, "page_id long, html string")
    assert mine == want and len(mine) == len(data)
    assert dict(mine)[0] == "a & b" and dict(mine)[1] == "cut &amp"


def odd_parts():
    rng = random.Random(3)
    rows = [(k, rng.choice(["tin", "tin|a", None]), rng.choice(["a", "a|a", None]), rng.choice([1, 24, 25, 50, None])) for k in rng.sample(range(2000), 60)]
    low = [(k, "low", "b", 1) for k in (3000, 3001, 3002)]
    split = [(4000 + k, f"w{k % 3}", "b", s) for k, s in enumerate([1, 50, 1, 30, 1, 1, 1, 2, 25])]
    again = [(5000, "x", "c", 1), (5000, "x", "c", 50), (5001, "x", "c", 2), (5000, "y", "c", 50), (5002, "y", "c", 1), (-7, "y", "c", 1)]
    return rows + low + split + again + [(6000, "single", "d", 50), (6001, "single", "d", 50), (6001, "single", "d", 50), (None, "x", "c", 50), (7000, "alone", "d", 50)]


def test_components_equal_the_sql_on_odd_parts(spark, tmp_path):
    mine, want = both(spark, tmp_path, "q10_components", "part", odd_parts(), PART)
    assert mine == want and len(mine) > 20


@pytest.mark.parametrize("threshold", [0.0, 0.3, 0.7, 2.0])
def test_joining_links_are_pairs_with_the_same_mapping(spark, threshold):
    rng = random.Random(str(threshold))
    entities = [(f"u{rng.randrange(60)}", rng.choice(["a", "b", "c", None]), rng.choice([0.1, 0.3, 0.5, 0.7, 0.9, None])) for _ in range(80)] + [(None, "a", 0.9)]
    df = spark.createDataFrame(entities, "uri string, label string, conf double")
    links = {tuple(r) for r in linking.joining(df, threshold).collect()}
    pairs = {(u, v, c) for u, a, c in entities for v, b, _ in entities if u and v and a and a == b and u < v}
    assert links <= pairs and len(links) < len(entities)
    got, want = ({tuple(r) for r in linking.mapping(spark.createDataFrame(sorted(x, key=str), linking.LINK), threshold).collect()} for x in (links, pairs))
    assert got == want


def test_links_of_large_classes_grow_with_the_parts(spark, tmp_path, monkeypatch):
    made, components = [], linking.connected_components
    monkeypatch.setattr(linking, "connected_components", lambda links, *a: made.append(links.count()) or components(links, *a))
    mine, want = both(spark, tmp_path, "q10_components", "part", [(k, "tin", "a", 1 + k % 50) for k in range(400)], PART)
    assert mine == want and len(mine) == 400 and made[0] < 400


def test_smush_equals_the_sql_on_odd_parts(spark, tmp_path):
    """Without nulls: these are no triples, while the SQL has rows of them."""
    whole = [r for r in odd_parts() if None not in r[:3]]
    mine, want = both(spark, tmp_path, "q11_smush", "part", whole, PART)
    assert mine == want and len(mine) > 20


def test_smush_deals_out_iris_alone_and_makes_no_pairs(spark, tmp_path, monkeypatch):
    made, components = [], linking.connected_components
    monkeypatch.setattr(linking, "connected_components", lambda links, *a: made.append(links.count()) or components(links, *a))
    mine, want = both(spark, tmp_path, "q11_smush", "part", [(k, "tin", "a", 1 + k % 50) for k in range(400)], PART)
    assert mine == want and made[0] < 400


def test_rewritten_triples(spark):
    triples = spark.createDataFrame([(1, "a", "p", "b", "iri"), (2, "a", "p", "b", "literal"), (3, "b", "b", "a", "bnode"), (4, "x", "p", "a", None), (5, "x", "p", None, "iri"), (6, None, "p", "a", "iri"), (7, "c", "p", "c", "iri"), (7, "c", "p", "c", "iri")], "n int, s string, p string, o string, o_kind string")
    old_new = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "c")], "old string, canonical string")
    out = linking.rewritten_by(triples, old_new)
    assert out.columns == triples.columns
    assert sorted(map(tuple, out.collect()), key=str) == [(1, "A", "p", "B", "iri"), (2, "A", "p", "b", "literal"), (3, "B", "b", "a", "bnode"), (4, "x", "p", "a", None), (5, "x", "p", None, "iri"), (6, None, "p", "A", "iri"), (7, "c", "p", "c", "iri"), (7, "c", "p", "c", "iri")]
    met = [j for j in out._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftOuter" in j and "(o#" in j]
    assert len(met) == 1


def test_mapping_places_every_end(spark):
    nan = float("nan")
    links = [("b", "a", 0.9), ("c", "d", 0.1), ("e", "e", 0.9), (None, "f", 0.9), ("g", None, 0.1), (None, None, 0.9), ("h", "i", None), ("j%", "k", nan), ("a", "c", 0.1)]
    got = linking.mapping(spark.createDataFrame(links, linking.LINK), 0.7).collect()
    assert sorted(map(tuple, got)) == [("a", "a"), ("b", "a"), ("c", "c"), ("d", "d"), ("e", "e"), ("f", "f"), ("g", "g"), ("h", "h"), ("i", "i"), ("j%", "k"), ("k", "k")]
