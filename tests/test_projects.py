from pyspark.sql import functions as F

from loomgraph.operators import projects, publications


def test_programme(spark):
    df = spark.createDataFrame([("Erasmus + 2021-2027 Cooperation Partnership",), ("EU",), (None,)], "x string").select(projects.programme(F.col("x")).alias("g"))
    assert [r.g and tuple(r.g)[1:] for r in df.collect()] == [("Erasmus+ Cooperation Partnership", "2021", "2027"), None, None]


def test_partners(spark):
    p = spark.createDataFrame([(1, "Uni A, Uni B, (City, Land), uni a"), (2, "Univ Bx")], "project int, partners string")
    o = spark.createDataFrame([("a", "uni a", 0), ("b", "uni b city land", 1), ("c", "univ b", 2)], "uri string, norm string, position int")
    assert {(r.project, r.start, r.uri) for r in projects.matched_partners(p, o).collect()} == {(1, 0, "a"), (1, 1, "b")}
    assert (2, 0, "c") in {(r.project, r.start, r.uri) for r in projects.matched_partners(p, o, 80).collect()}


def test_project_triples(spark):
    rows = spark.createDataFrame([(1, "7/x", "T", None, "2020-01-01", "bad", "Erasmus+ Z"), (2, "", "Große Idee", "GI", None, None, "erasmus+ z"), (3, "9", "no", None, None, None, "DFG")], "row_no int, number string, title string, short string, begin string, end string, funding string")
    got = {(r.s, r.p.rpartition("/")[2], r.o) for r in projects.project_triples(rows, "b").collect()}
    assert {("b/project/7/x", "startDate", "2020-01-01"), ("b/project/groe-idee", "alternateName", "GI"), ("b/funding-program/erasmus-z", "name", "Erasmus+ Z")} <= got
    assert not any("/9" in s for s, _, _ in got) and not any(p == "endDate" for _, p, _ in got)


def test_publications(spark):
    rows = spark.createDataFrame([("p", "https://doi.org/10.1/a", "http://x/y z", ["t"], False), ("q", "doi:10.1/b", "http://x/y", None, True)], "pub string, doi string, pdf_url string, topics array<string>, has_doi boolean")
    assert {(r.s, r.o) for r in publications.publication_facts(rows).collect()} == {("p", "DOI:10.1/a"), ("p", "t"), ("q", "http://x/y")}
    pdfs = spark.createDataFrame([(1, "p", "http://a"), (2, "p", "http://a/x.pdf"), (3, "q", "ftp://z"), (4, "q", "http://b")], "line_no int, pub string, pdf_url string")
    assert {tuple(r) for r in publications.preferred_pdfs(pdfs).collect()} == {("p", "http://a/x.pdf"), ("q", "http://b")}
    hits = spark.createDataFrame([(1, "A title", "2020", "10.1/x", 0, "h0", "a title", "2020", None), (1, "A title", "2020", "10.1/x", 1, "h1", "zzz", None, "10.1/X"), (2, "Other", None, None, 0, "h2", "qqqq", None, None)], "id int, title string, year string, doi string, position int, hit string, hit_title string, hit_year string, hit_doi string")
    assert [tuple(r) for r in publications.picked_publication(hits).collect()] == [(1, "h1")]
    names = spark.createDataFrame([(1, "Ada L", 0, "x", "ada l"), (1, "Ada L", 1, "y", "ada l")], "id int, name string, position int, hit string, hit_name string")
    assert [tuple(r) for r in publications.picked_author(names).collect()] == [(1, "x")]
    ext = spark.createDataFrame([("p", "Ada", "https://dblp.org/pid/1/2", [" U ", "U"]), ("p", "Bob", "https://dblp.org/pid/3", None)], "paper string, name string, pid_url string, affiliations array<string>")
    inner = spark.createDataFrame([("p", "Bob")], "paper string, name string")
    assert {r.o for r in publications.external_authors(ext, inner, "b").collect()} >= {"Ada", "U", "b/author/dblp/1_2"}
    e = spark.createDataFrame([(1, "k", ["u1", "u2"]), (2, "m", ["u3"])], "entry int, key string, urls array<string>")
    t = spark.createDataFrame([("k", "s2", None), ("k", "s1", None), ("m", "s3", "has"), ("m", "s4", None)], "key string, s string, url string")
    assert {(r.s, r.o) for r in publications.missing_urls(e, t).collect()} == {("s1", "u1"), ("s1", "u2"), ("s2", "u1"), ("s2", "u2")}
    assert {(r.s, r.o) for r in publications.tagged(e, t, "kw", "trr").collect()} == {("s1", "trr"), ("s3", "trr")}
    orgs = spark.createDataFrame([("a", "https://openalex.org/I1"), ("b", "I2"), ("c", "x"), ("d", "I4")], "org string, openalex string")
    cache = spark.createDataFrame([("a", "https://openalex.org/I1", "ok", "{}"), ("b", "I9", "ok", "{}"), ("d", "I4", "not_found", None)], "org string, openalex string, state string, payload string")
    assert {r.org: r.state for r in publications.affiliation_state(orgs, cache).collect()} == {"a": "ok", "b": "cache_miss", "c": "invalid_openalex_id", "d": "not_found"}
