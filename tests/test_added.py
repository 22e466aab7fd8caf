import json

import pytest
from pyspark.sql import functions as F

from loomgraph.functions import identifiers as ids
from loomgraph.functions import payloads, text
from loomgraph.operators import answers, canonical, cleaning, enrich, graph, ledger, linking, people, publications
from loomgraph.plans import fetching
from loomgraph.plans.scratch import checkpoint_dir, discard, stored
from loomgraph.sources import bibtex_edit, sinks, tables
from loomgraph.sources.bibtex import parse_bibtex, unique_keys
from loomgraph.streaming import prompts

S = "https://schema.org/"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_authors_and_collisions(spark):
    authors = spark.createDataFrame([("p", "A1", None, "G. Engels"), ("p", None, None, "X"), ("q", "A1", None, "G. Engels"), ("r", "A2", "https://orcid.org/0-1", "None")], "paper string, author string, orcid string, name string")
    proposed = spark.createDataFrame([("p", "other"), ("p", "gregor"), ("q", "georg"), ("q", "gregor"), ("r", "http://k/orcid/0-1")], "paper string, person string")
    facts = [("other", S + "name", "Other, Person", "literal"), ("gregor", S + "name", "Engels, Gregor", "literal"), ("georg", "http://schema.org/name", "Engels, Georg", "literal"), ("gregor", S + "sameAs", "https://x", "iri"), ("gregor", S + "url", "u", "iri"), ("nobody", S + "name", "N", "literal")]
    records = people.person_records(spark.createDataFrame(facts, "s string, p string, o string, o_kind string"), proposed)
    assert {r.person: (sorted(r.ids), sorted(r.names)) for r in records.collect()}["gregor"] == (["gregor", "https://x"], ["Engels, Gregor"])
    found = people.author_candidates(authors, proposed, records)
    assert {(r.paper, r.author): (r.persons, r.status) for r in people.author_report(authors, found).collect()} == {("p", "A1"): ("gregor", "unique_name"), ("p", ""): ("", "missing_author_id"), ("q", "A1"): ("georg;gregor", "ambiguous"), ("r", "A2"): ("http://k/orcid/0-1", "identifier")}
    explicit = spark.createDataFrame([("A1", "other")], "author string, person string")
    mapped = people.author_candidates(authors, proposed, records, explicit)
    assert {(r.paper, r.author): (r.persons, r.status) for r in people.author_report(authors, mapped).collect()}[("p", "A1")] == ("other", "explicit_map")
    assert {(r.paper, r.author): r.status for r in people.author_report(authors, mapped).collect()}[("q", "A1")] == "unresolved"


ORG, AID = "http://upbkg.data.dice-research.org/ror/04tsk2644", "https://openalex.org/I904495901"
INST = {"id": AID, "ror": "https://ror.org/04tsk2644", "display_name": "Ruhr University Bochum", "geo": {"city": "Bochum", "country": "Germany", "country_code": "DE", "latitude": 51.48165, "longitude": 7.21648}}


def institutions(spark, payload):
    rows = spark.createDataFrame([(ORG, "Fallback", [AID, "https://ror.org/04tsk2644"], "I904495901")], "institution string, name string, aliases array<string>, openalex_id string")
    cache = spark.createDataFrame([] if payload is None else [(ORG, json.dumps(payload))], "k string, v string")
    records = enrich.institution_records(rows, cache)
    return enrich.institution_triples(records, spark.createDataFrame([("de", "Europe")], "code string, continent string")), records


def test_institutions(spark):
    for payload in ({"status": "ok", "openalex_sameas": AID, "institution": INST}, INST):
        triples, records = institutions(spark, payload)
        got = triples.collect()
        assert len(got) == 10 and {r.s for r in got} == {ORG}
        assert {(S + "addressCountry", "Germany"), (S + "addressCountry", "DE"), (S + "continent", "Europe"), (S + "latitude", "51.48165"), (S + "name", "Ruhr University Bochum")} <= {(r.p, r.o) for r in got}
        assert rows(sinks.report_rows(records, "affiliation")) == [(ORG, "ok", "true")]
    for payload, status in ((None, "cache_miss"), ({"status": "not_found"}, "not_found"), ({"status": "ok", "openalex_sameas": "https://openalex.org/I1", "institution": INST}, "cache_miss")):
        triples, records = institutions(spark, payload)
        assert triples.count() == 0 and records.first().status == status
    with pytest.raises(Exception, match="malformed"):
        institutions(spark, {"status": "ok", "institution": {"display_name": "x"}})[1].collect()


def test_continents(spark):
    table = spark.createDataFrame([("DE", "Europe"), ("BR", "South America")], "code string, continent string")
    codes = spark.createDataFrame([(" de ",), ("Br",), ("um",), ("ZZ",), (None,), ("",)], "code string")
    assert [r.continent for r in enrich.continent_of(codes, "code", table).orderBy("code").collect()] == [None, None, "Europe", "South America", None, "Oceania"]


def test_affiliation_iris(spark):
    d = spark.createDataFrame([("https://ror.org/1", "I1", "N", "DE"), ("", "I1", "N", "DE"), (None, " ", " Uni ", "De")], "r string, i string, n string, c string")
    got = [r.x for r in d.select(ids.affiliation_iri("https://k", F.col("r"), F.col("i"), F.col("n"), F.col("c")).alias("x")).collect()]
    import hashlib

    assert got == ["https://ror.org/1", "I1", "https://k/id/org/" + hashlib.sha1(b"org::uni|de").hexdigest()]


def test_model_payloads(spark):
    cases = {
        '{"output_text": " a ", "usage": {"input_tokens": 3, "output_tokens": "4", "total_tokens": null}}': ("a", (3, 4, None)),
        '{"output_text": 5, "output": [1, {"content": [{"text": "x"}, {"text": " "}, {"other": 1}]}, {"content": [{"text": "y "}]}]}': ("x\ny", (None, None, None)),
        '{"output": [], "choices": [{"message": {"content": " hi\\n"}}]}': ("hi", (None, None, None)),
        '{"choices": [{"message": {"content": [{"text": "p"}, {"text": "q"}]}}]}': ("p\nq", (None, None, None)),
        '{"choices": []}': ("", (None, None, None)), "not json": ("", (None, None, None)),
    }
    d = spark.createDataFrame(list(enumerate(cases)), "i int, x string")
    got = d.select("i", payloads.output_text(F.col("x")).alias("t"), payloads.usage_tokens(F.col("x")).alias("u")).orderBy("i").collect()
    assert [(r.t, tuple(r.u)) for r in got] == list(cases.values())
    w = spark.createDataFrame([('{"primary_location": {"pdf_url": " u "}}',), ('{"primary_location": 5}',), ("{}",)], "v string").select(payloads.primary_pdf(F.from_json("v", payloads.WORK)).alias("p"))
    assert [r.p for r in w.collect()] == ["u", None, None]


def test_ledger(spark):
    assert ledger.daily_limit("gpt-5") == 250_000 and ledger.daily_limit(" o1-mini ") == 2_500_000 and ledger.daily_limit("x", 7) == 7
    with pytest.raises(ValueError):
        ledger.daily_limit("unknown")
    book = spark.createDataFrame([("d1", "m", 1, 2, 10), ("d1", "m", 1, 2, -5), ("d0", "m", 1, 1, 99)], ledger.LEDGER)
    assert tuple(ledger.used(book, "d1").first()) == (10, 2, 4)
    prompts = spark.createDataFrame([(i, "x" * 9) for i in range(10)], "i int, llm_prompt string")
    assert [r.i for r in ledger.affordable(prompts, book, "d1", 10 + 4 * 5, ["i"], reserve=2).orderBy("i").collect()] == [0, 1, 2, 3]
    assert ledger.affordable(prompts, book, "d1", 10, ["i"]).count() == 0 and ledger.affordable(prompts, book, "d2", 3, ["i"]).count() == 1
    done = spark.createDataFrame([("{}",), ('{"usage": {"input_tokens": 2, "output_tokens": 3}}',)], "x string")
    assert sorted(r.total_tokens for r in ledger.entries(done, "d", "m", payloads.usage_tokens(F.col("x")), F.lit(7)).collect()) == [5, 7]


def test_budget_in_ranges(spark):
    data = [(k % 3, i, (i * 7 + k) % 11) for i in range(200) for k in range(3)] + [(None, 1, 5)]
    d = spark.createDataFrame(data, "day int, i int, n int")
    want = []
    for day in {r[0] for r in data}:
        total = 0
        for r in sorted((r for r in data if r[0] == day), key=lambda r: r[1]):
            total += r[2]
            want += [(*r, total)] if total <= 500 else []
    assert rows(answers.within_budget(d, "n", ["i"], 500, "day")) == sorted(want, key=str)


def test_calls():
    said, slept = iter([fetching.Reply(429, "", {"Retry-After": "7"}), fetching.Reply(503), fetching.Reply(200, "body")]), []
    assert fetching.called(lambda _: next(said), "r", sleep=slept.append) == ("ok", "body") and slept[0] == 7 and 2 <= slept[1] <= 3
    assert fetching.called(lambda _: fetching.Reply(404, "x" * 900), "r", sleep=slept.append) == ("http_404", "x" * 800)
    assert fetching.called(lambda _: fetching.Reply(500, "y" * 900), "r", fetching.Retry(tries=2), slept.append) == ("http_500", "y" * 400)
    assert fetching.called(lambda _: 1 / 0, "r", fetching.Retry(tries=1)) == ("request_error:ZeroDivisionError", "")


def test_fetched(spark):
    d = spark.createDataFrame([("a", 1), (None, 2)], "q string, `n n` int")
    got = fetching.fetched(d, "q", lambda x: fetching.Reply(200, x.upper()))
    assert rows(got) == [("a", 1, "ok", "A"), (None, 2, "no_request", "")]
    files = spark.createDataFrame([(bytearray(b"junk%PDF-1.4"), "x"), (bytearray(b"<html>"), "text/html"), (bytearray(b"<x>"), "application/pdf"), (bytearray(b"%PDF" * 9), "x")], "c binary, t string")
    assert [r.s for r in files.select(fetching.pdf_status(F.col("c"), 20, F.col("t")).alias("s")).collect()] == ["downloaded", "not_pdf", "downloaded", "too_large"]
    assert files.select(fetching.raw_text(F.col("c"), 4).alias("s")).first().s == "junk"


BIB = "% dbid: 3\n@a{k, x = {1}}\n% DBID: 4\n% other\n@a{k, title={A, B}, url={http://x.org/a b}}\n@a{k_2,\n % DBID : 9\n y = 2}\n@a{k, z = 3}\n"


def test_database_ids(spark):
    got = bibtex_edit.with_database_ids(parse_bibtex(spark.createDataFrame([("f", BIB)], "file string, value string"))).where("entry_type is not null")
    assert [r.dbid for r in got.orderBy("ordinal").collect()] == ["3", "4", None, "9"]
    assert [r.new_key for r in unique_keys(got).orderBy("ordinal").collect()] == ["k_3", "k_4", "k_2", "k_9"]
    same = got.withColumn("dbid", F.lit(None).cast("string"))
    assert [r.new_key for r in unique_keys(same).orderBy("ordinal").collect()] == ["k_3", "k_4", "k_2", "k_5"]


def test_values_in_place():
    text = '@a{k,\n  author = {M{\\"u}ller, (A) and B},  title="Gro{\\ss}",\n  note = {open {brace, year = {2001}, pages={1},\n  doi = {https://doi.org/10.1/X.} }\n'
    got = bibtex_edit.values_rewritten(text)
    assert got["text"] == '@a{k,\n  author = {Müller, A and B},  title="Groß",\n  note = {open brace}, year = {2001}, pages={1},\n  doi = {10.1/X} }\n' and got["changed"] == 4
    assert bibtex_edit.values_rewritten(got["text"])["changed"] == 0


def test_keys_and_urls(spark):
    lines = spark.createDataFrame([("@a{a b, title = {x}",), ("@a{M{\\\"u}ller,",), ("@a{x, y",), ("title = {a, b},",)], "value string")
    assert [r.value for r in bibtex_edit.keys_rewritten(lines).collect()] == ["@a{a_b, title = {x}", "@a{Muller,", "@a{x, y", "title = {a, b},"]
    f = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(v).alias("value")) for n, v in (("url", "{{HTTP://x.org/a\\_b c?q=%20#f g}}"), ("bdsk-url-1", "http://x.org/a_b%c"), ("url", "no url"), ("note", "http://n.org"))))
    assert spark.range(1).select(bibtex_edit.candidate_urls(f).alias("u")).first().u == ["http://x.org/a_b%20c?q=%20#f%20g", "http://x.org/a_b%25c"]
    light = bibtex_edit.light_entries(spark.createDataFrame([("f", 'x\n@a{k1, t = {A}, u = "B", v = 5}\n@b(k2, w = {C})\n')], "file string, value string")).orderBy("ordinal").collect()
    assert [(r.key, [tuple(x) for x in r.fields]) for r in light][0] == ("k1", [("t", "A"), ("u", "B"), ("v", "5")])


def test_readers(spark, tmp_path):
    (tmp_path / "p.csv").write_text("﻿s,paperName,authors\np1,T,\"a, b,a,\"\np2,U,\n")
    assert rows(tables.read_papers(spark, str(tmp_path / "p.csv"))) == [("p1", "T", ["a", "b"]), ("p2", "U", [])]
    assert tables.read_papers(spark, str(tmp_path / "p.csv"), 1).count() == 1
    (tmp_path / "m.csv").write_text("institution,name,external_ids\nhttp://k/1,N,https://openalex.org/I5; https://ror.org/2\nhttps://openalex.org/I7,,\n")
    assert rows(tables.read_missing_affiliations(spark, str(tmp_path / "m.csv"))) == [("http://k/1", "N", ["https://openalex.org/I5", "https://ror.org/2"], "I5"), ("https://openalex.org/I7", "", [], "I7")]
    for bad in ("http://k/1,N,https://openalex.org/I5;https://openalex.org/I6", "no iri,N,"):
        (tmp_path / "b.csv").write_text(f"institution,name,external_ids\n{bad}\n")
        with pytest.raises(Exception, match="conflicting|not an IRI"):
            tables.read_missing_affiliations(spark, str(tmp_path / "b.csv")).collect()
    (tmp_path / "a.csv").write_text("affiliation;affiliationName\nu1;Größe & Co\n;x\nu2;\n")
    assert [(r.uri, r.norm) for r in tables.read_affiliations(spark, str(tmp_path / "a.csv")).collect()] == [("u1", "große and co")]
    lines = spark.createDataFrame([("# c",), (" Ada   B ",), ("",)], "value string")
    assert rows(tables.name_list(lines)) == [("Ada B",)]
    with pytest.raises(Exception, match="no names"):
        tables.name_list(lines.where("value = ''")).collect()


def test_graphs_and_reports(spark, tmp_path):
    t = spark.createDataFrame([("a", "p", "1"), ("b", "p", "2")], "s string, p string, o string")
    quads = graph.in_graphs(default=t, g1=t.where("s = 'a'"))
    assert quads.count() == 3 and graph.any_graph(quads).count() == 2
    assert rows(graph.of_values(t, "s", ["b"])) == [("b", "p", "2")] and graph.of_values(t, "s", []).count() == 0 and graph.of_values(t, "s", t.where("s = 'a'").select("s")).count() == 1
    assert rows(graph.without_existing(t, t.where("s = 'a'"))) == [("b", "p", "2")]
    assert rows(graph.has_any(t.select("s"), t.where("s = 'a'"), "s", "o")) == [("a", True), ("b", False)]
    got = json.loads(sinks.json_report(t, "o", 1, some=F.col("p") == "p", none=F.col("s") == "z").first().value)
    assert got == {"some": 2, "none": 0, "some_examples": [{"o": "1", "s": "a", "p": "p"}], "none_examples": []}
    sinks.write_unless_dry(t, str(tmp_path / "dry"), True)
    sinks.write_unless_dry(t, str(tmp_path / "wet"), False)
    assert not (tmp_path / "dry").exists() and spark.read.parquet(str(tmp_path / "wet")).count() == 2


def test_streams_of_lines(spark, tmp_path):
    """Stateless repairs run on streams as they do on tables."""
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text('s1,name,J\\\\\\"{u}rgen\ns1,other,x\n')
    raw = spark.readStream.schema("s string, p string, o string").option("escape", "").csv(str(tmp_path / "in")).withColumn("o_kind", F.lit("literal"))
    q = cleaning.problem_names(raw, "name").writeStream.format("memory").queryName("repaired").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.p, r.changed) for r in spark.table("repaired").collect()) == [("name", True), ("other", False)]


def test_no_folder_of_one_machine_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        conf, sparkContext = spark.conf, Context

    monkeypatch.setattr(Session, "conf", type("C", (), {"get": staticmethod(lambda *_: None)}))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session)


def test_coercions(spark):
    d = spark.createDataFrame([(i, x) for i, x in enumerate(["12", " -3 ", "1.5", "x", None, "2020-02-30", "2020-02-29", "inf", "nan"])], "i int, x string").orderBy("i")
    got = d.select(text.is_whole(F.col("x")).alias("w"), text.real(F.col("x")).alias("r"), text.iso_day(F.col("x")).alias("d")).collect()
    assert [r.w for r in got] == [True, True] + [False] * 7
    assert [str(r.r) for r in got] == ["12.0", "-3.0", "1.5", "None", "None", "None", "None", "inf", "nan"]
    assert [str(r.d) for r in got] == ["None"] * 6 + ["2020-02-29", "None", "None"]


def test_files_in_place(tmp_path):
    p = tmp_path / "a.bib"
    p.write_text("old")
    assert sinks.replace_text(str(p), "old") is None and sinks.replace_text(str(p), "new") == f"{p}.bak"
    assert p.read_text() == "new" and (tmp_path / "a.bib.bak").read_text() == "old"


def test_keys_are_forgotten_after_the_watermark(spark, tmp_path):
    (tmp_path / "in").mkdir()
    rows = prompts.first_seen(spark.readStream.schema("k string, at timestamp").json(str(tmp_path / "in")), ["k"], "at", "1 hour")
    for n, day in enumerate(("2020-01-01T00:00:00", "2020-01-02T00:00:00", "2020-01-03T00:00:00", "2020-01-04T00:00:00")):
        (tmp_path / "in" / f"{n}.json").write_text(json.dumps({"k": "a", "at": day}) + "\n" + json.dumps({"k": "a", "at": day}))
        prompts.drained(rows, str(tmp_path / "out"), str(tmp_path / "ck"))
    assert 2 <= spark.read.parquet(str(tmp_path / "out")).count() <= 4


def test_classes_and_limits(spark, tmp_path):
    e = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "x"), ("d", "y"), ("e", None), ("a", "x")], "uri string, label string")
    assert rows(linking.classes(e, "label")) == [("a", "x", "a", 3), ("b", "x", "a", 3), ("c", "x", "a", 3)]
    p = spark.createDataFrame([(1, "u", "http://a/x"), (2, "u", "http://a/x.pdf"), (3, "v", "http://b/x"), (4, "w", "ftp://c"), (5, "z", "http://d")], "line_no int, pub string, pdf_url string")
    assert rows(publications.preferred_pdfs(p)) == [("u", "http://a/x.pdf"), ("v", "http://b/x"), ("z", "http://d")]
    assert rows(publications.preferred_pdfs(p, 1)) == [("u", "http://a/x.pdf")]
    (tmp_path / "c.json").write_text('{"k": {"x": 1}}')
    assert rows(tables.migrated_cache(spark, str(tmp_path / "c.json"), str(tmp_path / "kv"))) == [("k", '{"x": 1}', 0)]
    bad = spark.createDataFrame([(1, "http://e/1", "c1", "x", "x"), (2, "http://e/1", "c2", "x", "x")], "line_no int, s string, new_s string, o string, new_o string")
    with pytest.raises(Exception, match="two canonical"):
        canonical.report(bad).collect()
    d = spark.createDataFrame([("https://openalex.org/A1/",), ("A2",), ("",)], "x string")
    assert [r.y for r in d.select(ids.openalex_author_endpoint(F.col("x")).alias("y")).collect()] == ["https://api.openalex.org/authors/A1", "https://api.openalex.org/authors/A2", None]


def test_stored_tables_go_when_discarded(spark):
    import os

    t = stored(spark.range(5).toDF("x"), "test")
    place = t._stored_at.removeprefix("file://")
    assert t.count() == 5 and os.path.isdir(place)
    discard(t, spark.range(1))
    assert not os.path.exists(place)
