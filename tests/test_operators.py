import json
import random
import sqlite3
import zlib

import pytest
from pyspark.sql import functions as F

from loomgraph.operators import analytics, answers, bib_graph, canonical, cleaning, csv_graph, enrich, graph, linking
from loomgraph.operators.components import connected_components
from loomgraph.sources import bibtex, sinks, tables
from loomgraph.streaming import prompts


def test_components_equal_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 120), rng.randint(0, 120)) for _ in range(90)] + [(500, i) for i in range(300, 400)] + [(7, 7), (None, 3)]
    root = {x: x for e in edges for x in e if x is not None and None not in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u int, v int")).collect()}
    assert got == {x: find(x) for x in root}
    assert connected_components(spark.createDataFrame([], "u int, v int")).count() == 0


def test_mapping_prefers_plain_short_names(spark):
    links = [("http://x/%C3", "http://xx/abcdef", 1.0), ("http://xx/abcdef", "http://xx/abcdee", 0.9), ("p", "q", 0.1), ("n", "m", float("nan"))]
    got = {r.old: r.canonical for r in linking.mapping(spark.createDataFrame(links, linking.LINK)).collect()}
    assert got == {"http://x/%C3": "http://xx/abcdee", "http://xx/abcdef": "http://xx/abcdee", "http://xx/abcdee": "http://xx/abcdee", "p": "p", "q": "q", "n": "m", "m": "m"}
    lines = spark.createDataFrame([("<a>\t<b>\t0.5",), ("a\tb\t1",), ("<a>\t<b>\tx",), ("",)], "value string")
    assert [tuple(r) for r in linking.read_links(lines).collect()] == [("a", "b", 0.5)]


def test_shared_objects(spark):
    rows = spark.createDataFrame([("s1", "o", 1), ("s2", "o", 2), ("s3", "o", 3), ("s9", "p", 4)], "s string, key string, line_no int")
    assert {tuple(r) for r in linking.shared_object(rows).collect()} == {("s1", "s2", 1.0), ("s1", "s3", 1.0), ("s2", "s3", 1.0)}


def test_canonicalized(spark):
    base = "https://dice-research.org"
    ext = "https://ror.org/058kzsd48#faculty"
    rows = [(1, ext, "p", "x", "literal"), (2, ext, "p", "https://other.org/only-object", "iri"), (3, f"{base}/a", "p", ext, "iri"), (4, "https://b.org/y", "p", f"{base}/a", "iri")]
    done = canonical.canonicalized(spark.createDataFrame(rows, "line_no int, s string, p string, o string, o_kind string"), base)
    assert {r.line_no: r.new_o for r in done.collect()}[2] == "https://other.org/only-object"
    rep = {r.external_iri: (r.count_subject_rewrites, r.count_object_rewrites, r.first_seen_line) for r in canonical.report(done).collect()}
    assert rep == {ext: (2, 1, 1), "https://b.org/y": (1, 0, 4)}
    assert canonical.same_as(canonical.report(done)).count() == 2


def test_cleaned_names(spark):
    rows = [("a", "name", 'M{\\\\\\"u}ller', 1), ("a", "name", "Muller", 2), ("b", "name", "x{", 3), ("b", "other", "x{", 4), ("c", "name", "Same", 5), ("c", "name", "Same", 6)]
    t = spark.createDataFrame(rows, "s string, p string, o string, line_no int").withColumn("o_kind", F.lit("literal")).withColumn("o_lang", F.lit(None).cast("string")).withColumn("o_dt", F.lit(None).cast("string"))
    got = {(r.line_no, r.o, r.state) for r in cleaning.cleaned_names(t, "name", dedupe=True, best_only=True).collect()}
    assert got == {(1, "Müller", "changed"), (4, "x{", "other"), (5, "Same", "same")}
    assert cleaning.duplicate_lines(spark.createDataFrame([(x,) for x in "aaabbc"], "value string")).first().surplus == 3


def test_publications(spark, tmp_path):
    (tmp_path / "p.csv").write_text(
        'id;titel;sprachen;jahr;publikationstyp;identifier;autoren;fachzeitschrift;lizenz;peerreviewed\n'
        '1;Titel "A";de;2020;Zeitschriftenartikel;DOI: 10.1/x_y; ISSN: 1234-5678;Doe, J (UNI-ID: 5, orcid: 0000-0002-1825-0097);J;cc_by_4_0;ja\n'.replace("DOI: 10.1/x_y; ISSN: 1234-5678", '"DOI: 10.1/x_y; ISSN: 1234-5678"')
        + ";none;;;;;;;;\n"
    )
    rows = tables.read_publications(spark, str(tmp_path / "p.csv"))
    base = "https://kg.org"
    got = {(r.s.removeprefix(base), r.p.rpartition("/")[2], r.o, r.o_lang) for r in csv_graph.semantic_layer(rows, base).collect()}
    assert {("/id/publication/ris/1", "name", 'Titel "A"', "de"), ("/id/publication/ris/1", "sameAs", "https://doi.org/10.1/x_y", None), ("/id/publication/ris/1", "license", "https://creativecommons.org/licenses/by/4.0/", None), ("/id/publication/ris/1", "peerReviewed", "true", None)} <= got
    assert any(p == "issn" and s.startswith("/id/periodical/") for s, p, _, _ in got)
    people = {(r.p.rpartition("/")[2], r.o) for r in csv_graph.contributors(rows, base, "autoren", "author").collect()}
    assert ("author", "https://orcid.org/0000-0002-1825-0097") in people and ("uniId", "5") in people
    raw = {r.p.rpartition("/")[2]: (r.o, r.o_dt) for r in csv_graph.raw_layer(rows, base).collect()}
    assert raw["jahr"][1].endswith("gYear") and "untertitel" not in raw


def test_authorships(spark):
    a = [("A1", "P1", "Ada", "first", True, ["x", "x"], [("I1", "https://ror.org/r1", "Uni")]), (None, None, "Bob", None, None, None, None)]
    kind = "array<struct<author:string,person:string,name:string,position:string,corresponding:boolean,affiliations:array<string>,institutions:array<struct<id:string,ror:string,name:string>>>>"
    w = spark.createDataFrame([("http://k/p", "W", "2020-01-01", "2020", a)], f"paper string, work string, date string, year string, authorships {kind}")
    got = {(r.s, r.p.rpartition("/")[2].rpartition("#")[2], r.o) for r in enrich.authorships(w, "http://k").collect()}
    node = "http://k/p/authorship/P1"
    assert {(node, "authorOrder", "1"), (node, "affiliation", "http://k/ror/r1"), ("http://k/ror/r1", "sameAs", "https://ror.org/r1"), ("http://k/ror/r1", "sameAs", "I1"), (node, "isCorresponding", "true"), ("http://k/p/authorship/position-2", "authorOrder", "2")} <= got
    assert not any("position-2" in s for s, _, _ in {(r.s, 0, 0) for r in enrich.authorships(w, "http://k", mapped_only=True).collect()})


def test_author_resolution(spark):
    rows = [("p", "a1", "x", "id", 1), ("p", "a1", "y", "name", 2), ("p", "a2", "x", "id", 1), ("p", "a3", "z", "name", 2), ("q", "a1", "x", "id", 1)]
    got = {tuple(r) for r in enrich.resolved_authors(spark.createDataFrame(rows, "paper string, author string, person string, method string, tier int")).collect()}
    assert got == {("p", "a3", "z", "name"), ("q", "a1", "x", "id")}


def test_key_values(spark, tmp_path):
    con = sqlite3.connect(tmp_path / "c.db")
    con.execute("create table cache (k text, v blob, t integer)")
    con.executemany("insert into cache values (?, ?, ?)", [("a", zlib.compress(b'{"x": 1}'), 1), ("b", b'{"x": 2}', 2)])
    con.commit()
    kv = tables.read_key_values(spark, str(tmp_path / "c.db"))
    assert {r.k: json.loads(r.v)["x"] for r in kv.collect()} == {"a": 1, "b": 2}
    new = spark.createDataFrame([("a", "new", 1), ("c", "c", 1)], "k string, v string, t long")
    assert {r.k: r.v for r in enrich.upserted(kv, new).collect()} == {"a": "new", "b": '{"x": 2}', "c": "c"}
    rows = spark.createDataFrame([(1, ["z", "c"]), (2, ["q"])], "id int, ks array<string>")
    assert {r.id: r.v for r in enrich.looked_up(rows, F.col("ks"), new).collect()} == {1: "c", 2: None}
    works = spark.createDataFrame([("k1", "w1"), ("k2", "w1"), ("k2", "w2")], "key string, work string")
    titles = spark.createDataFrame([(1, "k1"), (2, "k2"), (3, "k3")], "id int, key string")
    assert {r.id: r.state for r in enrich.matched_titles(titles, works).collect()} == {1: "matched", 2: "ambiguous", 3: "not_found"}


def test_answers(spark):
    texts = ['{"paper_uri": "http://k/1", "related_github": [{"url": "https://github.com/o/r/x", "confidence": 0.9}, {"url": "https://github.com/o/s", "confidence": "0.1"}]}', 'say ```json\n{"paper_uri": "http://k/2"}\n```', "none", "", "{bad"]
    d = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, t string").withColumn("response", answers.json_salvaged(F.col("t"), answers.ANSWER)).withColumn("e", answers.salvage_error(F.col("t")))
    got = d.orderBy("i").collect()
    assert [r.e for r in got] == [None, None, "no_json_object", "empty_output", "invalid_json"] and got[1].response.paper_uri == "http://k/2"
    out = answers.repositories(d.withColumn("pub", F.lit(None).cast("string")).withColumn("status", F.lit("ok")), "repo").collect()
    assert [tuple(r) for r in out] == [("http://k/1", "repo", "https://github.com/o/r")]
    mention = [("u", "ctx", "pdf")]
    p = spark.createDataFrame([("T", None, mention)], "t string, a string, m array<struct<url:string,context:string,source:string>>").select(answers.prompt(F.col("t"), F.col("a"), F.col("m"), 30).alias("p")).first().p
    assert p.startswith("Title: T\nAbstract: \n") and "1. u [pdf]\\n   ctx" in p


def test_collaborations(spark):
    works = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "a"), (2, "b"), (3, "a")], "pub int, name string")
    assert {tuple(r) for r in analytics.collaboration_pairs(works).collect()} == {("a", "b", 2), ("a", "c", 1), ("b", "c", 1)}
    assert analytics.collaboration_count(works, ["a", "b"], exactly=True).first()[0] == 2
    assert analytics.collaboration_count(works, ["a"]).first()[0] == 0
    with pytest.raises(ValueError):
        analytics.collaborations(works, at_least=1)


def test_bibtex_to_triples(spark):
    text = '@article{k1, title={T}, year=2001, doi={10.1000/AB}, journal={J}, author={Doe, J. and https://orcid.org/0000-0001}, pages={1--3}}\n@misc{k1, note={x}}\n@misc{k1, note={y}}\n'
    rows = bibtex.parse_bibtex(spark.createDataFrame([("f", text)], "file string, value string"))
    got = {(r.p.rpartition("/")[2].rpartition("#")[2], r.o) for r in bib_graph.bib_triples(rows, "https://k").collect()}
    assert {("name", "T"), ("identifier", "DOI:10.1000/ab"), ("identifier", "bibtex:k1"), ("author", "https://orcid.org/0000-0001"), ("numberOfPages", "3"), ("sameAs", "https://doi.org/10.1000/ab")} <= got
    keyed = rows.where("entry_type is not null").withColumn("dbid", F.when(F.col("ordinal") == 0, "7"))
    assert sorted(r.new_key for r in bibtex.unique_keys(keyed).collect()) == ["k1_2", "k1_3", "k1_7"]
    assert bibtex.repair_report(rows).first().n_entries == 3
    assert {r["name"]: r.n for r in bibtex.field_frequencies(rows).collect()}["note"] == 2


def test_lines_and_sinks(spark, tmp_path):
    (tmp_path / "t.nt").write_text("".join(f"line {i}\n" for i in range(40)))
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    got = {r.line_no: r.value for r in tables.numbered_lines(spark, str(tmp_path / "t.nt")).collect()}
    spark.conf.set("spark.sql.files.maxPartitionBytes", was)
    assert got == {i + 1: f"line {i}" for i in range(40)}
    t = spark.createDataFrame([("iri", "s", "p", "literal", "a", "en", None), ("iri", "s", "p", "literal", "a", "en", None), ("bnode", "b", "p", "iri", "o", None, None)], "s_kind string, s string, p string, o_kind string, o string, o_lang string, o_dt string")
    sinks.write_triples(t, str(tmp_path / "out"), "sorted", one_file=True)
    assert [r.value for r in spark.read.text(str(tmp_path / "out")).collect()] == ['<s> <p> "a"@en .', "_:b <p> <o> ."]
    assert sinks.insert_statement(t).startswith("INSERT DATA {\n<s>")
    with pytest.raises(ValueError):
        sinks.check_paths("/a/b", "file:///a/./b")
    (tmp_path / "c.csv").write_text("﻿x;y\n1;2,3\n")
    assert tables.read_csv(spark, str(tmp_path / "c.csv"), ["x", "y"]).first().y == "2,3"
    (tmp_path / "l.jsonl").write_text('{"pub": "a"}\nbad\n[1]\n{"pub": "b"}')
    assert {r.pub for r in tables.read_json_lines(spark, str(tmp_path / "l.jsonl"), "pub string").collect()} == {"a", "b"}
    with pytest.raises(Exception, match="conflicting"):
        tables.single_valued(spark.createDataFrame([("a", "1"), ("a", "2")], "k string, v string"), "k", "v").collect()


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text('{"pub": "a", "title": "x"}\n{"pub": "a"}\n{"other": 1}\n')
    rows = prompts.first_seen(prompts.prompts(spark, str(tmp_path / "in")), ["pub"])
    model = lambda batch: batch.select("pub", F.lit("ok").alias("status"))
    prompts.answered(rows, model, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    (tmp_path / "in" / "2.json").write_text('{"pub": "a"}\n{"pub": "b"}\n')
    prompts.answered(rows, model, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    assert sorted(r.pub for r in spark.read.json(str(tmp_path / "out")).collect()) == ["a", "b"]


def test_algebra(spark):
    t = spark.createDataFrame([("s", "p", "o", "iri"), ("o", "name", "N", "literal"), ("o", "name", "M", "literal")], "s string, p string, o string, o_kind string")
    assert [tuple(r) for r in graph.sampled(graph.pattern(t, "x", "name", "n"), "x", "n").collect()] == [("o", "M")]
    items = spark.createDataFrame([("i", "o"), ("j", "zz")], "item string, alias string")
    assert [r.item for r in graph.present(items, t).collect()] == ["i"]
    assert graph.optional(graph.pattern(t, "x", "p", "y"), graph.pattern(t, "y", "name", "n"), "y").count() == 2
