import pytest
from pyspark.sql import functions as F

from loomgraph.functions import identifiers as ids
from loomgraph.functions import names, nt, similarity, text
from loomgraph.operators.csv_graph import person_cell
from loomgraph.sources import bibtex


def mapped(spark, f, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, x string").select("i", f(F.col("x")).alias("y")).orderBy("i").collect()
    return [r.y for r in rows]


def check(spark, f, cases):
    assert mapped(spark, f, list(cases)) == list(cases.values())


BASE = "https://dice-research.org"


def test_canonical_iris(spark):
    check(
        spark,
        lambda x: ids.canonical(x, BASE),
        {
            "https://ror.org/058kzsd48#faculty-kulturwissenschaften": f"{BASE}/id/ror/058kzsd48/faculty-kulturwissenschaften",
            "http://www.wikidata.org/entity/Q42": f"{BASE}/id/wikidata/Q42",
            "https://a.b.org/x?y=1#z w": f"{BASE}/id/a_b_org/x?y=1/z%20w",
            "https://orcid.org/0000-0001": f"{BASE}/id/orcid/0000-0001",
            "https://user@A.org:80/": f"{BASE}/id/a_org",
        },
    )


def test_internal(spark):
    check(spark, lambda x: ids.internal(x, "https://x.org/kg"), {"https://X.org/kg": True, "https://x.org/kg/a": True, "https://x.org/kgb": False, "http://x.org/kg/a": False, "https://x.org:8/kg/a": False, "_:b": False, None: False})


def test_identifiers(spark):
    check(spark, ids.github_repository, {"http://www.github.com/O/R.git/tree/x": "https://github.com/O/R", "https://github.com/O": None, "https://gitlab.com/O/R": None})
    check(spark, ids.link_key, {"<http://doi.org/10.1/AB>": "<https://doi.org/10.1/ab>", '"DOI:10.1/AB"': '"DOI:10.1/ab"'})
    check(spark, ids.orcid, {"https://orcid.org/0000-0002-1825-009X": "0000-0002-1825-009X", "0000-0002 -1825-0097": "0000-0002-1825-0097", "0000-0002-1825-009x": None, "x": None})
    check(spark, ids.first_doi, {"DOI 10.1234/AbC. and": "10.1234/abc", "none": None, "<a>10.1000/x</a>": "10.1000/x", "10.1000/a\\_b": "10.1000/a_b", "10.1000/a{\\textunderscore }b.": "10.1000/a_b", "10.1000/x(open access)": "10.1000/x", "doi: 10.1000/a&#38;lt;b": "10.1000/a<b", "10.1000/": None})
    check(spark, ids.doi_url, {"doi:10.1/A": "https://doi.org/10.1/A", "http://dx.doi.org/10.5/b": "https://doi.org/10.5/b", "": None})
    check(spark, ids.openalex_institution, {"https://openalex.org/i12": "I12", "https://openalex.org/A1": None})
    check(spark, ids.percent, {"a b/ü": "a%20b%2F%C3%BC", "~.x": "~.x", "": ""})
    assert ids.normal_prefix("id/") == "/id" and ids.normal_base("http://x.org/") == "http://x.org"
    with pytest.raises(ValueError):
        ids.normal_base("ftp://x")


def test_names(spark):
    check(spark, text.family_first, {"Ada B. Lovelace": "Lovelace, Ada B.", "Lovelace, Ada": "Lovelace, Ada", "Plato": "Plato"})
    check(spark, names.name_score, {"Müller": 1022, "ab": 2 + 2 - 300, "a{b}c": 5 + 3 - 500})
    check(spark, names.name_repaired, {'M{\\"u}ller': "Müller", "Stra{\\ss}e": "Straße", "A &amp; B": "A & B", "Jos\\'{e}": "José", "Sch ö n": "Schön", None: None, "plain name": "plain name"})
    odd = {
        'M\\"u ller': "Müller", "Stra\\ss e": "Straße", "{\\'{\\i}}x": "íx", "\\'{\\\"u}": "ǘ", "\\\\\\\"{o}l": "öl", "\\c{c}a": "ça", "a\\\\b": "a b", "a\\ b\\,c": "a b c", "R\\&D \\% {X}": "R&D % X",
        "a \\(x\\parallel y\\) b": "a x∥ y b", "{{\\o}re}": "{øre}", "end \\'": "end", "end {\\": "end", "\\&amp;": "&", "{}a{b}": "ab", "\\{x\\}": "x", " a  b ": "a b", "\\{": "{",
    }
    check(spark, names.name_repaired, odd)
    check(spark, names.problem_name_repaired, {'J\\"{u}rgen': "Jürgen", 'f \\" u r': "für", "Gro\\ss e": "Große", "Wei \\ss": "Wei ß", "M ü ller": "Müller", "Ö sterreich": "Ö sterreich", "K önig": "König", "Jü ürgen": "Jüürgen", "Hans- Peter": "Hans-Peter", "forür x , y": "für x, y", "e\u0301": "é", None: None})
    check(spark, names.name_corrupt, {"{\\x}": True, "\\'{e}": False, "\\' ": True, "{\"u}": True, "a\\\\": True})
    check(spark, names.name_corrupt, {"a{b": True, "x\\": True, "fine": False, "\\\" u": True, None: False})
    check(spark, text.title_key, {"A—PAPER!": "apaper", "Größe": "grösse", "ﬁ": "fi"})
    check(spark, text.tokens_estimated, {"": 1, "a": 1, "abc": 1, "abcd": 2})
    check(spark, text.slug, {"Größe & X": "gro-e-x".replace("gro-e", "groe"), "!!": "unknown"})


def test_page_ranges(spark):
    got = mapped(spark, text.pages, ["12--20", "12–20", "e7", "20-12", "12-34-56", "-5", " 7 - 9 ", ""])
    assert [tuple(x) for x in got] == [("12", "20", 9), ("12", "20", 9), ("e7", None, None), ("20", "12", None), ("12", "34-56", None), (None, "5", None), ("7", "9", 3), (None, None, None)]


def test_similarity():
    assert similarity.names_match("Engels, Gregor", "G. Engels") and not similarity.names_match("Engels, Gregor", "Gregor M. Engels")
    assert similarity.indel_ratio("ab", "ab") == 100 and similarity.common_length("abcbdab", "bdcaba") == 4
    assert similarity.token_sort_ratio("b a", "a b") == 100
    assert [m["url"] for m in similarity.mentions("see github.com/a/b. and https://github.com/c")] == ["https://github.com/a/b", "https://github.com/c"]


def test_escapes(spark):
    odd = ["a\"b\\c\nd\r\te", "\\u00e9", "", "x\\", "\x01\x7f\b\f", "\\\\n", "é日🙂"]
    assert mapped(spark, lambda x: nt.unescape(nt.escape(x, "full")), odd) == odd
    check(spark, nt.unescape, {"\\u00E9\\U0001F642": "é🙂", "\\\\n": "\\n", "\\q": "\\q", "\\uD800": "\\uD800", "\\u12": "\\u12", "\\'": "'"})
    check(spark, lambda x: nt.align_key(x, F.lit(None).cast("string")), {"ABC\\u00E9D\\N": '"abc\\u00E9d\\N"'})


def parse(spark, dialect, lines):
    rows = nt.parsed(spark.createDataFrame([(x,) for x in lines], "value string"), dialect).collect()
    return [None if r.s is None else (r.s_kind, r.s, r.p, r.o_kind, r.o, r.o_lang, r.o_dt, r.comment) for r in rows]


def test_dialects(spark):
    good = '<s> <p> "a\\"b"@en .'
    assert parse(spark, "strict", [good + " # c", "", "# x", "<s>\t<p>\t_:b.1 .", '<s> <p> "1"^^<t> .']) == [
        ("iri", "s", "p", "literal", 'a\\"b', "en", None, "# c"), None, None, ("iri", "s", "p", "bnode", "b.1", None, None, None), ("iri", "s", "p", "literal", "1", None, "t", None),
    ]
    with pytest.raises(Exception, match="not a triple"):
        parse(spark, "strict", ["<s> <p> x ."])
    assert parse(spark, "lenient", ["bad", "<s> <p> <o> . # no", "_:x <p> <o>."]) == [None, None, ("bnode", "x", "p", "iri", "o", None, None, None)]
    assert parse(spark, "align", ["<s>\t<p> <o> .", "_:x <p> <o> .", '<s> <p> "L" .']) == [None, None, ("iri", "s", "p", "literal", "L", None, None, None)]
    assert parse(spark, "smush", ["<s> <p> <o> . tail"])[0][-1] == "tail"
    long = '<s> <p> "' + 'a\\n"'.replace('"', "") * 50000 + '" .'
    assert parse(spark, "strict", [long])[0][4].startswith("a\\n")


def test_person_cell():
    assert person_cell("Doe, J (x, UNI-ID: 5, y); B") == [{"name": "Doe, J", "meta": {"token_1": "x", "UNI-ID": "5", "token_3": "y"}}, {"name": "B", "meta": {}}]
    assert person_cell("A (x; B: y) (k v: 1, k: , id:7); C (); (d); E(f) g; H (a: 1) (b: 2)") == [
        {"name": "A (x", "meta": {}}, {"name": "B: y)", "meta": {"token_1": "k v: 1", "token_2": "k:", "id": "7"}},
        {"name": "C ()", "meta": {}}, {"name": "(d)", "meta": {}}, {"name": "E(f) g", "meta": {}}, {"name": "H", "meta": {"a": "1) (b: 2"}},
    ]


def test_people(spark):
    check(
        spark,
        bibtex.people_of,
        {
            "Doe, J., Roe, R.": ["Doe, J.", "Roe, R."],
            "A B and C; D / E & F AND G": ["A B", "C", "D", "E", "F", "G"],
            "Springer Press, A., B, C.": ["Springer Press, A., B, C."],
            "Lab Group, A., Doe, C.": ["Lab Group, A.", "Doe, C."],
            "Doe, Jane, Roe, Rick": ["Doe, Jane, Roe, Rick"],
            'M{\\"u}ller, A. and N/A': ["Müller, A.", "N/A"],
            "": [],
            None: [],
        },
    )
    assert mapped(spark, lambda x: bibtex.people_of(x, paired=False), ["Doe, J., Roe, R."]) == [["Doe, J., Roe, R."]]


BIB = """% head
@article{a b, title = {Gr{\\"o}{\\ss}e}, pages = {1 - 3}, author = "Doe, J., Roe, R."}
@book{k2, title = {Open {brace}, year = {2001},
  doi = {https://doi.org/10.1/X.}
}
@misc(k3, note = bare value, url = {u})
@inproceedings{k4 title={broken},
 year = 1999
@misc{k5, note = {last}}
"""


def test_bibtex():
    rows = [e for e in bibtex.entries(BIB) if e.get("entry_type")]
    assert [e["entry_type"] for e in rows] == ["article", "book", "misc", "inproceedings", "misc"]
    assert {f["name"]: f["value"] for f in rows[0]["fields"]} == {"title": "Größe", "pages": "1--3", "author": "Doe, J., Roe, R."}
    assert {f["name"]: f["value"] for f in rows[2]["fields"]} == {"note": "bare value", "url": "u"}
    assert rows[4]["key"] == "k5" and rows[3]["recovered"] and not rows[0]["recovered"]
    assert "".join(e["raw"] for e in bibtex.entries(BIB)) == BIB
    assert bibtex.repaired_key('M{\\"u}ller (2001)') == "Muller_2001"
    assert bibtex.repaired(bibtex.repaired(BIB)) == bibtex.repaired(BIB)
