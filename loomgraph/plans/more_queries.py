"""More registered queries: each sends whole tables through operators of the library, with the same rows in DuckDB SQL.

The driver's tables hold no bibliography, so records are made of their columns: parts as BibTeX entries and names,
customers as persons and publications, suppliers as institutions, conversations as answers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions import identifiers as ids
from loomgraph.functions import names, nt, payloads, text
from loomgraph.operators import answers, bib_graph, cleaning, csv_graph, enrich, graph, ledger, linking, offline, people, projects, publications
from loomgraph.plans.queries import BASE, query
from loomgraph.plans.scratch import folder
from loomgraph.sources import bibtex, bibtex_edit, sinks, tables

S = "https://schema.org/"
RDF = graph.RDF_TYPE


def made(*parts) -> Column:
    """A text of constants and columns."""
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def bib_files(t) -> DataFrame:
    """file, value: the parts of a brand as one BibTeX file, each entry after a comment with its database id."""
    key = F.replace("p_name", F.lit(" "), F.lit("_"))
    entry = made("% DBID: ", F.col("p_partkey"), "\n@article{", key, ",\n  title = {The {", F.col("p_name"), "}},\n  year = 2001, pages = {1 -- ", F.col("p_size"), "},\n  author = \"N", F.col("p_size"), " and Doe, J., Roe, R.\"\n}\n")
    rows = t("part").select(F.col("p_brand").alias("file"), F.struct("p_partkey", entry.alias("e")).alias("x"))
    return rows.groupBy("file").agg(F.array_join(F.transform(F.array_sort(F.collect_list("x")), lambda x: x["e"]), "").alias("value"))


@query("""select p_brand as file, unnest(['title', 'year', 'pages', 'author']) as name, unnest(['The ' || p_name, '2001', '1--' || p_size, 'N' || p_size || ' and Doe, J., Roe, R.']) as value, replace(p_name, ' ', '_') as key from part""")
def q51_bibtex_scan(t):
    return bibtex.parse_bibtex(bib_files(t)).where("entry_type is not null").select("file", "key", F.inline("fields"))


@query("select p_brand as file, count(*) as n_entries, 0::BIGINT as n_recovered, count(*) as n_text, 4 * count(*) as n_fields from part group by 1")
def q52_bibtex_report(t):
    return bibtex.repair_report(bibtex.parse_bibtex(bib_files(t)).where("entry_type is not null or raw <> '\n'"))


_KEYED = "select p_brand, p_partkey, p_name, replace(p_name, ' ', '_') as k, count(*) over (partition by p_brand, p_name) as n from part"


@query(f"select p_brand as file, p_partkey::VARCHAR as dbid, case when n > 1 then k || '_' || p_partkey else k end as new_key from ({_KEYED})")
def q53_database_ids(t):
    rows = bibtex_edit.with_database_ids(bibtex.parse_bibtex(bib_files(t))).where("entry_type is not null")
    return bibtex.unique_keys(rows).select("file", "dbid", "new_key")


_HASH = "substr(sha1(lower({0})), 1, 12)"
_W = f"'{BASE}/publication/ris/bib/' || replace(p_name, ' ', '_')"


@query(f"""with w as (select distinct {_W} as s, p_name, p_size from part),
a as (select s, '{BASE}/person/hash/' || {_HASH.format('n')} as a, n from (select s, unnest(['N' || p_size, 'Doe, J.', 'Roe, R.']) as n from w))
select s, '{RDF}' as p, '{S}CreativeWork' as o from w union select s, '{S}name', 'The ' || p_name from w union select s, '{S}datePublished', '2001' from w union select s, '{S}identifier', 'bibtex:' || replace(p_name, ' ', '_') from w
union select s, '{S}pageStart', '1' from w union select s, '{S}pageEnd', p_size::VARCHAR from w union select s, '{S}numberOfPages', p_size::VARCHAR from w
union select s, '{S}author', a from a union select a, '{RDF}', '{S}Person' from a union select a, '{S}name', n from a""")
def q54_bibtex_triples(t):
    return bib_graph.bib_triples(bibtex.parse_bibtex(bib_files(t)), BASE).select("s", "p", "o").distinct()


@query("select p_brand as file, count(*) as n, 3 * count(*) as n_fields from part group by 1")
def q55_bibtex_light(t):
    light = bibtex_edit.light_entries(bib_files(t).withColumn("value", F.replace(F.replace("value", F.lit("{The {"), F.lit("{The ")), F.lit("}},"), F.lit("},"))))
    return light.groupBy("file").agg(F.count("*").alias("n"), F.sum(F.size(F.filter("fields", lambda f: f["name"].isin("title", "pages", "year")))).alias("n_fields"))


@query("select p_partkey, '@article{' || replace(p_name, ' ', '_') || ', title = {x}' as value from part")
def q56_bibtex_keys(t):
    lines = t("part").select("p_partkey", made("@article{", F.col("p_name"), ", title = {x}").alias("value"))
    return bibtex_edit.keys_rewritten(lines).select("p_partkey", "value")


@query("select p_partkey, 'x = {Größe ' || p_name || '}, doi = \"10.1/' || p_partkey || '\", n = ' || p_size as value, 2 as changed from part")
def q57_bibtex_values(t):
    files = t("part").select(F.col("p_partkey").cast("string").alias("file"), made('x = {Gr{\\"o}{\\ss}e ', F.col("p_name"), '}, doi = "https://doi.org/10.1/', F.col("p_partkey"), '.", n = ', F.col("p_size")).alias("value"))
    return bibtex_edit.rewritten_files(files).select(F.col("file").cast("long").alias("p_partkey"), "value", "changed")


@query("select page_id, url as address from pages")
def q58_bibtex_urls(t):
    fields = F.array(F.struct(F.lit("url").alias("name"), made("{{", F.replace("url", F.lit("_"), F.lit("\\_")), "}}").alias("value")), F.struct(F.lit("bdsk-url-1").alias("name"), F.col("url").alias("value")), F.struct(F.lit("note").alias("name"), F.lit("http://no.org").alias("value")))
    return t("pages").select("page_id", F.explode(bibtex_edit.candidate_urls(fields)).alias("address"))


def publication_rows(t) -> DataFrame:
    c, key = t("customer"), F.col("c_custkey")
    return c.select(
        key.cast("string").alias("id"), F.col("c_name").alias("titel"), F.lit("EN; de").alias("sprachen"), (F.col("c_nationkey") + 2000).cast("string").alias("jahr"), F.lit("Konferenzbeitrag").alias("publikationstyp"), F.lit("").alias("dokumententyp"),
        F.lit("x; y").alias("keywords"), F.col("c_mktsegment").alias("fachzeitschrift"), F.lit("CC_BY_4_0").alias("lizenz"), F.when(key % 2 == 0, "Ja").otherwise("nein").alias("peerreviewed"),
        made("DOI: 10.1234/C\\_", key, "; ISSN: 1234-5678; ISBN: 5; URL: http://a.org/", key, "; ?").alias("identifier"),
        F.when(key % 3 == 0, made("Doe, J (UNI-ID: ", key, ", r)")).when(key % 3 == 1, made(F.col("c_name"), " (orcid: 0000-0002-1825-0097)")).otherwise(F.col("c_name")).alias("autoren"),
    )


_PUB = f"'{BASE}/id/publication/ris/' || c_custkey"
_PER = f"'{BASE}/id/periodical/' || {_HASH.format('c_mktsegment')}"


@query(f"""with c as (select *, {_PUB} as s, {_PER} as j from customer)
select s, '{RDF}' as p, '{S}ScholarlyArticle' as o, null as tag from c union all select s, '{S}identifier', c_custkey::VARCHAR, null from c union all select s, '{S}name', c_name, 'en' from c union all select s, '{S}datePublished', (2000 + c_nationkey)::VARCHAR, null from c
union all select s, '{S}inLanguage', unnest(['en', 'de']), null from c union all select s, '{S}keywords', unnest(['x', 'y']), 'en' from c union all select j, '{RDF}', '{S}Periodical', null from c union all select j, '{S}name', c_mktsegment, null from c union all select s, '{S}isPartOf', j, null from c
union all select s, '{BASE}/vocab/peerReviewed', case when c_custkey % 2 = 0 then 'true' else 'false' end, null from c union all select s, '{graph.DCTERMS}license', 'https://creativecommons.org/licenses/by/4.0/', null from c union all select s, '{BASE}/vocab/publicationType', 'Konferenzbeitrag', null from c
union all select s, '{S}identifier', unnest(['DOI:10.1234/C\\_' || c_custkey, 'ISSN:1234-5678', 'ISBN:5', 'URL:http://a.org/' || c_custkey, 'UNKNOWN:?']), null from c union all select s, '{S}sameAs', 'https://doi.org/10.1234/C_' || c_custkey, null from c
union all select j, '{S}issn', '1234-5678', null from c union all select s, '{S}isbn', '5', null from c union all select s, '{S}url', 'http://a.org/' || c_custkey, null from c""")
def q59_publications(t):
    return csv_graph.semantic_layer(publication_rows(t), BASE).select("s", "p", "o", F.col("o_lang").alias("tag"))


@query(f"""select {_PUB} as s, '{BASE}/vocab/csv/' || k as p, v as o, case when k = 'jahr' then 'gYear' else '' end as kind from (select c_custkey, unnest(['id', 'titel', 'sprachen', 'jahr', 'publikationstyp', 'keywords', 'fachzeitschrift', 'lizenz', 'peerreviewed']) as k,
unnest([c_custkey::VARCHAR, c_name, 'EN; de', (2000 + c_nationkey)::VARCHAR, 'Konferenzbeitrag', 'x; y', c_mktsegment, 'CC_BY_4_0', case when c_custkey % 2 = 0 then 'Ja' else 'nein' end]) as v from customer)""")
def q60_publication_cells(t):
    rows = publication_rows(t).drop("identifier", "autoren")
    return csv_graph.publication_triples(rows, BASE, semantic=False).select("s", "p", "o", F.coalesce(F.regexp_extract("o_dt", "#(.*)$", 1), F.lit("")).alias("kind"))


_WHO = f"case c_custkey % 3 when 0 then '{BASE}/id/person/uni/' || c_custkey when 1 then 'https://orcid.org/0000-0002-1825-0097' else '{BASE}/id/person/hash/' || substr(sha1(c_name || '|'), 1, 12) end"


@query(f"""with c as (select *, {_PUB} as pub, {_WHO} as w, case when c_custkey % 3 = 0 then 'Doe, J' else c_name end as n from customer)
select w as s, '{RDF}' as p, '{S}Person' as o from c union all select w, '{S}name', n from c union all select w, '{BASE}/vocab/uniId', c_custkey::VARCHAR from c where c_custkey % 3 = 0 union all select w, '{BASE}/vocab/personMeta/token_2', 'r' from c where c_custkey % 3 = 0
union all select w, '{S}sameAs', 'https://orcid.org/0000-0002-1825-0097' from c where c_custkey % 3 = 1 union all select pub, '{S}author', w from c""")
def q61_contributors(t):
    return csv_graph.contributors(publication_rows(t), BASE, "autoren", "author").select("s", "p", "o")


def name_triples(t, o: Column) -> DataFrame:
    none = F.lit(None).cast("string")
    return t("part").select(F.col("p_partkey").alias("line_no"), made("brand/", F.col("p_brand")).alias("s"), F.lit("iri").alias("s_kind"), F.lit("name").alias("p"), o.alias("o"), F.lit("literal").alias("o_kind"), none.alias("o_lang"), none.alias("o_dt"))


@query("select min(p_partkey) as line_no, 'brand/' || p_brand as s, 'Jürgen & ' || p_name as o, 'changed' as state from part group by p_brand, p_name")
def q62_cleaned_names(t):
    rows = name_triples(t, nt.escape(made('J\\"{u}rgen \\&amp;  ', F.col("p_name")), "full"))
    return cleaning.cleaned_names(rows, "name", dedupe=True).select("line_no", "s", "o", "state")


@query("select p_partkey as line_no, 'für Große ' || p_name || ', Hans-Peter' as o, true as changed, 0 as n_reasons from part")
def q63_problem_names(t):
    rows = name_triples(t, nt.escape(made('f \\"u r Gro\\ss e ', F.col("p_name"), " , Hans- Peter"), "full"))
    return cleaning.problem_names(rows, "name").select("line_no", "o", "changed", F.size("reasons").alias("n_reasons"))


@query("select user_id::VARCHAR as k, max_by(event_type, event_id) as v, max(event_id) as t from events group by 1")
def q64_upserted(t):
    kv = t("events").select(F.col("user_id").cast("string").alias("k"), F.col("event_type").alias("v"), F.col("event_id").alias("t"))
    kv = kv.withColumn("new", F.col("t") % 2 == 1)
    newest = lambda df: df.groupBy("k").agg(F.max_by("v", "t").alias("v"), F.max("t").alias("t"))
    return enrich.upserted(newest(kv.where("not new")), newest(kv.where("new")))


_LETTERS = "translate(c_custkey::VARCHAR, '0123456789', 'abcdefghij')"


@query("""select c_nationkey as paper, 'A' || c_custkey as author, case when c_custkey % 7 = 0 then '' else 'P' || c_custkey end as persons,
case when c_custkey % 7 = 0 then 'unresolved' when c_custkey % 5 = 0 then 'explicit_map' when c_custkey % 3 = 0 then 'identifier' else 'unique_name' end as status from customer""")
def q65_author_matching(t):
    c = t("customer").select("c_nationkey", "c_custkey", F.translate(F.col("c_custkey").cast("string"), "0123456789", "abcdefghij").alias("letters"))
    key = F.col("c_custkey")
    authors = c.select(F.col("c_nationkey").alias("paper"), made("A", key).alias("author"), F.lit(None).cast("string").alias("orcid"), made("Ada B. ", F.col("letters")).alias("name"))
    known = c.where(key % 7 != 0).withColumn("person", made("P", key))
    t3 = lambda p, o, kind: F.struct(F.col("person").alias("s"), F.lit(S + p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"))
    facts = known.select(F.inline(F.array_compact(F.array(F.when(key % 3 == 0, t3("sameAs", made("A", key), "iri")), F.when(key % 3 != 0, t3("name", made(F.initcap("letters"), ", A. Berta"), "literal"))))))
    records = people.person_records(facts, known)
    explicit = c.where(key % 5 == 0).select(made("A", key).alias("author"), made("P", key).alias("person"))
    found = people.author_candidates(authors, known.select(F.col("c_nationkey").alias("paper"), "person"), records, explicit)
    return people.author_report(authors, found)


def institution_rows(t) -> tuple[DataFrame, DataFrame, DataFrame]:
    key = F.col("s_suppkey")
    s = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    org, other = made("http://kg.org/", key), made("https://openalex.org/I", key)
    rows = s.select(org.alias("institution"), made("Fallback ", key).alias("name"), F.array(other).alias("aliases"), made("I", key).alias("openalex_id"))
    code = F.expr("char(65 + n_nationkey)")
    place = F.struct(made("City of ", F.col("n_name")).alias("city"), F.lit("").alias("country"), made(F.lower(code), "x").alias("country_code"), (key / 2.0).alias("latitude"), F.lit(7.25).alias("longitude"))
    inst = F.struct(other.alias("id"), made("https://ror.org/", key).alias("ror"), F.col("s_name").alias("display_name"), place.alias("geo"))
    payload = F.when(key % 4 == 1, F.to_json(inst)).otherwise(F.to_json(F.struct(F.when(key % 4 == 2, "not_found").otherwise("ok").alias("status"), other.alias("openalex_sameas"), F.when(key % 4 != 2, inst).alias("institution"))))
    cache = s.where(key % 4 != 0).select(org.alias("k"), payload.alias("v"))
    continents = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select(made(code, "X").alias("code"), F.col("r_name").alias("continent"))
    return rows, cache, continents


_INST = "(select 'http://kg.org/' || s_suppkey as s, * from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey where s_suppkey % 4 in (1, 3))"


@query(f"""select s, '{RDF}' as p, '{S}Organization' as o from {_INST} union all select s, '{S}name', s_name from {_INST} union all select s, '{S}sameAs', unnest(['https://openalex.org/I' || s_suppkey, 'https://ror.org/' || s_suppkey]) from {_INST}
union all select s, '{S}addressCountry', chr(65 + n_nationkey) || 'X' from {_INST} union all select s, '{S}addressLocality', 'City of ' || n_name from {_INST} union all select s, '{S}continent', r_name from {_INST}
union all select s, '{S}latitude', (s_suppkey / 2.0)::VARCHAR from {_INST} union all select s, '{S}longitude', '7.25' from {_INST}""")
def q66_institutions(t):
    rows, cache, continents = institution_rows(t)
    return enrich.institution_triples(enrich.institution_records(rows, cache), continents).select("s", "p", "o")


@query("select 'http://kg.org/' || s_suppkey as institution, ['cache_miss', 'ok', 'not_found', 'ok'][s_suppkey % 4 + 1] as status, (s_suppkey % 4 <> 0)::VARCHAR as cache_hit from supplier")
def q67_institution_report(t):
    rows, cache, _ = institution_rows(t)
    return sinks.report_rows(enrich.institution_records(rows, cache), "affiliation")


@query("""with l as (select conv_id % 9 as d, sum(length(text)) as n from conversations where role = 'user' group by 1), p as (select *, sum(greatest(1, (length(text) + 2) // 3) + 10) over (order by conv_id, turn)::BIGINT as running from conversations where role <> 'user')
select conv_id, turn, running from p where running <= 60000 - (select coalesce(sum(n), 0) from l where d = 3)""")
def q68_ledger(t):
    c = t("conversations")
    spent = c.where("role = 'user'").select((F.col("conv_id") % 9).cast("string").alias("day"), F.lit(None).cast("long").alias("input_tokens"), F.lit(None).cast("long").alias("output_tokens"), F.length("text").cast("long").alias("total_tokens"))
    rows = c.where("role <> 'user'").withColumnRenamed("text", "llm_prompt")
    return ledger.affordable(rows, spent, "3", 60_000, ["conv_id", "turn"], reserve=10).select("conv_id", "turn", "running")


@query("select conv_id, turn, trim(text, ' ' || chr(9) || chr(10) || chr(13)) as answer, length(text)::BIGINT as used from conversations")
def q69_model_output(t):
    x, n = F.col("text"), F.length("text")
    block = F.array(F.struct(x.alias("text")))
    by_turn = F.when(F.col("turn") % 4 == 0, F.to_json(F.struct(x.alias("output_text"), F.struct(n.alias("total_tokens")).alias("usage"))))
    by_turn = by_turn.when(F.col("turn") % 4 == 1, F.to_json(F.struct(F.array(F.struct(block.alias("content"))).alias("output"), F.struct(n.alias("total_tokens")).alias("usage"))))
    by_turn = by_turn.when(F.col("turn") % 4 == 2, F.to_json(F.struct(F.array(F.struct(F.struct(x.alias("content")).alias("message"))).alias("choices"), F.struct(n.alias("total_tokens")).alias("usage"))))
    by_turn = by_turn.otherwise(F.to_json(F.struct(F.array(F.struct(F.struct(block.alias("content")).alias("message"))).alias("choices"), F.struct(n.alias("total_tokens")).alias("usage"))))
    rows = t("conversations").withColumn("payload", by_turn)
    return rows.select("conv_id", "turn", payloads.output_text(F.col("payload")).alias("answer"), payloads.usage_tokens(F.col("payload"))["total"].alias("used"))


_OFF = "(select p_partkey as k, p_name, p_partkey % 4 as m from part)"


@query(f"""select 'pub/' || k as s, '{S}identifier' as p, 'DOI:10.1234/' || k as o from {_OFF} where m in (0, 2) union all select 'who/' || k, '{S}sameAs', 'A' || k from {_OFF} where m < 3 union all select 'who/' || k, '{S}affiliation', unnest(['Uni ' || k, 'Lab']) from {_OFF} where m < 3""")
def q70_offline(t):
    return offline.enriched(*offline_tables(t))[0].select("s", "p", "o")


@query("select count(*) as publications, count(*) filter (p_partkey % 4 < 3) as with_work, count(*) filter (p_partkey % 4 in (0, 2)) as dois_added, count(*) filter (p_partkey % 4 < 3) as authors_enriched from part")
def q71_offline_counts(t):
    return offline.enriched(*offline_tables(t))[1]


def offline_tables(t) -> tuple[DataFrame, ...]:
    """Publications by DOI (even keys), by identifier (1 of 4), by title alone (2 of 4), and without a work (3 of 4)."""
    p, k = t("part"), F.col("p_partkey")
    m = k % 4
    title = made("Paper on ", F.col("p_name"), " ", k)
    doi = made("https://doi.org/10.1234/", k)
    pubs = p.select(made("pub/", k).alias("pub"), title.alias("title"), F.when(m == 0, made("http://doi.org/10.1234/", k)).alias("doi_sameas"), F.when(m == 1, made("DOI:10.1234/", k)).alias("doi_ident"))
    raw = F.array(*(F.struct(x.alias("raw_affiliation_string")) for x in (made("Uni ", k), F.lit(" Lab "), made("Uni ", k), F.lit(""))))
    author = lambda i, n: F.struct(i.alias("id"), n.alias("display_name"))
    entries = F.array(F.struct(author(F.lit("B"), F.lit("Someone Else")).alias("author"), raw.alias("affiliations")), F.struct(author(made("A", k), made("N", k, " Family")).alias("author"), raw.alias("affiliations")))
    work = F.struct(made("W", k).alias("id"), doi.alias("doi"), title.alias("display_name"), entries.alias("authorships"))
    works = p.where(m < 2).select(F.when(m == 0, made("work::", doi, "::xpac=True")).otherwise(made("work::http://doi.org/10.1234/", k, "::xpac=True")).alias("k"), F.to_json(work).alias("v"))
    other = F.struct(F.lit("X").alias("id"), F.lit("Nothing like it at all").alias("display_name"))
    hits = F.concat(F.lit("["), F.to_json(other), F.lit(","), F.to_json(work), F.lit("]"))
    searches = p.where(m == 2).select(made("search::10::xpac=True::", title).alias("k"), hits.alias("v"))
    return pubs, works, searches, p.select(made("pub/", k).alias("pub"), made("who/", k).alias("person"), made("Family N", k).alias("name"))


@query("select distinct o_orderpriority as s, 'p' as p, o_orderstatus as o from orders where o_orderpriority in ('1-URGENT', '5-LOW') and o_orderstatus <> 'P'")
def q72_named_graphs(t):
    o = t("orders").select(F.col("o_orderpriority").alias("s"), F.lit("p").alias("p"), F.col("o_orderstatus").alias("o"), "o_orderkey")
    quads = graph.in_graphs(default=o.where("o_orderkey % 2 = 0").drop("o_orderkey"), other=o.where("o_orderkey % 2 = 1").drop("o_orderkey"))
    old = o.where("o = 'P'").drop("o_orderkey")
    return graph.without_existing(graph.of_values(graph.any_graph(quads), "s", ["1-URGENT", "5-LOW"]), old)


@query(f"""select 'pub/' || o_orderkey as s, '{S}identifier' as p, 'DOI:10.1/' || o_orderkey as o from orders where o_orderkey % 2 = 0 union all select 'pub/' || o_orderkey, '{S}url', 'http://a.org/' || o_orderkey || '.pdf' from orders where o_orderkey % 3 <> 0 union all select 'pub/' || o_orderkey, '{S}about', unnest(['https://openalex.org/fields/' || o_custkey, 'https://openalex.org/subfields/1']) from orders""")
def q73_publication_facts(t):
    o, key = t("orders"), F.col("o_orderkey")
    topic = F.array(made("https://openalex.org/fields/", F.col("o_custkey"), "/"), F.lit("https://openalex.org/subfields/1"), F.lit("https://openalex.org/topics/T1"), F.lit("https://openalex.org/subfields/1"))
    topics = enrich.topics(o.select(made("pub/", key).alias("paper"), topic.alias("topics"))).groupBy("paper").agg(F.collect_set("topic").alias("topics"))
    url = F.when(key % 3 == 0, made("http://a.org/a b", key)).otherwise(made("http://a.org/", key, ".pdf"))
    rows = o.select(made("pub/", key).alias("pub"), made("doi:10.1/", key).alias("doi"), url.alias("pdf_url"), (key % 2 == 1).alias("has_doi")).join(topics.withColumnRenamed("paper", "pub"), "pub")
    return publications.publication_facts(rows).select("s", "p", "o")


@query("select o_custkey as pub, min_by('http://a.org/' || o_orderkey || case when o_orderkey % 3 = 0 then '.pdf' else '' end, (case when o_orderkey % 3 = 0 then 0 else 1 end, o_orderkey)) as pdf_url from orders group by 1")
def q74_preferred_pdf(t):
    key = F.col("o_orderkey")
    return publications.preferred_pdfs(t("orders").select(key.alias("line_no"), F.col("o_custkey").alias("pub"), made("http://a.org/", key, F.when(key % 3 == 0, ".pdf").otherwise("")).alias("pdf_url")))


@query(f"""with a as (select '{BASE}/author/dblp/' || s_nationkey || '_' || s_suppkey as w, 'paper/' || s_nationkey as pub, * from supplier where s_suppkey % 3 <> 0)
select w as s, '{RDF}' as p, '{S}Person' as o from a union all select w, '{S}name', s_name from a union all select w, '{S}sameAs', 'https://dblp.org/pid/' || s_nationkey || '/' || s_suppkey || '.html' from a union all select pub, '{S}author', w from a union all select w, '{S}affiliation', unnest(['Uni', 'Lab']) from a""")
def q75_external_authors(t):
    s, key = t("supplier"), F.col("s_suppkey")
    paper = made("paper/", F.col("s_nationkey"))
    rows = s.select(paper.alias("paper"), F.col("s_name").alias("name"), made("https://dblp.org/pid/", F.col("s_nationkey"), "/", key, ".html").alias("pid_url"), F.array(F.lit("Uni "), F.lit("Lab"), F.lit("Uni"), F.lit("")).alias("affiliations"))
    return publications.external_authors(rows, s.where(key % 3 == 0).select(paper.alias("paper"), F.col("s_name").alias("name")), BASE).select("s", "p", "o")


@query(f"""with o as (select 'who/' || c_custkey as s, case c_custkey % 3 when 0 then 'https://ror.org/' || c_nationkey when 1 then 'I' || c_nationkey else '{BASE}/id/org/' || sha1('org::' || lower(c_mktsegment) || '|de') end as org, * from customer)
select distinct s, '{S}affiliation' as p, org as o from o union select org, '{RDF}', '{S}Organization' from o union select org, '{S}name', c_mktsegment from o union select org, '{S}addressCountry', 'DE' from o union select org, '{S}sameAs', 'I' || c_nationkey from o where c_custkey % 3 = 0""")
def q76_affiliations(t):
    c, key = t("customer"), F.col("c_custkey")
    rows = c.select(made("who/", key).alias("person"), F.when(key % 3 != 2, made("I", F.col("c_nationkey"))).alias("id"), F.when(key % 3 == 0, made("https://ror.org/", F.col("c_nationkey"))).otherwise("").alias("ror"), F.col("c_mktsegment").alias("name"), F.lit("DE").alias("code"))
    return enrich.affiliations(rows, BASE).select("s", "p", "o").distinct()


@query("""select c_custkey, '10.1234/c_' || c_custkey as doi, 'https://doi.org/10.1234/C_' || c_custkey as doi_address, '0000-0002-1825-' || lpad((c_custkey % 10000)::VARCHAR, 4, '0') as orcid, 'https://github.com/Owner/r' || c_custkey as repository, 'I' || c_custkey as institution,
'9/' || c_custkey as pid, 'A paper by ' || replace(c_name, '#', ' ') as search, c_custkey % 2 = 0 as writable, lower(regexp_replace(c_name, '[^A-Za-z0-9]+', '-', 'g')) as slug, replace(lower(c_name), '#', ' ') as plain, replace(lower(c_name), '#', '') as key from customer""")
def q78_identifiers(t):
    c, n = F.col("c_custkey"), F.col("c_name")
    return t("customer").select(
        "c_custkey", ids.first_doi(made("<b>DOI</b>: https://doi.org/10.1234/C\\_", c, "(open access). ")).alias("doi"), ids.doi_url(made("doi:10.1234/C_", c)).alias("doi_address"), ids.orcid(made("https://orcid.org/0000-0002-1825-", F.lpad((c % 10000).cast("string"), 4, "0"))).alias("orcid"),
        ids.github_repository(made("http://www.github.com/Owner/r", c, ".git/issues")).alias("repository"), ids.openalex_institution(made("https://openalex.org/i", c, "/")).alias("institution"), ids.dblp_pid(made("https://dblp.org/pid/9/", c, ".html")).alias("pid"),
        ids.search_text(made(" A “paper” | by—", n, "?! ")).alias("search"), ids.serializable(made("http://a.org/", F.when(c % 2 == 0, "x").otherwise("x y"))).alias("writable"), text.slug(n).alias("slug"), text.plain_text(n).alias("plain"), text.title_key(made(n, "—")).alias("key"),
    )


@query("with p as (select min('part/' || p_partkey) as u1, lower(p_name) as l, p_brand from part where p_size > 5 group by p_name, p_brand) select a.u1, 'part/' || p_partkey as u2, 1.0::DOUBLE as conf from part join p a on lower(p_name) = l and part.p_brand = a.p_brand where p_size > 5 and 'part/' || p_partkey <> a.u1")
def q79_labelled_links(t):
    row = lambda p, o: F.struct(F.lit(p).alias("p"), o.alias("o"))
    both = F.array(row("label", F.concat_ws(" ", "p_name", "p_brand")), row("label", F.lit("second label")), row("type", F.when(F.col("p_size") > 5, "Wanted").otherwise("Other")))
    rows = t("part").select(made("part/", F.col("p_partkey")).alias("s"), F.posexplode(both).alias("i", "x")).select("s", "x.*", F.col("i").alias("line_no"))
    rows = rows.withColumn("key", F.when(F.col("p") == "label", nt.align_key(F.col("o"), F.lit(None).cast("string"))))
    seen = linking.labelled(rows, "label", ["Wanted"], "type")
    links = linking.same_label(seen.where("typed"))
    lines = links.select(F.concat(nt.iri(F.col("u1")), F.lit("\t"), nt.iri(F.col("u2")), F.lit("\t"), F.col("conf").cast("string")).alias("value"))
    return linking.read_links(lines)


@query(f"""with p as (select '{BASE}/project/' || p_partkey as s, '{BASE}/funding-program/erasmus-cooperation-2021-2027' as u, p_name from part)
select s, '{RDF}' as p, '{S}ResearchProject' as o from p union all select s, '{S}name', p_name from p union all select s, '{S}startDate', '2022-01-01' from p union all select s, '{S}funding', u from p union all
select distinct u, unnest(['{RDF}', '{S}name', '{S}alternateName', '{S}startDate', '{S}endDate']), unnest(['{S}FundingScheme', 'Erasmus+ Cooperation', 'Erasmus + 2021-2027 Cooperation', '2021', '2027']) from p""")
def q80_projects(t):
    none = F.lit("")
    rows = t("part").select(F.col("p_partkey").alias("row_no"), F.col("p_partkey").cast("string").alias("number"), F.col("p_name").alias("title"), none.alias("short"), F.lit("2022-01-01").alias("begin"), F.lit("soon").alias("end"), F.lit("Erasmus + 2021-2027 Cooperation").alias("funding"))
    return projects.project_triples(rows, BASE).select("s", "p", "o")


@query("select c_custkey as project, unnest([0, 1])::INTEGER as start, unnest([c_mktsegment || ', GmbH', n_name]) as raw, unnest(['seg/' || c_mktsegment, 'nation/' || n_nationkey]) as uri from customer join nation on c_nationkey = n_nationkey".replace("unnest([0, 1])", "unnest([0, 2])"))
def q81_partners(t):
    c = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = c.select(F.col("c_custkey").alias("project"), F.concat_ws(", ", "c_mktsegment", F.lit("GmbH"), "n_name", F.lit("Unknown")).alias("partners"))
    orgs = t("customer").select(made("seg/", F.col("c_mktsegment")).alias("uri"), made(F.col("c_mktsegment"), ", GmbH").alias("n")).distinct().unionByName(t("nation").select(made("nation/", F.col("n_nationkey")).alias("uri"), F.col("n_name").alias("n")))
    orgs = orgs.select("uri", text.plain_text(F.col("n")).alias("norm"), F.xxhash64("uri").alias("position"))
    return projects.matched_partners(rows, orgs).select("project", "start", "raw", "uri")


@query("select p_partkey, p_name as name, 'a' || chr(9) || 'b' as odd from part".replace("'a' || chr(9) || 'b'", "'a,b'"))
def q82_table_roundtrip(t):
    spark = t("part").sparkSession
    path = folder(spark, "table-roundtrip")
    sinks.write_table(t("part").select("p_partkey", F.col("p_name").alias("name"), F.lit("a,b").alias("odd")), path)
    return tables.read_csv(spark, path, ["p_partkey", "name"]).select(F.col("p_partkey").cast("long").alias("p_partkey"), "name", "odd")


@query("select row_number() over (order by 'part/' || lpad(p_partkey::VARCHAR, 9, '0')) as line_no, '<part/' || lpad(p_partkey::VARCHAR, 9, '0') || '> <name> \"' || p_name || '\"@en .' as value from part")
def q83_sorted_lines(t):
    """Sorted triples written to one file and read back with the numbers of their lines."""
    spark = t("part").sparkSession
    path = folder(spark, "sorted-lines")
    rows = t("part").select(made("part/", F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("s"), F.lit("iri").alias("s_kind"), F.lit("name").alias("p"), F.col("p_name").alias("o"), F.lit("literal").alias("o_kind"), F.lit("en").alias("o_lang"), F.lit(None).cast("string").alias("o_dt"))
    sinks.write_triples(rows.unionByName(rows), path, "sorted", one_file=True)
    return tables.numbered_lines(spark, path).select("line_no", "value")


@query("select event_type, count(*) filter (value >= 50) as high, count(*) filter (value < 50) as low from events group by 1")
def q84_counters(t):
    kinds = [r.event_type for r in t("events").select("event_type").distinct().collect()]
    one = lambda k: sinks.counted(t("events").where(F.col("event_type") == k), high=F.col("value") >= 50, low=F.col("value") < 50).withColumn("event_type", F.lit(k))
    out = None
    for k in kinds:
        out = one(k) if out is None else out.unionByName(one(k))
    return out


_AUTH = f"'paper/' || s_nationkey || '/authorship/P' || s_suppkey"


@query(f"""with a as (select *, {_AUTH} as n, 'paper/' || s_nationkey as pub, 'http://p.org/P' || s_suppkey as who, '{BASE}/ror/r' || s_suppkey as org, '{enrich.VOCAB}' as v from supplier)
select distinct pub as s, '{enrich.PROVENANCE}' as p, 'W' || s_nationkey as o from a union select pub, v || 'authorship', n from a union select n, '{RDF}', v || 'Authorship' from a union select n, v || 'paper', pub from a union select n, '{enrich.PROVENANCE}', 'W' || s_nationkey from a
union select n, v || 'author', who from a union select pub, '{S}author', who from a union select who, '{RDF}', '{S}Person' from a union select who, '{S}name', s_name from a union select n, v || 'authorOrder', (row_number() over (partition by s_nationkey order by s_suppkey))::VARCHAR from a
union select n, v || 'authorPosition', 'middle' from a union select n, v || 'isCorresponding', case when s_suppkey % 2 = 0 then 'true' else 'false' end from a union select n, v || 'sourcePublicationDate', '2020-01-02' from a union select n, v || 'sourcePublicationYear', '2020' from a
union select n, v || 'rawAffiliation', 'Uni' from a union select n, v || 'affiliation', org from a union select org, '{RDF}', '{S}Organization' from a union select org, '{S}sameAs', unnest(['https://ror.org/r' || s_suppkey, 'I' || s_suppkey]) from a union select org, '{S}name', 'Org' from a""")
def q85_authorship_triples(t):
    k = F.col("s_suppkey")
    inst = F.array(F.struct(made("I", k).alias("id"), made("https://ror.org/r", k).alias("ror"), F.lit("Org").alias("name")))
    one = F.struct(k.alias("k"), made("A", k).alias("author"), made("http://p.org/P", k).alias("person"), F.col("s_name").alias("name"), F.lit("middle").alias("position"), (k % 2 == 0).alias("corresponding"), F.array(F.lit("Uni"), F.lit("Uni")).alias("affiliations"), inst.alias("institutions"))
    works = t("supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list(one)).alias("authorships"))
    rows = works.select(made("paper/", F.col("s_nationkey")).alias("paper"), made("W", F.col("s_nationkey")).alias("work"), F.lit("2020-01-02").alias("date"), F.lit("2020").alias("year"), F.transform("authorships", lambda a: a.dropFields("k")).alias("authorships"))
    return enrich.authorships(rows, BASE).select("s", "p", "o")


@query("select p_partkey as id, p_partkey as hit from part")
def q86_picked_publications(t):
    """By an equal DOI for even keys; for odd ones by the title, where the year decides between equal titles."""
    p, k = t("part"), F.col("p_partkey")
    wanted = p.select(k.alias("id"), made("On ", F.col("p_name"), " ", k).alias("title"), F.lit("2001").alias("year"), F.when(k % 2 == 0, made("10.1/", k)).alias("doi"))
    hit = lambda i, title, year, doi, h: F.struct(F.lit(i).alias("position"), h.alias("hit"), title.alias("hit_title"), F.lit(year).alias("hit_year"), doi.alias("hit_doi"))
    none = F.lit(None).cast("string")
    hits = F.array(hit(0, F.lit("Something else"), "2001", none, -k), hit(1, F.col("title"), "1990", none, -k - 1), hit(2, F.when(F.col("id") % 2 == 0, "Other words here").otherwise(F.upper("title")), "2001", F.upper("doi"), k))
    hits = F.array(*(F.struct(h["position"].alias("position"), h["hit"].alias("hit"), h["hit_title"].alias("hit_title"), h["hit_year"].alias("hit_year"), h["hit_doi"].alias("hit_doi")) for h in (hits[0], hits[1], hits[2])))
    rows = wanted.withColumn("p_partkey", F.col("id")).select("id", "title", "year", "doi", F.inline(hits.cast("array<struct<position:int,hit:bigint,hit_title:string,hit_year:string,hit_doi:string>>")))
    return publications.picked_publication(rows)
