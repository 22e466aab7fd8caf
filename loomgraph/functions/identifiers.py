"""Minting and normalising of IRIs, DOIs, ORCIDs and other identifiers. Column expressions; Arrow only for entities."""

from __future__ import annotations

import html

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomgraph.functions.nt import strip
from loomgraph.functions.text import arrow

#: RFC 3986, appendix B: 2 scheme, 4 authority, 5 path, 7 query, 9 fragment.
URI = r"^(([^:/?#]+):)?(//([^/?#]*))?([^?#]*)(\?([^#]*))?(#(.*))?"


def part(x: Column, i: int) -> Column:
    return F.regexp_extract(x, URI, i)


def host(x: Column) -> Column:
    return F.lower(F.regexp_replace(F.regexp_replace(part(x, 4), r"^[^@]*@", ""), r":[0-9]*$", ""))


def port(x: Column) -> Column:
    return F.regexp_extract(part(x, 4), r":([0-9]+)$", 1)


def joined(base: str | Column, path: str | Column) -> Column:
    """base and path with one slash between."""
    base, path = (c if isinstance(c, Column) else F.lit(c) for c in (base, path))
    return F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), F.regexp_replace(path, "^/+", ""))


def hash12(x: Column) -> Column:
    return F.substring(F.sha1(x.cast("binary")), 1, 12)


def named_iri(base: str, kind: str, name: Column) -> Column:
    """An IRI by the hash of a trimmed lower-case name: organisations, periodicals."""
    return joined(base, F.concat(F.lit(f"id/{kind}/"), hash12(F.lower(strip(name)))))


def percent(x: Column, safe: str = "") -> Column:
    """Percent-encoding of all but unreserved characters and those in safe."""
    keep = r"^[A-Za-z0-9_.~-]$"
    coded = F.transform(F.split(x, ""), lambda c: F.when((c == "") | c.rlike(keep) | F.contains(F.lit(safe), c), c).otherwise(F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1")))
    return F.when(x.rlike(r"^[A-Za-z0-9_.~-]*$"), x).otherwise(F.array_join(coded, ""))


def internal(x: Column, base: str) -> Column:
    """Whether an IRI lies under the base: equal scheme, host and port, and its path or one below."""
    b, path = F.lit(base), F.regexp_replace(part(F.lit(base), 5), "/+$", "")
    there = (part(x, 2) != "") & (part(x, 4) != "") & (F.lower(part(x, 2)) == F.lower(part(b, 2))) & (host(x) == host(b)) & (port(x) == port(b))
    return F.coalesce(there & ((path == "") | (part(x, 5) == path) | part(x, 5).startswith(F.concat(path, F.lit("/")))), F.lit(False))


def canonical(x: Column, base: str, prefix: str = "/id") -> Column:
    """The canonical IRI of an external one: source, then identifier, then the encoded fragment."""
    h, path, query, fragment = host(x), part(x, 5), part(x, 7), part(x, 9)
    bare = F.regexp_replace(path, "^/", "")
    wikidata = h.isin("wikidata.org", "www.wikidata.org") & path.startswith("/entity/")
    source = F.when(h == "ror.org", "ror").when(wikidata, "wikidata").when(h == "orcid.org", "orcid").otherwise(F.replace(F.coalesce(*(F.when(c != "", c) for c in (h, part(x, 4), part(x, 2))), F.lit("unknown")), F.lit("."), F.lit("_")))
    last = F.regexp_extract(path, "([^/]+)/*$", 1)
    ident = F.when(wikidata, last).when(h.isin("ror.org", "orcid.org"), bare).otherwise(F.concat(bare, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))
    tail = lambda c: F.when(c != "", F.concat(F.lit("/"), c)).otherwise("")
    return F.concat(F.lit(base + prefix + "/"), source, tail(ident), tail(percent(fragment)))


def rewritten(x: Column, base: str, prefix: str = "/id") -> Column:
    """The canonical IRI, null for an internal one."""
    return F.when(~internal(x, base), canonical(x, base, prefix))


def normal_base(base: str) -> str:
    """Driver-side: a base without trailing slash; raises unless it is http(s) with a host and no query or fragment."""
    import re

    m = re.match(URI, base)
    if m[2] not in ("http", "https") or not m[4] or m[6] or m[8]:
        raise ValueError(f"not a base IRI: {base!r}")
    return base.rstrip("/")


def normal_prefix(prefix: str) -> str:
    return "/" + prefix.strip("/") if prefix.strip("/") else ""


def http_iri(x: Column) -> Column:
    """Whether it is an absolute http(s) IRI without characters that N-Triples forbids."""
    return x.rlike(r"^https?://[^/]+") & ~x.rlike(r"[\s<>\"{}|^`\\\x00-\x20]")


def serializable(x: Column) -> Column:
    return F.coalesce((x != "") & ~x.rlike(r"[<>\" {}|\\^`]"), F.lit(False))


def csv_doi(x: Column) -> Column:
    """Case kept: without ``doi:``, underscores restored, spaces out."""
    out = F.regexp_replace(F.trim(x), r"(?i)^doi:\s*", "")
    return F.replace(F.replace(F.replace(out, F.lit("\\textunderscore"), F.lit("_")), F.lit("\\_"), F.lit("_")), F.lit(" "), F.lit(""))


def first_doi(x: Column) -> Column:
    """The first DOI of a BibTeX value in lower case, null without one. Tags, entities (twice encoded too), encoded
    underscores and remarks on open access go first; a DOI ends at space or quote, without closing ``.,;``."""
    t = strip(F.regexp_replace(x, r"<[^>]+>", ""))
    coded = F.contains(t, F.lit("&"))
    t = F.when(coded, arrow(lambda v: html.unescape(html.unescape(v)))(F.when(coded, t))).otherwise(t)
    t = F.replace(F.regexp_replace(t, r"(?i)\{\\textunderscore\s*\}", "_"), F.lit("\\_"), F.lit("_"))
    out = F.regexp_extract(F.regexp_replace(t, r"(?i)\(open access\)", ""), r"(10\.[0-9]{4,9}/[^\s\"]+)", 1)
    return F.lower(F.when(out != "", F.regexp_replace(out, r"[.,;]+$", "")))


def doi_url(x: Column) -> Column:
    """https://doi.org/... of a DOI in any of its written forms, case kept; null if there is none."""
    v = F.trim(x)
    core = F.coalesce(*(F.when(c != "", c) for c in (F.regexp_extract(v, r"(?i)^doi:\s*(\S+)$", 1), F.regexp_extract(v, r"(?i)^https?://(?:dx\.)?doi\.org/(\S+)$", 1), F.regexp_extract(v, r"(10\.[0-9]{4,9}/\S+)", 1))))
    return F.concat(F.lit("https://doi.org/"), core)


def identifier_doi_url(x: Column) -> Column:
    """The URL of an identifier literal ``DOI: 10...``, else null."""
    core = F.regexp_replace(F.regexp_extract(F.trim(x), r"(?i)^doi:\s*(10\.\S+)$", 1), r"[)\].,;]+$", "")
    return F.when(core != "", F.concat(F.lit("https://doi.org/"), core))


def link_key(x: Column) -> Column:
    """Objects that link: lower case, http as https. A DOI literal and a DOI IRI stay different."""
    return F.when(x.startswith('"'), F.concat(F.substring(x, 1, 5), F.lower(F.substring(x, 6, 1 << 30)))).otherwise(F.regexp_replace(F.lower(x), "^<http://", "<https://"))


def orcid(x: Column) -> Column:
    """The first ORCID in a text, spaces left out; its check character is a digit or a capital X."""
    out = F.regexp_extract(F.regexp_replace(x, r"(?U)\s", ""), r"([0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{3}[0-9X])", 1)
    return F.when(out != "", out)


def github_repository(x: Column) -> Column:
    """https://github.com/owner/repository of a URL below it, null for others; case is kept."""
    m = r"^https?://(?:www\.)?github\.com/+([^/?#]+)/+([^/?#]+)"
    name = F.regexp_replace(F.regexp_extract(x, "(?i)" + m, 2), r"\.git$", "")
    owner = F.regexp_extract(x, "(?i)" + m, 1)
    return F.when((owner != "") & (name != ""), F.concat(F.lit("https://github.com/"), owner, F.lit("/"), name))


def openalex_institution(x: Column) -> Column:
    """I and digits of an institution's identifier or URL, null for others."""
    out = F.upper(F.regexp_extract(F.regexp_replace(F.trim(x), "/+$", ""), "([^/]*)$", 1))
    return F.when(out.rlike("^I[0-9]+$"), out)


def openalex_author_endpoint(x: Column, service: str = "https://api.openalex.org/authors/") -> Column:
    """The service address of an author's identifier or URL, null for nothing."""
    tail = F.regexp_extract(F.regexp_replace(F.trim(x), "^/+|/+$", ""), "([^/]*)$", 1)
    return F.when(x != "", F.concat(F.lit(service), tail))


def dblp_pid(x: Column) -> Column:
    out = F.regexp_extract(x, "/pid/(.+?)(?:\\.html)?$", 1)
    return F.when(out != "", out)


def first_of(meta: Column, *keys: str) -> Column:
    """The first value of a map's keys that is there and not empty."""
    values = [F.try_element_at(meta, F.lit(k)) for k in keys]
    return F.coalesce(*(F.when(v != "", v) for v in values))


def person_iri(base: str, name: Column, meta: Column) -> Column:
    """By ORCID, else university number (unless NA), else the hash of the name and the sorted remarks."""
    oid, uni = orcid(first_of(meta, "orcid", "ORCID")), first_of(meta, "UNI-ID", "uni-id", "uniId")
    pairs = F.array_join(F.transform(F.array_sort(F.map_entries(meta)), lambda e: F.concat(e["key"], F.lit("="), e["value"])), "|")
    by_number = F.when(F.upper(uni) != "NA", joined(base, F.concat(F.lit("id/person/uni/"), uni)))
    return F.coalesce(F.concat(F.lit("https://orcid.org/"), oid), by_number, joined(base, F.concat(F.lit("id/person/hash/"), hash12(F.concat(name, F.lit("|"), pairs)))))


def affiliation_iri(base: str, ror: Column, ident: Column, name: Column, country: Column) -> Column:
    """By ROR, else identifier, else the hash of name and country code."""
    some = lambda c: F.when(F.trim(c) != "", F.trim(c))
    text = lambda c: F.lower(F.coalesce(F.trim(c), F.lit("")))
    return F.coalesce(some(ror), some(ident), joined(base, F.concat(F.lit("id/org/"), F.sha1(F.concat(F.lit("org::"), text(name), F.lit("|"), text(country)).cast("binary")))))


def search_text(x: Column, longest: int = 300) -> Column:
    """A title as a search takes it: letters, digits and underscores, all else as single spaces, cut to longest."""
    return F.substring(strip(F.regexp_replace(x, r"(?U)[^\p{L}\p{N}_]+", " ")), 1, longest)


def work_keys(doi: Column, extended: bool = True) -> Column:
    """The cache keys under which the work of a DOI in any form may be, in order of preference; none without a DOI."""
    url = doi_url(doi)
    forms = F.array(url, F.concat(F.lit("http://"), F.substring(url, 9, 1 << 30)))
    return F.when(url.isNotNull(), F.transform(forms, lambda u: F.concat(F.lit("work::"), u, F.lit(f"::xpac={extended}")))).otherwise(F.array().cast("array<string>"))


def search_keys(title: Column, extended: bool = True, sizes: tuple[int, ...] = (5, 10, 3)) -> Column:
    """The cache keys of searches for a title, by page size; none for titles of fewer than five characters."""
    text = search_text(title)
    keys = F.array(*(F.concat(F.lit(f"search::{n}::xpac={extended}::"), text) for n in sizes))
    return F.when(F.length(text) >= 5, keys).otherwise(F.array().cast("array<string>"))
