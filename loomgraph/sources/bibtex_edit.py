"""BibTeX edited where it stands: values, keys, database ids; a light scan; addresses of entries.

A file that is edited keeps every character outside the values and keys that change, so what the strict scanner would
normalise (spacing, order, comments) survives.
"""

from __future__ import annotations

import html
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from loomgraph.functions.identifiers import part, percent
from loomgraph.functions.text import arrow, space_normal
from loomgraph.sources.bibtex import decoded, repaired_key

_ASSIGNED = re.compile(r"([\w-]*)\s*=\s*")
_FIELD_NEXT = re.compile(r"\s*(?:$|[,}]|[A-Za-z][\w-]*\s*=)")
_KNOWN_NEXT = re.compile(r",\s*(?:title|author|editor|year|date|journal|booktitle|publisher|pages|volume|number|doi|url|abstract|keywords|series|address|isbn|issn|month|note)\s*=", re.I)
_STEP = re.compile(r"\\.|[{}\",]", re.S)
_FRAGMENT = re.compile(r"\s*,\s*([^}\n\r=]*[^}\n\r=\s])\s*\}(?=\s*(?:$|[,}]|[\r\n]))")


def _wrapped(text: str, at: int, field: str) -> tuple[str, int, bool]:
    """The inside of a braced or quoted value, the place after it, and whether its end was put right. Escaped characters
    are skipped. A comma before a known field ends a value whose brace was never closed; a brace within a list of names
    that no field end follows belongs to a name."""
    quoted, depth = text[at] == '"', 1
    for m in _STEP.finditer(text, at + 1):
        c = m[0]
        if quoted:
            if c == '"':
                return text[at + 1 : m.start()], m.end(), False
        elif c == "{":
            depth += 1
        elif c == "," and _KNOWN_NEXT.match(text, m.start()):
            return text[at + 1 : m.start()] + "}" * (depth - 1), m.start(), True
        elif c == "}" and not (depth == 1 and field in ("author", "editor") and not _FIELD_NEXT.match(text, m.end())):
            depth -= 1
            if depth == 0:
                return text[at + 1 : m.start()], m.end(), False
    return text[at + 1 :], len(text), not quoted


def clean_value(field: str, value: str) -> str:
    """A decoded value; authors without brackets around names or spaces before punctuation, a DOI without its address."""
    t = decoded(value)
    if field == "author":
        for _ in range(4):
            t = re.sub(r"\(([^()]*)\)", r"\1", t)
        return " ".join(re.sub(r"\s+([,;.])", r"\1", t).split())
    if field == "doi":
        t = re.sub(r"(?i)^doi:\s*", "", html.unescape(html.unescape(t)).strip())
        m = re.search(r"(?i)https?://(?:dx\.)?doi\.org/(\S+)", t)
        return (m[1] if m else t).strip().rstrip(".,;")
    return t


def values_rewritten(text: str) -> dict:
    """text and changed: a file with each value after ``=`` cleaned within its own wrapper, and how many values changed."""
    out, at, changed = [], 0, 0
    while m := _ASSIGNED.search(text, at):
        field, start = m[1].lower(), m.end()
        out.append(text[at:start])
        if start < len(text) and text[start] in '{"':
            value, at, mended = _wrapped(text, start, field)
            if text[start] == "{" and (tail := _FRAGMENT.match(text, at)):
                value, at, mended = f"{value}, {tail[1].strip()}", tail.end(), True
            new = clean_value(field, value)
            out.append(f"{{{new}}}" if text[start] == "{" else f'"{new}"')
            changed += mended or new != value
        else:
            value = re.compile(r"[^,\n\r}]*").match(text, start)[0]
            new, at = clean_value(field, value), start + len(value)
            out.append(new)
            changed += new != value
    return {"text": "".join(out) + text[at:], "changed": changed}


def rewritten_files(files: DataFrame) -> DataFrame:
    """file, value, changed of files (file, value): every value cleaned in place."""
    @pandas_udf("struct<text:string,changed:int>")
    def edit(x: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([values_rewritten(t or "") for t in x], columns=["text", "changed"])

    return files.withColumn("_e", edit(F.col("value"))).select("file", F.col("_e.text").alias("value"), F.col("_e.changed").alias("changed"))


#: A line that begins an entry: its head, the key, and the comma that the end of the line or a field follows.
HEAD = r"^(\s*@\w+\s*[{(]\s*)(.*?)(,\s*(?:$|[A-Za-z][A-Za-z0-9_-]*\s*=).*)$"


def keys_rewritten(lines: DataFrame) -> DataFrame:
    """lines (value and any columns) with value, old_key and new_key: entry keys in safe characters; both keys are null
    where no entry begins. Works on streams too."""
    x = F.col("value")
    old = F.when(x.rlike(HEAD), F.regexp_extract(x, HEAD, 2))
    done = lines.withColumn("old_key", old).withColumn("new_key", F.when(F.col("old_key").rlike("^[A-Za-z0-9:.+/-]*$"), F.col("old_key")).otherwise(arrow(repaired_key)(F.col("old_key"))))
    value = F.when(F.col("old_key").isNull() | (F.col("old_key") == F.col("new_key")), x).otherwise(F.concat(F.regexp_extract(x, HEAD, 1), "new_key", F.regexp_extract(x, HEAD, 3)))
    return done.withColumn("value", value)


def with_database_ids(rows: DataFrame) -> DataFrame:
    """Entries (see sources.bibtex: file, ordinal, entry_type, raw) with dbid: the last ``% dbid: number`` line since the
    entry before began. It counts for one entry only."""
    line = r"(?im)^[ \t]*%[ \t]*dbid[ \t]*:[ \t]*([0-9]+)[ \t]*$"
    found = rows.select("file", "ordinal", F.col("entry_type").isNotNull().alias("typed"), F.try_element_at(F.regexp_extract_all("raw", F.lit(line), F.lit(1)), F.lit(-1)).alias("id"))
    # text stands between entries, so what counts is the text right before, else the entry before that text
    before = lambda k, c: found.select("file", (F.col("ordinal") + k).alias("ordinal"), F.col("typed").alias(f"t{c}"), F.col("id").alias(f"i{c}"))
    met = rows.join(before(1, "1"), ["file", "ordinal"], "left").join(before(2, "2"), ["file", "ordinal"], "left")
    dbid = F.coalesce("i1", F.when(~F.col("t1"), F.col("i2")))
    return met.withColumn("dbid", F.when(F.col("entry_type").isNotNull(), dbid)).select(*rows.columns, "dbid")


def light_entries(files: DataFrame) -> DataFrame:
    """file, ordinal, key, fields (array of name, value) of files (file, value) without a parser: a file is cut where
    entries begin, and fields are found by their form. Nested braces and values with commas need the scanner instead."""
    cut = F.split("value", r"(?m)(?=^[ \t]*@\w+\s*[{(])")
    rows = files.select("file", F.posexplode(cut).alias("ordinal", "raw")).where(F.col("raw").rlike(r"^\s*@\w+\s*[{(]"))
    form = r"(?is)([A-Za-z][\w:-]*)\s*=\s*(\{.*?\}|\"[^\"]*\"|<.*?>|[^,}]+)\s*(?:,|\}\s*$)"
    body = F.regexp_replace("raw", r"^\s*@\w+\s*[{(]\s*[^,]+,\s*", "")
    plain = lambda v: F.trim(F.regexp_replace(F.trim(v), r"(?s)^\{(.*)\}$|^\"(.*)\"$", "$1$2"))
    found = F.arrays_zip(F.regexp_extract_all(body, F.lit(form), F.lit(1)).alias("name"), F.regexp_extract_all(body, F.lit(form), F.lit(2)).alias("value"))
    fields = F.transform(found, lambda f: F.struct(f["name"].alias("name"), plain(f["value"]).alias("value")))
    return rows.select("file", "ordinal", F.trim(F.regexp_extract("raw", r"^\s*@\w+\s*[{(]\s*([^,]*)", 1)).alias("key"), fields.alias("fields"))


def clean_address(x: Column) -> Column:
    """A value without the braces around it and without escapes, single spaces; null for an empty one."""
    t = F.trim(x)
    for _ in range(8):
        t = F.trim(F.regexp_replace(t, r"(?s)^\{(.*)\}$", "$1"))
    t = space_normal(F.regexp_replace(t, r"\\([_&%#${}])", "$1"))
    return F.when(t != "", t)


#: Characters that stay in a path, and in a query or fragment.
PATH_SAFE, TAIL_SAFE = "/:@-._~!$&'()*+,;=", "/?:@-._~!$&'()*+,;=%"


def normal_url(x: Column) -> Column:
    """An absolute URL with its parts percent-encoded, so that it can be an IRI; null for what has no scheme or host."""
    u = clean_address(x)
    tail = lambda mark, i: F.when(part(u, i) != "", F.concat(F.lit(mark), percent(part(u, i), TAIL_SAFE))).otherwise("")
    whole = F.concat(F.lower(part(u, 2)), F.lit("://"), part(u, 4), percent(part(u, 5), PATH_SAFE), tail("?", 7), tail("#", 9))
    return F.when((part(u, 2) != "") & (part(u, 4) != ""), whole)


def candidate_urls(fields: Column) -> Column:
    """The different addresses of an entry's fields ``url`` and ``bdsk-url-1``, sorted; what is no absolute URL is left out."""
    every = F.transform(F.filter(fields, lambda f: F.lower(f["name"]).isin("url", "bdsk-url-1")), lambda f: normal_url(f["value"]))
    return F.array_sort(F.array_distinct(F.array_compact(every)))
