"""Similarities of short texts, as Arrow functions: no built-in has these definitions."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from difflib import SequenceMatcher
from functools import lru_cache

import pandas as pd
from pyspark.sql.functions import pandas_udf


def folded(t: str) -> str:
    return " ".join(t.lower().split())


def block_ratio(a: str, b: str) -> float:
    """Twice the matching blocks over both lengths, of lower-case texts with single spaces; not symmetric."""
    return SequenceMatcher(None, folded(a), folded(b)).ratio()


def common_length(a: str, b: str) -> int:
    """The length of the longest common subsequence, bit-parallel."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for c in b:
        u = v & where.get(c, 0)
        v = (v + u | v - u) & full
    return len(a) - v.bit_count()


def indel_ratio(a: str, b: str) -> float:
    """100 * 2 * common subsequence / both lengths; two empty texts are equal."""
    return 100.0 if not a and not b else 200.0 * common_length(a, b) / (len(a) + len(b))


def tokens_sorted(t: str) -> str:
    return " ".join(sorted(t.split()))


def token_sort_ratio(a: str, b: str) -> float:
    return indel_ratio(tokens_sorted(a), tokens_sorted(b))


def name_parts(name: str) -> tuple[str, tuple[str, ...]]:
    """Folded surname and given names."""
    clean = lambda t: "".join(c for c in unicodedata.normalize("NFKD", t.casefold()) if c.isalpha())
    surname, comma, given = name.partition(",")
    if not comma:
        *rest, surname = name.split() or [""]
        given = " ".join(rest)
    return clean(surname), tuple(filter(None, map(clean, given.split())))


def names_match(a: str, b: str) -> bool:
    """Equal surnames and as many given names, each equal or the initial of the other."""
    (s, g), (t, h) = name_parts(a), name_parts(b)
    return bool(s and s == t and g and len(g) == len(h) and all(x == y or (1 in (len(x), len(y)) and x[0] == y[0]) for x, y in zip(g, h)))


@lru_cache(maxsize=None)
def _arrow(f: Callable, kind: str):
    """One Arrow function for each plain function of one or two texts; null for null."""
    if kind == "string":

        @pandas_udf(kind)
        def one(a: pd.Series) -> pd.Series:
            return pd.Series([None if x is None else f(x) for x in a], dtype=object)

        return one

    @pandas_udf(kind)
    def two(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([None if x is None or y is None else f(x, y) for x, y in zip(a, b)], dtype=object)

    return two


folded_of = lambda a: _arrow(folded, "string")(a)
tokens_sorted_of = lambda a: _arrow(tokens_sorted, "string")(a)
block_ratio_of = lambda a, b: _arrow(block_ratio, "double")(a, b)
indel_ratio_of = lambda a, b: _arrow(indel_ratio, "double")(a, b)
token_sort_ratio_of = lambda a, b: _arrow(token_sort_ratio, "double")(a, b)
names_match_of = lambda a, b: _arrow(names_match, "boolean")(a, b)


def mentions(text: str, window: int = 30, limit: int = 50) -> list[dict]:
    """GitHub links with the text around them: url and context, each pair once, up to limit."""
    out, seen = [], set()
    for m in re.finditer(r"(?:https?://)?(?:www\.)?github\.com/[^\s<>\"'{}|\\^`]+", text, re.I):
        url = m[0].rstrip(".,;:)]}")
        url = url if url.lower().startswith("http") else f"https://{url}"
        context = " ".join(text[max(0, m.start() - window) : m.end() + window].split())
        if (url, context) not in seen and len(out) < limit:
            seen.add((url, context))
            out.append({"url": url, "context": context})
    return out


def surname(name: str) -> str:
    """The folded surname, by which names that match are equal."""
    return name_parts(name)[0]
