"""Benchmark decontamination by winnowing.

Every text becomes the hashes of its k-grams of words; of each window of w consecutive k-grams the minimum is kept (the
rightmost of equal ones). Two texts that share a span of ``w + k - 1`` words keep the same k-gram of it, so joining the
kept fingerprints of documents and items finds every shared span of that length. Each hit is extended to both sides
while the words agree; spans of ``span`` words or more count. With k = 5 and w = 4 that is the guarantee for 8 words.
Items of fewer than 8 words are a span of their own length; for them all k-grams of that length are kept.

Items are the stated query set. They are broadcast in blocks of bounded size, and documents pass all blocks in one
scan, without a shuffle: nothing grows with the documents but the scan.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.batches import Memo, held, small_batches
from loomgraph.plans.scratch import stored

#: Lower-cases A-Z and turns every byte that is no word byte (words: digits, letters, all bytes from \x80 on) into a space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


@dataclass(frozen=True)
class Winnow:
    span: int = 8
    k: int = 5
    block_bytes: int = 32 << 20
    """Bytes of item text in one broadcast block, about."""

    @property
    def window(self) -> int:
        return self.span - self.k + 1


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TABLE).split()


@held
def _memo() -> Memo:
    return Memo(xxhash.xxh3_64_intdigest)


def hashed(words: list[bytes]) -> np.ndarray:
    """64-bit word hashes."""
    return np.fromiter(map(_memo().__getitem__, words), np.uint64, len(words))


def grams(ids: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k-grams of word hashes."""
    out = np.full(max(0, len(ids) - k + 1), k, np.uint64)
    for i in range(k if len(out) else 0):
        out = out * np.uint64(0x9E3779B97F4A7C15) + ids[i : len(ids) - k + 1 + i]
        out = (out ^ (out >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return out


def kept(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions of the minimum of each window, the rightmost of equal ones, each once."""
    n = len(hashes) - window + 1
    if n <= 0:
        return np.empty(0, np.int64)
    least, at = hashes[window - 1 :], np.arange(window - 1, len(hashes))
    for i in range(window - 2, -1, -1):
        lower = hashes[i : i + n] < least
        least, at = np.where(lower, hashes[i : i + n], least), np.where(lower, np.arange(i, i + n), at)
    return np.unique(at)


class Block:
    """The fingerprints of some items: by k-gram length, sorted hashes and the places (item, position) of each."""

    def __init__(self, items: list[tuple], p: Winnow):
        self.p, found = p, defaultdict(list)
        self.names, self.words = [i for i, _ in items], [words_of(t) for _, t in items]
        for n, words in enumerate(self.words):
            if words:
                ids, k = hashed(words), p.k if len(words) >= p.span else len(words)
                g = grams(ids, k)
                at = kept(g, p.window) if len(words) >= p.span else np.arange(len(g))
                # lengths of items below the span have a table of their own, as their k-grams are not winnowed
                found[k if len(words) < p.span else 0] += [(int(g[i]), n, int(i)) for i in at]
        self.tables = {}
        for k, rows in found.items():
            places = defaultdict(list)
            for h, n, i in rows:
                places[h].append((n, i))
            self.tables[k] = np.array(sorted(places), np.uint64), dict(places)

    def hits(self, words: list[bytes], ids: np.ndarray) -> tuple[list[tuple[int, int]], set[int]]:
        """Spans [from, to) of the words that occur in items, and the numbers of those items."""
        p, spans, items = self.p, set(), set()
        for k, (known, places) in self.tables.items():
            g = grams(ids, k or p.k)
            at = np.arange(len(g)) if k else kept(g, p.window)
            if not len(at) or not len(known):
                continue
            near = np.minimum(np.searchsorted(known, g[at]), len(known) - 1)
            least, reached = k or p.span, {}
            for i in at[known[near] == g[at]].tolist():
                for n, j in places[int(g[i])]:
                    if reached.get((n, i - j), -1) > i:
                        continue  # inside a span already extended along this diagonal
                    a, b = self._extended(words, self.words[n], i, j, k or p.k)
                    reached[n, i - j] = b
                    if b - a >= least:
                        spans.add((a, b))
                        items.add(n)
        return sorted(spans), items

    @staticmethod
    def _extended(x: list[bytes], y: list[bytes], i: int, j: int, k: int) -> tuple[int, int]:
        if x[i : i + k] != y[j : j + k]:
            return i, i  # another k-gram of the same hash
        a, b = i, i + k
        while a > 0 and j - (i - a) > 0 and x[a - 1] == y[j - (i - a) - 1]:
            a -= 1
        while b < len(x) and j + (b - i) < len(y) and x[b] == y[j + (b - i)]:
            b += 1
        return a, b


def blocks(items: DataFrame, p: Winnow) -> tuple[int, Iterator[list[tuple]]]:
    """How many blocks of about p.block_bytes the items (item_id, text) make, and the blocks, each collected when asked for."""
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("binary").alias("text")).where("text is not null and item_id is not null")
    size = rows.agg(F.sum(F.octet_length("text")).alias("b")).first().b or 0
    n = 1 + size // p.block_bytes
    return n, ([(r.item_id, bytes(r.text)) for r in rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).collect()] for i in range(n))


def contamination(docs: DataFrame, items: DataFrame, params: Winnow = Winnow(), keep_rows: bool = False) -> DataFrame:
    """doc_id, n_words, ends (from, to word positions of merged spans), items (ids as sorted strings) for each row of
    docs; with keep_rows also row, all columns of docs.

    A null text has no words. Null item texts or ids and items without words match nothing; an item_id that comes more
    than once counts once. Items beyond one block are matched block by block, each pass written down before the next block
    is fetched and the last one freed, so that driver and executors hold one block. Repeated documents are handled alone; extra columns are not read; with an empty table of
    items no document has hits.
    """
    spark = docs.sparkSession
    small_batches(spark)
    state = "array<int>"
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"), F.lit(0).cast("long").alias("n_words"), F.array().cast(state).alias("ends"), F.array().cast("array<string>").alias("items"), *[F.struct("*").alias("row")] * keep_rows)
    schema, (n, parts) = out.schema, blocks(items, params)
    for rows in parts:
        shared = spark.sparkContext.broadcast(rows)

        def run(batches, shared=shared):
            block = Block(shared.value, params)
            for b in batches:
                n_words, ends, names = [], [], []
                for text, was, had in zip(*(b.column(i).to_pylist() for i in (1, 3, 4))):
                    words = words_of(text)
                    spans, found = block.hits(words, hashed(words)) if words else ([], set())
                    n_words.append(len(words))
                    ends.append(merged([*zip(was[::2], was[1::2]), *spans]) if spans else was)
                    names.append(sorted({*had, *(block.names[n] for n in found)}) if found else had)
                arrays = [b.column(0), b.column(1), pa.array(n_words, pa.int64()), pa.array(ends, pa.list_(pa.int32())), pa.array(names, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays([*arrays, *b.columns[5:]], names=["doc_id", "text", "n_words", "ends", "items", *b.schema.names[5:]])

        out = out.mapInArrow(run, schema)
        if n > 1:
            out = stored(out, "contamination")
            shared.destroy()
    return out.drop("text")


def merged(spans: list[tuple[int, int]]) -> list[int]:
    """Overlapping spans joined, as a flat list from, to, from, to."""
    out: list[int] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]:
            out[-1] = max(out[-1], b)
        else:
            out += [a, b]
    return out


def verdicts(hits: DataFrame, least_items: int = 2) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of :func:`contamination` rows."""
    at = lambda odd: F.aggregate(F.filter("ends", lambda x, i: i % 2 == odd), F.lit(0).cast("long"), lambda s, x: s + x)
    return hits.select(
        "doc_id",
        "n_words",
        (at(1) - at(0)).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("items") >= least_items).alias("contaminated"),
    )
