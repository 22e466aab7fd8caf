"""BPE encoding and decoding of whole texts from a public tokenizer file.

Encoding: added tokens are cut out of the raw text, the rest is normalised (NFC, lower case character by character) and
cut into words; a word becomes a doubly linked list of symbols, and a priority queue of (merge rank, position) joins
neighbours, lowest rank and leftmost first. Queue entries whose pair has changed meanwhile are stale and skipped.
Decoding: the vocabulary strings of the ids, concatenated with the decoder's separator (a space where the file names no
decoder). Word results are memoised up to a bounded number of words. Texts with characters that Python's Unicode tables do
not know are normalised and cut into words by the library, whose tables are of another age; their symbols are joined here.
"""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.batches import Memo, held, small_batches


def byte_letters() -> list[str]:
    """The printable letter of each byte: printable Latin-1 bytes are their own, the rest follow from U+0100 on."""
    own = {b for lo, hi in ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF)) for b in range(lo, hi + 1)}
    rest = iter(range(256, 512))
    return [chr(b if b in own else next(rest)) for b in range(256)]


@lru_cache(maxsize=1)
def unassigned() -> str:
    """A character class of all code points that have no character in Python's tables."""
    ends = [0x80]
    for c in range(0x80, 0x110000):
        if (unicodedata.category(chr(c)) == "Cn") != (len(ends) % 2 == 0):
            ends.append(c)
    ends += [0x110000] * (len(ends) % 2 == 0)
    return "[" + "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(ends[1::2], ends[2::2])) + "]"


class WordBpe:
    """A codec for files with a Split pattern, byte letters and an end-of-word suffix."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kinds = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or spec.get("decoder"):
            raise ValueError(f"{path}: not a tokenizer file of the supported kind")
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.merges = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges[self.vocab[a], self.vocab[b]] = rank, self.vocab[a + b]
        self.letters = byte_letters()
        self.strings = [b""] * (max([*self.vocab.values(), *self.added.values()]) + 1)
        for s, i in [*self.vocab.items(), *self.added.items()]:
            self.strings[i] = s.encode()
        self.memo, self.path, self.library = Memo(self.word), path, None
        # below U+0378 every code point is assigned: most texts need only the first, quick look
        self.beyond, self.unknown = re.compile("[^\x00-\u0377]"), re.compile(unassigned())

    def _cut_by_library(self, text: str) -> bytes:
        """The ids of a text whose words the library finds."""
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        words = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
        return b"".join(self.joined(list(w)) for w, _ in words)

    def word(self, word: str) -> bytes:
        """The ids of one word, as little-endian unsigned 32-bit integers."""
        return self.joined([self.letters[b] for b in word.encode()])

    def joined(self, units: list[str]) -> bytes:
        units[-1] += self.suffix
        return np.array(self.merge([self.vocab[u] for u in units]), "<u4").tobytes()

    def merge(self, ids: list[int]) -> list[int]:
        merges, end = self.merges, len(ids)
        after, before = [*range(1, end + 1)], [*range(-1, end - 1)]
        queue = [(m[0], i, m[1]) for i in range(end - 1) if (m := merges.get((ids[i], ids[i + 1])))]
        heapify(queue)
        while queue:
            rank, i, made = heappop(queue)
            j = after[i]
            if ids[i] < 0 or j >= end or merges.get((ids[i], ids[j]), (-1,))[0] != rank:
                continue  # stale: the symbol is gone or has another neighbour by now
            ids[i], ids[j], after[i] = made, -1, after[j]
            if after[i] < end:
                before[after[i]] = i
                if m := merges.get((made, ids[after[i]])):
                    heappush(queue, (m[0], i, m[1]))
            if (h := before[i]) >= 0 and (m := merges.get((ids[h], made))):
                heappush(queue, (m[0], h, m[1]))
        return [x for x in ids if x >= 0]

    def encode(self, text: str) -> bytes:
        parts = self.cut.split(text) if self.cut and "<" in text else [text]
        out = []
        for k, part in enumerate(parts):
            if k % 2:
                out.append(np.array([self.added[part]], "<u4").tobytes())
            elif part and (m := self.beyond.search(part)) and self.unknown.search(part, m.start()):
                out.append(self._cut_by_library(part))
            elif part:
                part = unicodedata.normalize("NFC", part)
                # str.lower() turns a final capital sigma by its neighbours; character by character it does not
                part = part.lower() if "Σ" not in part else "".join(map(str.lower, part))
                out.append(b"".join(map(self.memo.__getitem__, self.pattern.findall(part))))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        return b" ".join(map(self.strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@held
def codec_of(path: str) -> WordBpe:
    return WordBpe(path)


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers), decoded text; one row per row of docs (doc_id, text).

    A null text counts as empty: no ids, an empty text. Rows are handled alone, so ties, repeated rows, extra columns
    and empty tables need no rule.
    """

    def run(batches):
        codec = codec_of(path)
        for b in batches:
            ids = [codec.encode(t or "") for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.binary()), pa.array([codec.decode(x).decode() for x in ids], pa.string())], names=["doc_id", "ids", "decoded"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, ids binary, decoded string")


def digests(coded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of :func:`round_trip` rows."""
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
