"""Token counts by a linear longest-match automaton.

A trie of the word-piece vocabulary (one root for pieces that begin a word, one for continuations) gets failure links:
where the trie has no way on, the link leads to the node of the rest of the text once the longest-match pieces are
popped, and carries how many pieces those are. One pass over a word then gives the number of greedy longest-match
pieces in linear time, without building a piece.
"""

from __future__ import annotations

from collections import deque

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm.batches import Memo, held, small_batches


class Automaton:
    def __init__(self, first: set[str], more: set[str]):
        """first: pieces that begin a word; more: pieces that continue one."""
        self.next: list[dict[str, int]] = [{}, {}]  # 0 the root, 1 the root of continuations
        ends = [False, False]
        for root, pieces in ((0, first), (1, more)):
            for piece in sorted(pieces):
                node = root
                for c in piece:
                    if c not in self.next[node]:
                        self.next[node][c] = len(self.next)
                        self.next.append({})
                        ends.append(False)
                    node = self.next[node][c]
                ends[node] |= bool(piece)
        self.link, self.pops = [-1] * len(self.next), [0] * len(self.next)
        queue = deque((r, c, v) for r in (0, 1) for c, v in self.next[r].items())
        while queue:
            u, c, v = queue.popleft()
            if ends[v]:
                self.link[v], self.pops[v] = 1, 1
            else:
                z, n = self.link[u], self.pops[u]
                while z >= 0 and c not in self.next[z]:
                    n, z = n + self.pops[z], self.link[z]
                if z >= 0:
                    self.link[v], self.pops[v] = self.next[z][c], n
            queue.extend((v, d, w) for d, w in self.next[v].items())

    def count(self, word: str) -> int:
        """The number of pieces of the word; 0 if it cannot be cut into pieces."""
        follow, link, pops, v, n = self.next, self.link, self.pops, 0, 0
        for c in word:
            while c not in follow[v]:
                n, v = n + pops[v], link[v]
                if v < 0:
                    return 0
            v = follow[v][c]
        while v != 1:
            n, v = n + pops[v], link[v]
            if v < 0:
                return 0
        return n


def piece_sets(model_file: str) -> tuple[set[str], set[str]]:
    """The pieces of a sentencepiece file as a word-piece vocabulary: those with the word mark begin a word."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=model_file)
    own = [sp.id_to_piece(i) for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    return {p[1:] for p in own if p[0] == "▁" and len(p) > 1}, {p for p in own if p[0] != "▁"}


@held
def memo_of(model_file: str) -> Memo:
    """Piece counts by word in UTF-8."""
    automaton = Automaton(*piece_sets(model_file))
    return Memo(lambda word: automaton.count(word.decode()))


def token_counts(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_words, n_tokens, n_unknown for each row of docs (doc_id, text).

    Words are maximal runs of bytes other than space and \\x09-\\x0D. A word that the vocabulary cannot cut counts as one
    token and as unknown. A null or empty text has zeros; rows are handled alone, so ties, repeated rows, extra columns
    and empty tables need no rule.
    """

    def run(batches):
        memo = memo_of(model_file)
        for b in batches:
            rows = []
            for text in b.column(1).to_pylist():
                words = (text or b"").split()
                counts = list(map(memo.__getitem__, words))
                unknown = counts.count(0)
                rows.append((len(words), sum(counts) + unknown, unknown))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([r[i] for r in rows], pa.int64()) for i in range(3))], names=["doc_id", "n_words", "n_tokens", "n_unknown"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, n_words long, n_tokens long, n_unknown long")
