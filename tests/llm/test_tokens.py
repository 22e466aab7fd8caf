import hashlib
import random
import re
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loomgraph.llm.bpe_codec import WordBpe, digests, round_trip, unassigned
from loomgraph.llm.token_records import Encoder, frame, read_records, read_shuffled, unframe, write_records
from loomgraph.llm.wordpiece_counts import Automaton, piece_sets, token_counts

BYTE, WORD, PIECE = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
ODD = [
    None, "", " ", "\n\n\t ", "a", "The  the THE x", "don't we'll I'M", "x<|endoftext|>y <|startoftext|>", "ΑΣ Σ ΟΔΟΣ", "İstanbul ǅ ﬁ",
    "é Å", "日本語 テスト 한국어", "🙂👩‍👩 1234567 ½", "\x1c\x1d\x85​﻿", "a" * 3000, "ab " * 2000, "<|endoftext|", "\x00\x01", "'s's''s", "  lead  trail  ",
]


def texts(spark, small):
    return [r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect()] + ODD


def test_word_bpe_equals_the_library(spark, small):
    lib, own = Tokenizer.from_file(WORD), WordBpe(WORD)
    for t in texts(spark, small):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        got = own.encode(t or "")
        assert np.frombuffer(got, "<u4").tolist() == ids, t
        assert own.decode(got).decode() == lib.decode(ids, skip_special_tokens=False)


def test_word_bpe_on_every_character_of_the_first_planes():
    lib, own = Tokenizer.from_file(WORD), WordBpe(WORD)
    odd = []
    assert re.findall(unassigned(), "".join(map(chr, range(0x110000)))) == [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn"]
    for lo in [*range(0, 0x3000), *range(0xA000, 0xD800, 7), *range(0xE000, 0x20000, 5), *range(0x20000, 0x110000, 997)]:
        t = f"a{chr(lo)}b {chr(lo)}1{chr(lo)}{chr(lo)}"
        if np.frombuffer(own.encode(t), "<u4").tolist() != lib.encode(t, add_special_tokens=False).ids:
            odd.append(hex(lo))
    assert not odd


def test_queue_merges_equal_the_library_on_random_words():
    lib, own, rng = Tokenizer.from_file(WORD), WordBpe(WORD), random.Random(3)
    for _ in range(3000):
        w = "".join(rng.choice("aeinorstthe") for _ in range(rng.randint(1, 30)))
        assert np.frombuffer(own.word(w), "<u4").tolist() == lib.encode(w, add_special_tokens=False).ids


def test_byte_encoder_equals_the_library(spark, small):
    lib, own = Tokenizer.from_file(BYTE), Encoder(BYTE)
    some = [t or "" for t in texts(spark, small)] + [f"a{chr(c)}b {chr(c)}1{chr(c)}{chr(c)} {chr(c)}" for c in range(0x400)]
    for t in some:
        assert np.frombuffer(own(t), own.dtype).tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)


def test_frames():
    data = frame(b"one") + frame(b"")
    one, at = unframe(data, 0)
    assert (one, unframe(data, at)) == (b"one", (b"", len(data)))
    for k in (0, 9, 13, len(frame(b"one")) - 1):
        with pytest.raises(ValueError):
            unframe(data[:k] + bytes([data[k] ^ 1]) + data[k + 1 :], 0)


def odd_table(spark):
    rows = [(i if i % 7 else None, t, "x", 1) for i, t in enumerate(ODD)] + [(5, "again", "x", 1)] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, start string, n_tokens int").repartition(3)


def test_records_round_trip(spark):
    docs, lib = odd_table(spark), Tokenizer.from_file(BYTE)
    got = read_records(write_records(docs, BYTE, 2)).collect()
    assert len(got) == docs.count()
    by_start = sorted(got, key=lambda r: r.start)
    at = 0
    for r in by_start:
        assert (r.start, len(r.ids)) == (at, 4 * r.n_tokens)
        at += r.n_tokens
    ids = [r.doc_id for r in by_start]
    assert ids == sorted(ids, key=lambda x: (x is not None, x or 0))
    want = sorted((r.doc_id or -1, zlib.crc32(np.array(lib.encode(r.text or "", add_special_tokens=False).ids + [2], "<u4").tobytes())) for r in docs.collect())
    assert want == sorted((r.doc_id or -1, zlib.crc32(r.ids)) for r in got)


def test_empty_tables(spark):
    docs = odd_table(spark).where("false")
    assert read_records(write_records(docs, BYTE, 2)).count() == 0
    assert round_trip(docs, WORD).count() == 0
    assert token_counts(docs, PIECE).count() == 0


def test_round_trip_digests(spark):
    lib = Tokenizer.from_file(WORD)
    want = []
    for r in odd_table(spark).collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id or -1, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    got = [(r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in digests(round_trip(odd_table(spark), WORD)).collect()]
    assert sorted(got) == sorted(want)


def greedy(word, first, more):
    at, n = 0, 0
    while at < len(word):
        end = next((e for e in range(len(word), at, -1) if word[at:e] in (more if at else first)), None)
        if end is None:
            return 0
        at, n = end, n + 1
    return n


def test_automaton_equals_greedy(spark, small):
    rng = random.Random(5)
    for _ in range(300):
        alphabet = "abc"[: rng.randint(1, 3)]
        word = lambda m: "".join(rng.choice(alphabet) for _ in range(rng.randint(1, m)))  # noqa: E731, B023
        first, more = {word(4) for _ in range(rng.randint(1, 8))}, {word(4) for _ in range(rng.randint(0, 8))}
        a = Automaton(first, more)
        for _ in range(50):
            w = word(12)
            assert a.count(w) == greedy(w, first, more), (w, first, more)
    first, more = piece_sets(PIECE)
    a = Automaton(first, more)
    for w in {w for t in texts(spark, small)[:60] for w in (t or "").encode().split()}:
        assert a.count(w.decode()) == greedy(w.decode(), first, more)


def test_counts_of_odd_texts(spark):
    got = {r.doc_id: r for r in token_counts(odd_table(spark), PIECE).collect() if r.doc_id}
    assert (got[1].n_words, got[1].n_tokens) == (0, 0)
    assert got[5].n_words >= 1


def test_shuffled_reads(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(None, None)], "doc_id long, text string"))
    files = write_records(docs, BYTE, 2)
    order = [(r.doc_id, r.n_tokens, r.ids) for r in read_records(files).collect()]
    one, again, other = ([(r.doc_id, r.n_tokens, r.ids) for r in read_shuffled(files, seed).collect()] for seed in (1, 1, 2))
    assert one == again and one != other and one != order and sorted(map(str, one)) == sorted(map(str, order))
    ranks = [r.rank for r in read_shuffled(files, 1).collect()]
    assert ranks == sorted(ranks)
    empty = write_records(docs.where("false"), BYTE, 2)
    assert read_shuffled(empty, 1).count() == 0


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        Encoder(WORD)
