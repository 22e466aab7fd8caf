import weakref

import public_tokenizers

from loomgraph.llm import batches, bpe_codec, near_dedup, token_records, winnowing
from loomgraph.plans import scratch


def test_a_worker_keeps_one_vocabulary():
    """The memos of the last operator only stay in a Python worker, and as long as that operator is asked for."""
    codec = bpe_codec.codec_of(public_tokenizers.path("word_bpe_49k.json"))
    ids = codec.encode("the same text")
    assert bpe_codec.codec_of(codec.path) is codec
    path, gone = codec.path, weakref.ref(codec)
    del codec
    assert len(near_dedup.shingler(3)(b"a b c d")) == 2
    assert gone() is None
    winnowing.hashed([b"a"])
    token_records.encoder_of(public_tokenizers.path("byte_bpe_50k.json"))
    assert len(batches._now) == 1
    assert bpe_codec.codec_of(path).encode("the same text") == ids


def test_driver_returns_freed_memory(spark, monkeypatch):
    assert "Trim native heap" in scratch.trimmed(spark)
    said, trimmed = [], scratch.trimmed
    monkeypatch.setattr(scratch, "trimmed", lambda s: said.append(trimmed(s)))
    docs = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f g h")], "doc_id long, text string")
    near_dedup.near_duplicates(docs).collect()
    assert said and all(said)
