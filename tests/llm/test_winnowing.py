import hashlib
import random
import re

import pytest

from loomgraph.llm.winnowing import Block, Winnow, contamination, hashed, verdicts, words_of

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_words(text):
    return WORD.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))


def brute(text, items, span=8):
    words, hit, found = plain_words(text), set(), set()
    for name, t in items:
        y = plain_words(t)
        n = min(span, len(y))
        windows = {tuple(y[j : j + n]) for j in range(len(y) - n + 1)} if n and name is not None else set()
        for i in range(len(words) - n + 1 if n else 0):
            if tuple(words[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                found.add(str(name))
    return len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(found) >= 2


def compared(spark, docs, items, p=Winnow()):
    d = spark.createDataFrame([(i, t, "x", 0) for i, t in enumerate(docs)], "doc_id long, text string, items string, ends int")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = {r.doc_id: tuple(r)[1:] for r in verdicts(contamination(d, b, p)).collect()}
    for i, t in enumerate(docs):
        assert got[i] == brute(t, items), (i, t)


def test_words():
    for t in ("A-b_c 1.5x É ß\x7f日本 z", "", "..", "aB\x00c"):
        assert words_of(t.encode()) == plain_words(t)


@pytest.mark.parametrize("blocks", [32 << 20, 40])
def test_equals_brute_force(spark, blocks):
    rng = random.Random(1)
    for letters in ("ab", "abcdefgh"):
        text = lambda n: " ".join(rng.choice(letters) for _ in range(n))  # noqa: E731, B023
        items = [(i, text(rng.choice([1, 3, 5, 7, 8, 9, 20]))) for i in range(6)] + [(None, "a b"), (90, None), (91, " .. "), (3, text(12))]
        docs = [text(rng.randint(0, 60)) for _ in range(40)] + [None, "", "!!", "a " * 300, items[0][1], "Q. " + items[3][1].upper() + "; z"]
        compared(spark, docs, items, Winnow(block_bytes=blocks))


def test_tables(spark, small):
    docs = [r.text for r in spark.read.parquet(f"{small}/documents.parquet").select("text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{small}/benchmark.parquet").select("item_id", "text").collect()]
    compared(spark, docs, items)


def test_no_items(spark):
    compared(spark, ["a b", None], [])


def test_every_span_of_eight_is_found():
    rng, p = random.Random(2), Winnow()
    for _ in range(300):
        y = [str(rng.randint(0, 3)).encode() for _ in range(20)]
        block = Block([(0, b" ".join(y))], p)
        at = rng.randint(0, 12)
        x = [b"q"] * rng.randint(0, 9) + y[at : at + 8] + [b"r"] * rng.randint(0, 9)
        assert block.hits(x, hashed(x))[1] == {0}


def test_rows_of_any_column_names(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i", 1, 2), (2, None, 3, 4)], "doc_id long, text string, `a b` int, `c.d` int")
    items = spark.createDataFrame([(7, "b c d e f g h i"), (8, "x y")], "item_id long, text string")
    for block in (32 << 20, 10):
        got = contamination(docs, items, Winnow(block_bytes=block), keep_rows=True)
        assert got.select("row.*").columns == docs.columns
        assert sorted((r.row["a b"], r.row["c.d"], r["items"]) for r in got.collect()) == [(1, 2, ["7"]), (3, 4, [])]
