import random

import pytest
from tests_llm_brute import near_components, shingles

from loomgraph.llm.near_dedup import NearDup, near_duplicates


def compared(spark, rows, p):
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_shingles int, kept string")
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs, p).collect()}
    texts = {r[0]: r[1] for r in rows}
    root = near_components(texts, p.shingle, p.num)
    assert got == {i: (len(shingles(t, p.shingle)), root[i], root[i] == i) for i, t in texts.items()}
    return got


def families(seed):
    """Copies with word edits, copies of copies, cut copies, a passage that many share, short texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 5)))
    text = lambda n: [word() for _ in range(n)]
    passage, out = text(30), []
    for size in (12, 60, 150, 400):
        base = text(size)
        out.append(base)
        for _ in range(25):
            t = list(rng.choice(out[-5:]) if rng.random() < 0.2 else base)
            for _ in range(rng.randint(0, max(1, size // 25))):
                t[rng.randrange(len(t))] = word()
            if rng.random() < 0.3:
                t = t[: int(len(t) * rng.uniform(0.75, 1))]
            out.append(t)
    for _ in range(25):
        t = text(rng.randint(5, 60))
        at = rng.randint(0, len(t))
        out.append(t[:at] + passage + t[at:])
    out += [text(rng.randint(1, 4)) for _ in range(10)] + [["a"], ["a", "b"], ["a", "b", "a", "b"], []]
    rows = [" ".join(t) for t in out]
    rows += [rows[1], rows[1].upper(), "  \n\t", ""]
    rng.shuffle(rows)
    return [(7 * i + 3, t, 1, "x") for i, t in enumerate(rows)] + [(1, None, 1, "x")]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    compared(spark, families(seed), NearDup(shingle=3, num=85))


def test_five_words(spark):
    compared(spark, families(3), NearDup())


def test_odd_tables(spark):
    schema = "doc_id long, text string"
    assert near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f"), (3, "A b c d e f"), (4, None), (4, "x" * 300000)]
    got = sorted(map(str, (tuple(r) for r in near_duplicates(spark.createDataFrame(rows, schema)).collect())))
    assert got == sorted(map(str, [(None, 2, None, True), (None, 2, None, True), (2, 2, 2, True), (2, 2, 2, True), (3, 2, 2, False), (4, 0, 4, True), (4, 1, 4, True)]))


def test_large_family(spark):
    """Over a thousand copies of one text with edits, many at the border of the similarity, a passage that all others
    quote, and copies of an edited copy: the same components as by brute force."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    base, passage = [word() for _ in range(110)], [word() for _ in range(25)]
    branch = [w if i % 14 else word() for i, w in enumerate(base)]
    texts = []
    for k in range(1100):
        t = list(branch if k % 5 == 0 else base)
        for _ in range(rng.choice([0, 1, 2, 3, 3, 4, 4])):
            t[rng.randrange(len(t))] = word()
        texts.append(t[: rng.choice([110, 110, 110, 100, 92])])
    texts += [[word() for _ in range(60)] + passage for _ in range(150)]
    rows = [(i + 1, " ".join(t), 1, "x") for i, t in enumerate(texts)]
    rng.shuffle(rows)
    compared(spark, rows, NearDup(shingle=3, num=85))


def test_exact_way(spark):
    compared(spark, families(5), NearDup(shingle=3, num=85, k=None))
