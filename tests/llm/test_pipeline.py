import hashlib
import re

import corpus_pipeline as P
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loomgraph.llm import secret_forest
from loomgraph.llm.quality_divergence import quality
from tests_llm_brute import contaminated, near_components


@pytest.fixture(scope="module")
def stages(spark, small):
    docs, out = spark.read.parquet(f"{small}/documents.parquet").cache(), []
    for _, f in P.STAGES:
        out.append((docs, docs := f(spark, docs, small).cache()))
    return out


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_columns(stages):
    assert all(after.columns == before.columns for before, after in stages[:-1])


def test_quality(stages):
    before, after = stages[0]
    assert set(by_id(after)) == {r.doc_id for r in quality(before).collect() if r.kept}
    assert {i: r.text for i, r in by_id(after).items()}.items() <= {i: r.text for i, r in by_id(before).items()}.items()


def test_near_duplicates(stages):
    before, after = stages[1]
    root = near_components({i: r.text for i, r in by_id(before).items()}, 5, 80)
    assert set(by_id(after)) == {i for i, r in root.items() if i == r}


def test_decontamination(spark, stages, small):
    before, after = stages[2]
    items = [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    assert set(by_id(after)) == {i for i, r in by_id(before).items() if not contaminated(r.text, items)}


def test_secrets(spark, stages):
    before, after = map(by_id, stages[3])
    assert set(before) == set(after)
    found = {}
    for r in secret_forest.findings(stages[3][0], secret_forest.default_forest(spark)).where("secret").collect():
        found.setdefault(r.doc_id, []).append(r)
    for i, r in before.items():
        text = r.text
        for f in sorted(found.get(i, []), key=lambda f: -f.start):
            assert text[f.start : f.start + f.length] == f.candidate
            text = text[: f.start] + secret_forest.MASK + text[f.start + f.length :]
        assert (after[i].text, after[i].n_chars) == (text, len(text))
        assert not re.search(r"AKIA[0-9A-Z]{16}|password=[0-9a-f]{18}|token = \"[0-9a-f]{40}", text)


def test_tokens(stages):
    before, after = map(by_id, stages[4])
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert set(before) == set(after)
    for i, r in before.items():
        ids = lib.encode(r.text, add_special_tokens=False).ids
        assert (after[i].n_tokens, after[i].ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())


def test_run_and_odd_tables(spark, stages, small, tmp_path):
    assert {tuple(r) for r in P.run(spark, small).collect()} == {tuple(r) for r in stages[-1][1].collect()}
    spark.read.parquet(f"{small}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    odd = [(None, "a b c " * 30, None, None, None), (1, None, "en", "s", 0), (2, "", "xx", None, None), (3, "x" * 200000, "en", "s", 1), (3, "x" * 200000, "en", "s", 1)]
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        for _, f in P.STAGES:
            docs = f(spark, docs, str(tmp_path))
        docs.collect()


def test_near_duplicates_goes_by_rows(spark, tmp_path):
    t, u = " ".join(f"w{i}" for i in range(40)), " ".join(f"v{i}" for i in range(40))
    rows = [(1, t, 1), (4, t, 2), (4, u, 3), (None, t, 4), (6, None, 5), (7, u + " x", 6), (1, t, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `c.d` int")
    got = P.near_duplicates(spark, docs, str(tmp_path))
    assert got.columns == docs.columns
    assert sorted(r["c.d"] for r in got.collect()) == [1, 3, 4, 5, 7]
