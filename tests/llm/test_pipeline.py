from __future__ import annotations

import os
import shutil

import pytest

import corpus_pipeline
from strataflow.llm import decontaminate, simhash
from strataflow.llm.queries import tokenizer_file

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not present")


def test_each_stage_on_its_own_input(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept, names = [], [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    df = docs
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        step(spark, df, SF_DIR).write.parquet(f"{tmp_path}/{k}")
        before, df = df, spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert df.columns == docs.columns
        kept.append((before, df))

    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    good = {r.doc_id for r in kept[0][1].collect()}
    right = [(i in good) == bool(q) for i, q in labels.items()]
    assert sum(right) / len(right) > 0.95

    prints = {r.doc_id: simhash.fingerprint(r.text) for r in kept[1][0].collect()}
    left = [prints[r.doc_id] for r in kept[1][1].collect()]
    far = [bin((a ^ b) & (2**64 - 1)).count("1") > 3 for n, a in enumerate(left) for b in left[:n]]
    assert all(far)
    own = {i: i for i in prints}

    def find(x):
        while own[x] != x:
            x = own[x]
        return x

    ids = sorted(prints)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if bin((prints[a] ^ prints[b]) & (2**64 - 1)).count("1") <= 3:
                x, y = find(a), find(b)
                own[max(x, y)] = min(x, y)
    assert {r.doc_id for r in kept[1][1].collect()} == {find(i) for i in ids}

    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    hit = {r.doc_id for r in decontaminate.scan(kept[2][0], items).where("n_hit > 0").collect()}
    assert {r.doc_id for r in kept[2][0].collect()} - hit == {r.doc_id for r in kept[2][1].collect()}

    from tokenizers import Tokenizer

    own_tokenizer = Tokenizer.from_file(tokenizer_file())
    rows = sorted((r.doc_id, r.text) for r in kept[4][0].collect())
    lengths = [len(own_tokenizer.encode(t, add_special_tokens=False).ids) + 1 for _, t in rows]
    got = sorted((r.start, r.doc_id, r.n_tokens) for r in kept[4][1].collect())
    assert [(i, n) for _, i, n in got] == [(i, n) for (i, _), n in zip(rows, lengths)]
    assert [s for s, _, _ in got] == [sum(lengths[:k]) for k in range(len(lengths))]


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    shutil.rmtree(tmp_path)
