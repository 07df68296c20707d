from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataflow.llm import quality
from strataflow.llm.common import id_fold

SCHEMA = "doc_id long, text string, score double, held_out int"


def texts(n, seed=0):
    """(text, is_good): prose, and four kinds of junk."""
    rng = random.Random(seed)
    syllables = "an ter ou sha mi lo ken ri po sta ne".split()

    def word():
        return "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))

    out = []
    for k in range(n):
        words = [word() for _ in range(rng.randint(30, 200))]
        if k % 8 == 0:
            out.append((" ".join(w.upper() + "!!" for w in words), False))
        elif k % 8 == 1:
            out.append((" ".join([words[0]] * len(words)), False))
        else:
            prose = [w + "," * (rng.random() < 0.1) for w in words]
            out.append((" ".join(prose).capitalize() + ".", True))
    return out


def test_non_negative_risk_and_prior():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(2, 1, (2000, 3)), rng.normal(-2, 1, (2000, 3))
    unlabelled = np.vstack([good[:1400], bad[:600]])
    model = quality.fit(good[1400:], unlabelled)
    assert model.prior == pytest.approx(0.7, abs=0.06)
    assert (model.score(good) >= 0.3).mean() > 0.97 and (model.score(bad) < 0.3).mean() > 0.97


def test_held_out_accuracy(spark):
    rows = texts(800)
    docs = spark.createDataFrame([(k, t, 0.0, 1) for k, (t, _) in enumerate(rows)], SCHEMA)
    labels = spark.createDataFrame(
        [(k, int(g), 0) for k, (_, g) in enumerate(rows) if k % 3] + [(9999, 1, 0), (5, 1, 1)], "doc_id long, quality int, toxic int"
    )
    fold = id_fold(F.col("doc_id"), 5)
    model = quality.train(docs, labels, fold != 0, max_rows=400)
    held = docs.where(fold == 0)
    got = {r.doc_id: r for r in quality.score(held, model, ["doc_id"]).collect()}
    right = [got[k].predicted == int(rows[k][1]) for k in got]
    assert len(right) > 100 and sum(right) / len(right) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    kept = quality.keep_good(held, model)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k for k, r in got.items() if r.predicted}


def test_learns_nothing_from_held_out_rows(spark):
    rows = texts(120)
    docs = spark.createDataFrame([(k, t, 0.0, 1) for k, (t, _) in enumerate(rows)], SCHEMA)
    fold = id_fold(F.col("doc_id"), 5)
    made = [
        quality.train(
            docs,
            docs.select("doc_id", F.when(fold == 0, F.lit(q)).otherwise((F.col("doc_id") % 8 > 1).cast("int")).alias("quality")),
            fold != 0,
        )
        for q in (0, 1)
    ]
    assert made[0] == made[1]


def test_odd_rows(spark):
    model = quality.fit(
        [quality.measures(t) for t, g in texts(100) if g], [quality.measures(t) for t, _ in texts(200, 1)]
    )
    rows = [(1, None), (2, ""), (None, "a"), (3, "x" * 300_000), (4, "same"), (4, "same"), (5, "\x00 ퟿ 𝔘 ​")]
    df = spark.createDataFrame([(i, t, 1.0, 2) for i, t in rows], SCHEMA)
    got = quality.score(df.drop("score", "held_out"), model, ["doc_id"]).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 4}) == 1
    assert quality.score(df.limit(0), model, ["doc_id"]).count() == 0
    blank = quality.train(df, spark.createDataFrame([], "doc_id long, quality int"), F.lit(True))
    assert {r.score for r in quality.score(df, blank, ["doc_id"]).collect()} == {0.5}
