from __future__ import annotations

import math

import numpy as np
from pyspark.sql import functions as F

from strataflow.llm import ann

SCHEMA = "vec_id long, embedding array<double>, label int, v int, dim int"


def brute(rows, is_query, k):
    good = [
        (i, np.array(v)) for i, v in rows
        if i is not None and v and None not in v and np.isfinite(v).all() and np.any(np.array(v) != 0)
    ]
    out = {}
    for q, a in good:
        if is_query(q):
            near = sorted(
                (float(np.sqrt(sum((x - y) ** 2 for x, y in zip(a.tolist(), b.tolist())))), i)
                for i, b in good if i != q and len(a) == len(b)
            )
            out[q] = near[:k]
    return out


def run(spark, rows, k=10, **settings):
    df = spark.createDataFrame([(i, v, 0, 1, 2) for i, v in rows], SCHEMA)
    got = ann.search(df, F.col("vec_id") % 10 == 0, k=k, **settings).collect()
    out: dict = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_recall(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 1, (12, 48))
    rows = [(k, (centres[k % 12] + rng.normal(0, 0.4, 48)).tolist()) for k in range(900)]
    got, want = run(spark, rows, block_queries=40), brute(rows, lambda q: q % 10 == 0, 10)
    assert got.keys() == want.keys()
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.99 * 10 * len(want)
    assert all(abs(dict((i, s) for s, i in want[q]).get(i, s) - s) < 1e-12 for q in got for s, i in got[q])


def test_ties_and_odd_vectors(spark):
    rows = [(k, [1.0, 2.0, 0.0]) for k in range(30)]
    rows += [(100, [1.0, 2.0, 3.0]), (101, [0.0, 0.0, 0.0]), (102, None), (103, [1.0, None, 2.0]), (104, [float("nan"), 1.0, 1.0])]
    rows += [(110, [float("inf"), 1.0, 1.0]), (120, [1.0, 1.0]), (121, [2.0, 1.0]), (None, [1.0, 2.0, 0.1]), (130, [])]
    assert run(spark, rows, k=5) == brute(rows, lambda q: q % 10 == 0, 5)


def test_few_and_none(spark):
    assert run(spark, [(10, [1.0]), (11, [3.0])]) == {10: [(2.0, 11)]}
    assert run(spark, [(10, [1.0])]) == {}
    assert run(spark, []) == {}


def test_bounds_hold():
    rng = np.random.default_rng(1)
    data, queries = rng.normal(size=(500, 64)), rng.normal(size=(20, 64))
    centre, turn = data.mean(axis=0), ann.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    code, norm, kept = ann.encode(data, centre, turn)
    signs = (np.unpackbits(code, axis=1) * 2.0 - 1) / 8
    for q in queries - centre:
        unit = q / np.linalg.norm(q)
        true = ((data - centre) / norm[:, None]) @ unit
        off = 4 * np.sqrt((1 - kept**2) / 63) / kept
        assert (np.abs(signs @ (unit @ turn) / kept - true) <= off).mean() > 0.999


def test_components_near_the_limits_of_doubles(spark):
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(size=6).tolist()) for k in range(40)]
    for extra in (
        [(50, [1e200, 0.0, 0.0, 0.0, 0.0, 0.0])],
        [(50, [1e308, -1e308, 0.0, 0.0, 0.0, 1.0]), (60, [-1e308, 1e308, 0.0, 0.0, 0.0, 0.0]), (61, [1e300] * 6)],
        [(k + 50, [1e-200 * (j + k) for j in range(6)]) for k in range(12)],
    ):
        every = rows + extra
        got = run(spark, every, k=4)
        want = {}
        for q, a in every:
            if q % 10 == 0:
                near = sorted((math.dist(a, b), i) for i, b in every if i != q)[:4]
                want[q] = near
        assert got.keys() == want.keys()
        for q in want:
            assert [i for _, i in got[q]] == [i for _, i in want[q]]
            assert np.allclose([d for d, _ in got[q]], [d for d, _ in want[q]], rtol=1e-12)


def test_only_tiny_vectors(spark):
    rows = [(k, [1e-200 * k, 2e-310, 1e-200]) for k in range(25)]
    got = run(spark, rows, k=3)
    assert [i for _, i in got[10]] == [9, 11, 8] and [i for _, i in got[0]] == [1, 2, 3]
