from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strataflow.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _key string, size int"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, "k", 1) for i, t, s in rows], SCHEMA)


def fill(total, sizes, weights, most=2.0):
    """Targets by dealing the excess again and again."""
    held = {}
    while True:
        rest = total - sum(held.values())
        open_ = [k for k in sizes if k not in held]
        share = sum(weights[k] for k in open_)
        level = rest / share if share else 0
        over = [k for k in open_ if weights[k] * level > most * sizes[k]]
        if not over:
            return {**held, **{k: weights[k] * level for k in open_}}
        held |= {k: most * sizes[k] for k in over}


def test_targets_and_taken(spark):
    rows = [(i, "w " * (1 + i * 7 % 23), f"s{i % 7}" if i % 5 else None) for i in range(400)]
    rows += [(1000 + i, "w " * 9, "hot") for i in range(300)]
    got = mixing.plan(docs(spark, rows)).collect()
    sizes: dict = {}
    for r in rows:
        sizes[r[2]] = sizes.get(r[2], 0) + len(r[1].split())
    names = sorted((k for k in sizes if k is not None)) + [None]
    weights = {k: (5, 2, 1)[n % 3] for n, k in enumerate(names)}
    want = fill(1.5 * sum(sizes.values()), sizes, weights)
    source = {r[0]: r[2] for r in rows}
    taken: dict = {}
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert r.taken in (0, r.size, 2 * r.size) and len(r.positions) == r.copies
        assert all(0 <= p <= 1 for p in r.positions)
        taken[s] = taken.get(s, 0) + r.taken
    assert len(got) == len(rows)
    for s, t in want.items():
        assert abs(taken[s] - t) <= 12


def test_reruns_agree_and_order(spark):
    df = docs(spark, [(i, f"a b {i}", f"s{i % 3}") for i in range(60)])
    a = mixing.mix(df)
    assert a.columns == df.columns
    rows = [r.doc_id for r in a.collect()]
    assert rows == [r.doc_id for r in mixing.mix(df.repartition(5)).collect()]
    place = {(r.doc_id, k): p for r in mixing.plan(df).collect() for k, p in enumerate(r.positions)}
    assert sorted(place.values()) == pytest.approx(sorted(place.values()))
    assert len(rows) == len(place)


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, "x y", "a"), (None, "x y", "a"), (3, "x", None), (3, "x", None), (4, "z", "b")]
    got = mixing.plan(docs(spark, rows)).collect()
    assert sorted(r.size for r in got) == [0, 0, 1, 1, 1, 2, 2]
    assert all(r.copies == 1 and r.taken == 0 for r in got if r.size == 0)
    mixed = mixing.mix(docs(spark, rows)).collect()
    assert len(mixed) == sum(r.copies for r in got)
    assert mixing.plan(docs(spark, [])).count() == 0 and mixing.mix(docs(spark, [])).count() == 0


def test_rows_that_differ_in_one_column_stay_apart(spark):
    rows = [(7, "a b c", s, lang) for s, lang in (("x", "en"), ("x", "de"), ("y", "en"), (None, None))] * 5
    rows += [(i, f"w {i}", "x", "en") for i in range(40)] + [(None, None, None, None)] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    want: dict = {}
    for r in mixing.plan(df.withColumn("row", F.to_json(F.struct("*"))), keep=["row"]).collect():
        want[r.row] = want.get(r.row, 0) + r.copies
    for parts in (3, 11):
        got: dict = {}
        for r in mixing.mix(df.repartition(parts)).withColumn("row", F.to_json(F.struct("*"))).collect():
            got[r.row] = got.get(r.row, 0) + 1
        assert got == {k: n for k, n in want.items() if n}
    assert got["{}"] == 300


def test_columns_with_odd_and_clashing_names(spark):
    df = docs(spark, [(1, "a b", "s"), (1, "a b", "s"), (2, "c", "s")])
    odd = df.select("*", *[F.lit(1).alias(c) for c in ("_position", "_nth", "_part", "row", "whole", "a.b")])
    out = mixing.mix(odd)
    assert out.columns == odd.columns and out.count() == mixing.mix(df).count()


def test_time_of_inverts_the_integral(spark):
    from pyspark.sql import functions as F

    for knots in (mixing.FADE, mixing.LEVEL, mixing.RISE, ((0.0, 0.0), (0.25, 4.0), (1.0, 0.0))):
        shares = [k / 20 for k in range(21)]
        df = spark.createDataFrame([(s,) for s in shares], "s double")
        times = [r.t for r in df.select(mixing.time_of(F.col("s"), knots).alias("t")).collect()]

        def area(t, knots=knots):
            out = 0.0
            for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
                u = min(max(t, t0), t1)
                w = w0 + (w1 - w0) * (u - t0) / (t1 - t0)
                out += (u - t0) * (w0 + w) / 2
            return out

        assert [area(t) / area(1.0) for t in times] == pytest.approx(shares, abs=1e-9)
