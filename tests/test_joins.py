from __future__ import annotations

import bisect
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strataflow.operators import joins, sets
from strataflow.operators.filters import capped_by
from strataflow.operators.windows import first_per_key, keep_latest

DAY0 = dt.datetime(2024, 1, 1)
PLANS = [
    {"strategy": "range"},
    {"strategy": "window"},
    {"strategy": "window", "bucket_days": 0.5},
    {"strategy": "window", "hot_rows": 3, "bucket_days": 5},
    {},
]


def at(hours):
    return None if hours is None else DAY0 + dt.timedelta(hours=hours)


def asof(spark, left, right, **options):
    lf = spark.createDataFrame([(i, k, at(t)) for i, (k, t) in enumerate(left)], "i int, k string, t timestamp_ntz")
    rf = spark.createDataFrame([(k, at(t), v) for k, t, v in right], "rk string, rt timestamp_ntz, v string")
    out = joins.asof_left(lf, rf, {"k": "rk"}, "t", "rt", {"v": "value"}, **options)
    return {r.i: r.value for r in out.collect()}


@pytest.mark.parametrize("plan", PLANS)
def test_asof_edges(spark, plan):
    right = [("a", 10, "a1"), ("a", 20, "a2"), ("b", 5, "b1"), (None, 0, "none")]
    left = [("a", 9), ("a", 10), ("a", 19.99), ("a", 20), ("a", 9000), ("b", 6), ("c", 50), (None, 50), ("a", None)]
    want = [None, "a1", "a1", "a2", "a2", "b1", None, None, None]
    assert asof(spark, left, right, **plan) == dict(enumerate(want))


@pytest.mark.parametrize("plan", PLANS)
def test_asof_against_bisection_with_a_hot_key(spark, plan):
    rng = random.Random(7)
    right, left = [], []
    for n in range(300):
        right.append((rng.choice("aaaab"), rng.randrange(0, 2000), f"v{n}"))
    right = list({(k, t): (k, t, v) for k, t, v in right}.values())
    for _ in range(900):
        left.append((rng.choice("aaaaaabc"), rng.choice([500, rng.randrange(-50, 2100)])))
    by_key: dict[str, list] = {}
    for k, t, v in sorted(right):
        by_key.setdefault(k, []).append((t, v))
    want = {}
    for i, (k, t) in enumerate(left):
        rows = by_key.get(k, [])
        n = bisect.bisect_right([r[0] for r in rows], t)
        want[i] = rows[n - 1][1] if n else None
    assert asof(spark, left, right, **plan) == want


@pytest.mark.parametrize("plan", PLANS[:2])
def test_asof_keeps_copies_and_settles_ties(spark, plan):
    got = asof(spark, [("a", 5)] * 50, [("a", 1, "x"), ("a", 1, "y")], **plan)
    assert len(got) == 50 and len(set(got.values())) == 1


@pytest.mark.parametrize("strategy", ["range", "window"])
def test_asof_bounded_drops_matches_after_the_end(spark, strategy):
    left = spark.createDataFrame([(1, "a", at(2)), (2, "a", at(8)), (3, "a", at(20))], "i int, k string, t timestamp_ntz")
    right = spark.createDataFrame(
        [("a", at(1), at(5), "x"), ("a", at(10), None, "y")],
        "k string, f timestamp_ntz, e timestamp_ntz, v string",
    )
    out = joins.asof_left(left, right, {"k": "k"}, "t", "f", {"v": "v"}, valid_to="e", strategy=strategy)
    assert {r.i: r.v for r in out.collect()} == {1: "x", 2: None, 3: "y"}


def test_asof_plans(spark):
    left = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit(at(3)).alias("t"))
    right = left.withColumnRenamed("t", "f").withColumn("v", F.lit(1))

    def plan(**options):
        df = joins.asof_left(left, right, {"k": "k"}, "t", "f", {"v": "v"}, unique=True, **options)
        return df._jdf.queryExecution().executedPlan().toString()

    assert "BroadcastHashJoin" in plan() and "Cartesian" not in plan()
    assert "Window" in plan(max_broadcast_bytes=10) and "NestedLoop" not in plan(max_broadcast_bytes=10)
    with pytest.raises(ValueError, match="more than 10 bytes"):
        plan(strategy="range", max_broadcast_bytes=10)


def test_asof_with_one_deep_key_leaves_the_left_side_in_place(spark):
    hour = F.expr("timestampadd(HOUR, CAST(id AS INT), TIMESTAMP_NTZ'2024-01-01 00:00:00')")
    right = spark.range(10_000).select(F.lit("deep").alias("k"), hour.alias("f"), F.col("id").alias("v"))
    left = spark.range(0, 12_000, 3).select(
        F.when(F.col("id") % 2 == 0, "deep").otherwise("none").alias("k"),
        F.expr("timestampadd(MINUTE, CAST(id * 60 + 30 AS INT), TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("t"), "id",
    )
    df = joins.asof_left(left, right, {"k": "k"}, "t", "f", {"v": "v"}, unique=True)
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    got = {r.id: r.v for r in df.collect()}
    assert got == {i: (min(i, 9_999) if i % 2 == 0 else None) for i in range(0, 12_000, 3)}


@pytest.mark.parametrize("versions, probes", [(20_000, 300), (300, 20_000), (9_000, 9_000)])
def test_asof_cuts_part_the_work_of_both_sides(spark, versions, probes):
    second = F.expr("timestampadd(MILLISECOND, CAST(x AS INT), TIMESTAMP_NTZ'2024-01-05 00:00:00')")
    # Most of it in an hour of one stretch; the other keys are small.
    deep = spark.range(versions).select(F.lit("deep").alias("k"), (F.col("id") * 180).alias("x"), F.col("id").alias("v"))
    other = spark.range(50).select(F.col("id").cast("string").alias("k"), (F.col("id") * 7).alias("x"), F.col("id").alias("v"))
    right = deep.unionByName(other).select("k", second.alias("f"), "v")
    at = F.when(F.col("id") % 3 > 0, F.pmod(F.xxhash64("id"), F.lit(3_600_000))).otherwise(F.lit(1_000_000))
    left = spark.range(probes).select(F.lit("deep").alias("k"), at.alias("x"), "id").select("k", second.alias("t"), "id")

    rows = joins.asof_versions(right, "k", "f", ["v"], unique=True, strategy="window").rows
    bucket = F.lit(0).alias("_b")
    times = left.select(F.col("k").alias("_k"), bucket, F.col("t").alias("_t")).unionByName(rows.select("_k", bucket, F.col("_from").alias("_t")))
    cuts = joins._equal_cuts(times, 1000)
    spread = left.where("id % 3 > 0").select(F.col("k").alias("_k"), bucket, F.col("t").alias("_t")).unionByName(
        rows.select("_k", bucket, F.col("_from").alias("_t"))
    )
    sizes = sorted(r["count"] for r in joins._with_pieces(spread, cuts).where("_k = 'deep'").groupBy("_p").count().collect())
    assert len(sizes) >= 10 and sizes[-1] <= 2 * sizes[len(sizes) // 2]

    out = joins.asof_left(left, right, {"k": "k"}, "t", "f", {"v": "v"}, unique=True, strategy="window", hot_rows=1000)
    plain = joins.asof_left(left, right, {"k": "k"}, "t", "f", {"v": "v"}, unique=True, strategy="range")
    got = sorted((r.id, r.v) for r in out.collect())
    assert len(got) == probes and got == sorted((r.id, r.v) for r in plain.collect())


def test_asof_both_legs_share_one_cut_table(spark):
    right = spark.createDataFrame([("a", at(1), 1), ("b", at(1), 2), ("b", at(6), 3)], "k string, f timestamp_ntz, v int")
    left = spark.createDataFrame([(1, "a", "b", at(5)), (2, "b", "c", at(7))], "i int, x string, y string, t timestamp_ntz")
    versions = joins.asof_versions(right, "k", "f", ["v"], unique=True)
    out = joins.asof_left(left, versions, {"x": "k"}, "t", "f", {"v": "vx"})
    out = joins.asof_left(out, versions, {"y": "k"}, "t", "f", {"v": "vy"})
    assert sorted((r.i, r.vx, r.vy) for r in out.collect()) == [(1, 1, 2), (2, 3, None)]
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


def test_asof_size_is_that_of_the_cut_intervals(spark):
    right = spark.range(2000).select(
        (F.col("id") % 500).cast("string").alias("k"), F.expr("timestampadd(HOUR, CAST(id AS INT), TIMESTAMP_NTZ'2024-01-01 00:00:00')").alias("f"), F.lit(1).alias("a_column_with_a_long_name")
    )
    v = joins.asof_versions(right, "k", "f", ["a_column_with_a_long_name"], unique=True)
    size = v.cut.agg(F.sum(joins._row_bytes(v.rows))).first()[0]
    assert joins.asof_versions(right, "k", "f", ["a_column_with_a_long_name"], unique=True, max_broadcast_bytes=2 * size).cut is not None
    assert joins.asof_versions(right, "k", "f", ["a_column_with_a_long_name"], unique=True, max_broadcast_bytes=size // 2).cut is None


def test_lookup_left_keeps_unmatched_rows(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "name string, i int")
    lookup = spark.createDataFrame([("a", "ID1"), (None, "IDX")], "n string, id string")
    got = joins.lookup_left(df, lookup, {"name": "n"}, {"id": "found"})
    assert got.columns == ["name", "i", "found"]
    assert {r.i: r.found for r in got.collect()} == {1: "ID1", 2: None, 3: None}


def test_lookup_on_derived_key(spark):
    df = spark.createDataFrame([(1, at(3.5))], "i int, t timestamp_ntz")
    hours = spark.createDataFrame([(at(3), 7.0)], "h timestamp_ntz, temp double")
    got = joins.lookup_on(df, hours, F.date_trunc("hour", "t").cast("timestamp_ntz"), "h", {"temp": "temp"})
    assert got.first().temp == 7.0 and got.columns == ["i", "t", "temp"]


def test_missing_in_counts_rows_and_skips_null(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k int")
    parent = spark.createDataFrame([(1,)], "p int")
    assert [tuple(r) for r in joins.missing_in(child, "k", parent, "p").collect()] == [(2, 2)]


def test_star_joins_each_dimension_once(spark):
    fact = spark.createDataFrame([(1, 10, 5.0), (2, 20, 6.0)], "d int, s int, m double")
    days = spark.createDataFrame([(1, "Mon"), (2, "Tue")], "dk int, name string")
    stations = spark.createDataFrame([(10, "X")], "sk int, station string")
    got = joins.star(fact, [(days, "d", "dk"), (stations, "s", "sk")])
    assert [(r.name, r.station, r.m) for r in got.collect()] == [("Mon", "X", 5.0)]


def test_keep_latest_is_deterministic_on_ties(spark):
    rows = [("r", 1, "x", None), ("r", 1, "y", 2.0), ("r", 1, "y", 3.0), ("q", 0, None, None), (None, 1, "z", 1.0)]
    df = spark.createDataFrame(rows, "k string, n int, a string, b double")
    want = {("r", 1, "y", 3.0), ("q", 0, None, None), (None, 1, "z", 1.0)}
    for parts in (1, 2, 5):
        assert {tuple(r) for r in keep_latest(df.repartition(parts), ["k"], ["n"]).collect()} == want


def test_keep_latest_limits_before_the_shuffle(spark):
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    plan = keep_latest(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_first_per_key_puts_null_last(spark):
    df = spark.createDataFrame([("a", None, 0), ("a", "B", 1), ("a", "B", 0)], "k string, n string, leg int")
    got = first_per_key(df, ["k"], [F.col("n").asc_nulls_last(), F.col("leg")]).first()
    assert (got.n, got.leg) == ("B", 0)


def test_date_spine_excludes_the_end(spark):
    days = [r[0].isoformat() for r in sets.date_spine(spark, "2023-12-30", "2024-01-02").collect()]
    assert days == ["2023-12-30", "2023-12-31", "2024-01-01"]
    for end in ("2023-12-30", "2023-12-29", "2020-01-01"):
        assert sets.date_spine(spark, "2023-12-30", end).isEmpty()
    bound = spark.createDataFrame([(dt.date(2023, 12, 30),)], "d date")
    assert capped_by(sets.date_spine(spark, "2023-12-30", "2024-01-02"), "date_day", bound).count() == 1


def test_single_valued(spark):
    rows = [("one", "1"), ("one", "1"), ("two", "1"), ("two", "2"), ("none", None), (None, "9")]
    got = sets.single_valued(spark.createDataFrame(rows, "n string, i string"), "n", "i", "id")
    assert [tuple(r) for r in got.collect()] == [("one", "1")]


def test_null_profile(spark):
    df = spark.createDataFrame([(at(1), 1), (at(2), None), (at(30), 2)], "t timestamp_ntz, v int")
    got = {r.day.day: (r.row_count, r.null_count, r.null_percent) for r in sets.null_profile(df, "v", "t").collect()}
    assert got == {1: (2, 1, 50.0), 2: (1, 0, 0.0)}
