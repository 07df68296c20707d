from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strataflow.operators import quality as q
from strataflow.operators.windows import trailing
from strataflow.plans import checks


@pytest.fixture(scope="module")
def tables(spark):
    day = dt.datetime(2024, 1, 1)
    rows = [(1, "member", day), (2, "casual", day), (2, None, None), (None, "MEMBER", day)]
    return {
        "t": spark.createDataFrame(rows, "k int, kind string, ts timestamp"),
        "p": spark.createDataFrame([(1,), (3,)], "k int"),
        "none": spark.createDataFrame([], "k int, ts timestamp"),
    }


def result(tables, check, as_of="2024-01-31"):
    r = q.run_checks(tables, [check], as_of).collect()
    assert len(r) == 1
    return r[0].failing_rows, r[0].passed


@pytest.mark.parametrize(
    "check, want",
    [
        (q.row_count("t"), (0, True)),
        (q.row_count("none"), (1, False)),
        (q.not_null("t", "k"), (1, False)),
        (q.missing_count("p", "k"), (0, True)),
        (q.unique("t", "k"), (1, False)),
        (q.unique("p", "k"), (0, True)),
        (q.accepted_values("t", "kind", ["member", "casual"]), (1, False)),
        (q.invalid_count("t", "kind", ["member", "casual", "MEMBER"]), (0, True)),
        (q.relationships("t", "k", "p", "k"), (2, False)),
        (q.relationships("p", "k", "p", "k"), (0, True)),
        (q.freshness("t", "ts", 40), (0, True)),
        (q.freshness("t", "ts", 30), (1, False)),
        (q.freshness("none", "ts", 40), (1, False)),
    ],
)
def test_checks(tables, check, want):
    assert result(tables, check) == want


def test_row_level_checks_share_one_pass(tables):
    df = q.run_checks(
        {"t": tables["t"]}, [q.row_count("t"), q.not_null("t", "k"), q.freshness("t", "ts", 40)], "2024-01-31"
    )
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and df.count() == 3


def test_gate_stops_on_errors_only(tables):
    warn = q.run_checks(tables, [q.not_null("t", "k", severity="warn"), q.row_count("t")], "2024-01-31")
    assert len(q.gate(warn)) == 2
    with pytest.raises(q.QualityError, match=r"not_null\(t.k\): 1"):
        q.gate(q.run_checks(tables, [q.not_null("t", "k"), q.row_count("t")], "2024-01-31"))


def test_anomaly_scores(spark):
    values = [1.0, 2.0] * 10 + [50.0]
    series = spark.createDataFrame(list(enumerate(values)), "day int, v double")
    rows = q.anomaly_scores(series, "v").orderBy("day").collect()
    assert [r.score for r in rows[:7]] == [None] * 7
    assert [r.day for r in rows if r.anomalous] == [20]
    flat = spark.createDataFrame([(i, 0.0) for i in range(20)], "day int, v double")
    assert q.anomaly_scores(flat, "v").where("anomalous").count() == 0


def test_column_anomalies_find_the_day_of_nulls(spark):
    df = spark.range(30 * 20).select(
        F.expr("timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, int(id % 30))").alias("ts"),
        F.when((F.col("id") % 30 == 29) | (F.col("id") < F.col("id") % 30 * 0 + 15), None).otherwise(1).alias("c"),
    )
    failing, passed = result({"t": df}, q.column_anomalies("t", "c", "ts", "null_percent"))
    assert (failing, passed) == (1, False)


def test_every_declared_check_is_there():
    declared = checks.BRONZE_CHECKS + checks.SILVER_CHECKS + checks.GOLD_CHECKS
    kinds = [c.kind for c in declared]
    assert (kinds.count("not_null"), kinds.count("unique")) == (28, 8)
    assert (kinds.count("accepted_values"), kinds.count("relationships")) == (5, 5)
    assert len(checks.LANDED_CHECKS) == 7


def test_trailing_windows_over_blocks(spark):
    values = [(i * 7919 % 1000, float(i % 13)) for i in range(1000)]
    series = spark.createDataFrame(values, "t int, v double").repartition(7)
    sums = {"n": lambda past: F.count("v").over(past), "s": lambda past: F.sum("v").over(past)}
    ordered = sorted(values)
    for rows, block in ((14, 50), (60, 10), (5, 100_000)):
        got = trailing(series, ["t"], rows, sums, block).orderBy("t").collect()
        assert [(r.t, r.v) for r in got] == ordered
        for k, r in enumerate(got):
            past = [v for _, v in ordered[max(0, k - rows) : k]]
            assert (r.n, r.s or 0.0) == (len(past), sum(past))
    assert trailing(series.limit(0), ["t"], 5, sums).count() == 0
    text = trailing(series, ["t"], 14, sums)._jdf.queryExecution().toString()
    assert "windowspecdefinition(_block#" in text
