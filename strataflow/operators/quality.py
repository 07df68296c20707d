"""Data checks between the layers.

A check is a plain value; ``run_checks`` turns a list of them into one
DataFrame.  All row-level checks of a table share a single aggregation pass;
uniqueness and references count by key before they compare, so a hot key does
not weigh on one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.logic import count_where
from strataflow.operators.joins import missing_in
from strataflow.operators.sets import null_profile
from strataflow.operators.windows import trailing

RESULT_COLUMNS = (
    "check_name",
    "table_name",
    "column_name",
    "severity",
    "failing_rows",
    "observed",
    "passed",
)


@dataclass(frozen=True)
class Check:
    kind: str
    table: str
    column: str | None = None
    severity: str = "error"
    values: tuple[str, ...] = ()
    parent: str | None = None
    parent_column: str | None = None
    max_age_days: float | None = None
    timestamp: str | None = None
    metric: str | None = None


def row_count(table: str, severity: str = "error") -> Check:
    """The table has rows."""
    return Check("row_count", table, severity=severity)


def not_null(table: str, column: str, severity: str = "error") -> Check:
    return Check("not_null", table, column, severity)


def missing_count(table: str, column: str, severity: str = "error") -> Check:
    """No value is missing."""
    return Check("missing_count", table, column, severity)


def unique(table: str, column: str, severity: str = "error") -> Check:
    """No value occurs twice; NULLs are ignored. Failing rows are the repeated values."""
    return Check("unique", table, column, severity)


def accepted_values(table: str, column: str, values: Sequence[str], severity: str = "error") -> Check:
    """Every value is listed; NULL passes."""
    return Check("accepted_values", table, column, severity, values=tuple(values))


def invalid_count(table: str, column: str, values: Sequence[str], severity: str = "error") -> Check:
    """No value is outside the valid list; a missing value is not invalid."""
    return Check("invalid_count", table, column, severity, values=tuple(values))


def freshness(table: str, column: str, max_age_days: float, severity: str = "error") -> Check:
    """The newest value is less than so many days older than ``as_of``."""
    return Check("freshness", table, column, severity, max_age_days=max_age_days)


def relationships(
    child: str, column: str, parent: str, parent_column: str, severity: str = "error"
) -> Check:
    """Every non-NULL key exists in the parent. Failing rows are child rows."""
    return Check(
        "relationships", child, column, severity, parent=parent, parent_column=parent_column
    )


def column_anomalies(
    table: str, column: str, timestamp: str, metric: str = "null_count", severity: str = "warn"
) -> Check:
    """No day's NULL count or percentage stands out from the days before it."""
    return Check(
        "column_anomalies", table, column, severity, timestamp=timestamp, metric=metric
    )


def _row(check: Check, failing: Column, observed: Column, passed: Column) -> Column:
    return F.struct(
        F.lit(check.kind).alias("check_name"),
        F.lit(check.table).alias("table_name"),
        F.lit(check.column or "").alias("column_name"),
        F.lit(check.severity).alias("severity"),
        failing.cast("bigint").alias("failing_rows"),
        observed.cast("string").alias("observed"),
        passed.alias("passed"),
    )


def _fused(df: DataFrame, checks: Sequence[Check], as_of: datetime | str) -> DataFrame:
    """All row-level checks of one table in one pass."""
    aggregates, rows = [], []
    for i, check in enumerate(checks):
        name = f"_{i}"
        if check.kind == "row_count":
            aggregates.append(F.count(F.lit(1)).alias(name))
            failing = (F.col(name) == 0).cast("bigint")
            rows.append(_row(check, failing, F.col(name), F.col(name) > 0))
            continue
        column = F.col(check.column)
        if check.kind == "freshness":
            aggregates.append(F.max(column).alias(name))
            now = F.lit(str(as_of)).cast("timestamp")
            age = F.unix_micros(now) - F.unix_micros(F.col(name).cast("timestamp"))
            limit = F.lit(int(check.max_age_days * 86_400_000_000))
            fresh = F.coalesce(age < limit, F.lit(False))
            observed = F.date_format(F.col(name), "yyyy-MM-dd HH:mm:ss")
            rows.append(_row(check, (~fresh).cast("bigint"), observed, fresh))
            continue
        if check.kind in ("not_null", "missing_count"):
            broken = column.isNull()
        else:
            broken = ~column.isin(*check.values)
        aggregates.append(count_where(broken).alias(name))
        rows.append(_row(check, F.col(name), F.col(name), F.col(name) == 0))
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def _counted(check: Check, failing: DataFrame) -> DataFrame:
    """One result row from a one-row frame holding ``failing``."""
    n = F.col("failing")
    return failing.select(F.inline(F.array(_row(check, n, n, n == 0))))


def _unique(df: DataFrame, check: Check) -> DataFrame:
    repeated = (
        df.where(F.col(check.column).isNotNull()).groupBy(check.column).count().where("count > 1")
    )
    return _counted(check, repeated.agg(F.count(F.lit(1)).alias("failing")))


def _relationships(tables: Mapping[str, DataFrame], check: Check) -> DataFrame:
    orphans = missing_in(
        tables[check.table], check.column, tables[check.parent], check.parent_column
    )
    return _counted(check, orphans.agg(F.coalesce(F.sum("row_count"), F.lit(0)).alias("failing")))


def anomaly_scores(
    series: DataFrame, value: str, order: str = "day", *, history: int = 14, limit: float = 3.0,
    least: int = 7,
) -> DataFrame:
    """Distance of each point from the ``history`` points before it, in deviations.

    The score is NULL with fewer than ``least`` earlier points and 0 while the
    past does not vary.  The series may be of any length, see ``trailing``.
    """
    v = F.col(value).cast("double")
    spread = F.col("past_stddev")
    score = (
        F.when(F.col("past_points") < least, None)
        .when(spread == 0, F.lit(0.0))
        .otherwise((v - F.col("past_mean")) / spread)
    )
    return (
        trailing(
            series,
            [order],
            history,
            {
                "past_points": lambda past: F.count(v).over(past),
                "past_mean": lambda past: F.avg(v).over(past),
                "past_stddev": lambda past: F.stddev_samp(v).over(past),
            },
        )
        .withColumn("score", score)
        .withColumn("anomalous", F.coalesce(F.abs(F.col("score")) > limit, F.lit(False)))
    )


def _anomalies(df: DataFrame, check: Check) -> DataFrame:
    scored = anomaly_scores(null_profile(df, check.column, check.timestamp), check.metric)
    return _counted(check, scored.agg(count_where(F.col("anomalous")).alias("failing")))


def run_checks(
    tables: Mapping[str, DataFrame], checks: Sequence[Check], as_of: datetime | str
) -> DataFrame:
    """One row per check; see ``RESULT_COLUMNS``."""
    frames = []
    for table in dict.fromkeys(c.table for c in checks):
        own = [c for c in checks if c.table == table]
        by_key = ("unique", "relationships", "column_anomalies")
        row_level = [c for c in own if c.kind not in by_key]
        if row_level:
            frames.append(_fused(tables[table], row_level, as_of))
        for check in own:
            if check.kind == "unique":
                frames.append(_unique(tables[table], check))
            elif check.kind == "relationships":
                frames.append(_relationships(tables, check))
            elif check.kind == "column_anomalies":
                frames.append(_anomalies(tables[table], check))
    return reduce(DataFrame.unionByName, frames)


class QualityError(RuntimeError):
    """A check of severity ``error`` failed."""


def gate(results: DataFrame) -> list:
    """Run the checks; raise if one of severity ``error`` failed, return the rows otherwise."""
    rows = results.collect()
    failed = [r for r in rows if not r.passed and r.severity == "error"]
    if failed:
        lines = ", ".join(
            f"{r.check_name}({r.table_name}.{r.column_name}): {r.failing_rows}" for r in failed
        )
        raise QualityError(f"{len(failed)} data checks failed: {lines}")
    return rows


def reconcile(flagged: DataFrame, fact: DataFrame, reason: str = "rejection_reason") -> DataFrame:
    """One row of layer counts: cleaned, accepted, rejected, fact and the gap to the fact.

    ``unresolved`` is the number of accepted rows that did not reach the fact.
    """
    silver = flagged.agg(
        F.count(F.lit(1)).alias("cleaned"),
        count_where(F.col(reason).isNull()).alias("accepted"),
        count_where(F.col(reason).isNotNull()).alias("rejected"),
    )
    in_fact = fact.agg(F.count(F.lit(1)).alias("n"))
    return silver.withColumn("in_fact", in_fact.scalar()).select(
        "*",
        (F.col("accepted") - F.col("in_fact")).alias("unresolved"),
        (F.col("cleaned") == F.col("accepted") + F.col("rejected")).alias("split_complete"),
        (F.col("in_fact") <= F.col("accepted")).alias("fact_within_accepted"),
    )
