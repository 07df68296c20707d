"""Unions, distinct values, bounds and generated rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.functions.logic import count_where


def date_spine(spark: SparkSession, start: date | str, end: date | str) -> DataFrame:
    """One row per day, start included, end excluded; none if the end is not later."""
    first, after = (F.lit(str(d)).cast("date") for d in (start, end))
    days = F.sequence(first, F.date_sub(after, 1))
    return spark.range(1).where(first < after).select(F.explode(days).alias("date_day"))


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """The values that occur, without NULL."""
    return df.select(col).where(F.col(col).isNotNull()).distinct()


def bounds(df: DataFrame, col: str) -> DataFrame:
    """One row: ``min_value`` and ``max_value``."""
    return df.agg(F.min(col).alias("min_value"), F.max(col).alias("max_value"))


def single_valued(pairs: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """Keys seen with exactly one value, and that value.

    The pairs are made distinct first: that is a hash aggregation without
    buffers, which shrinks billions of rows to the few pairs that exist before
    anything is shuffled.
    """
    distinct = pairs.where(F.col(key).isNotNull() & F.col(value).isNotNull()).distinct()
    return (
        distinct.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"), F.max(value).alias(out))
        .where("_n = 1")
        .drop("_n")
    )


def unpivot_pairs(df: DataFrame, legs: Sequence[Sequence[str]], names: Sequence[str]) -> DataFrame:
    """Union of column groups of one table, read in a single pass."""
    structs = [
        F.struct(*[F.col(c).alias(name) for c, name in zip(leg, names)]) for leg in legs
    ]
    return df.select(F.inline(F.array(*structs)))


def measure_by(df: DataFrame, dims: Sequence[str], **aggregates) -> DataFrame:
    """Named aggregates by dimension columns."""
    return df.groupBy(*dims).agg(*[agg.alias(name) for name, agg in aggregates.items()])


def null_profile(df: DataFrame, col: str, ts: str) -> DataFrame:
    """NULLs of a column by day: count and percentage."""
    return (
        df.groupBy(F.to_date(ts).alias("day"))
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            count_where(F.col(col).isNull()).alias("null_count"),
        )
        .withColumn("null_percent", F.col("null_count") * 100.0 / F.col("row_count"))
    )

