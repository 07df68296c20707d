"""One row per key.

Spark turns ``row_number() = 1`` into a group limit on both sides of the
shuffle, so each map task sends at most one row per key: a key that holds a
third of all rows costs no more to shuffle than any other.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strataflow.session import stage


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def keep_latest(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """The latest row of each key.

    Ties on ``newest`` are settled by the other columns, largest value first,
    so that every run picks the same row.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest]
    return first_per_key(df, keys, [F.col(c).desc_nulls_last() for c in [*newest, *rest]])


def trailing(
    series: DataFrame, order: Sequence[str], rows: int, aggregates: Mapping[str, Callable], block: int = 100_000
) -> DataFrame:
    """``series`` with aggregates over the ``rows`` rows before each row.

    ``aggregates`` names functions from a window to a column.  The series is
    sorted by range and numbered, then cut into blocks of ``block`` rows; each
    block is opened by the last ``rows`` rows of the one before, which are
    dropped again.  No task holds more than a range or a few blocks, however
    long the series is; a block is never shorter than ``rows``.  Ties are settled
    by the remaining columns.
    """
    block = max(block, rows)
    keys = [*order, *[c for c in series.columns if c not in order]]
    at = F.monotonically_increasing_id()
    ranged = stage(
        series.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_part", F.shiftright(at, 33))
        .withColumn("_at", at.bitwiseAND(F.lit((1 << 33) - 1))),
        "ranged",
    )
    # One row per range, so its running sum is small whatever the series is.
    earlier = Window.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    starts = starts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    row = F.col("_start") + F.col("_at")
    own = F.floor(row / F.lit(block))
    into = F.when(row % block >= block - rows, F.array(own, own + 1)).otherwise(F.array(own))
    dealt = ranged.join(starts, "_part").select(
        *series.columns, row.alias("_row"), own.alias("_own"), F.explode(into).alias("_block")
    )
    past = Window.partitionBy("_block").orderBy("_row").rowsBetween(-rows, -1)
    measured = dealt.withColumns({name: f(past) for name, f in aggregates.items()})
    return measured.where("_own = _block").drop("_row", "_own", "_block")
