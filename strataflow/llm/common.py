"""Column helpers shared by the training-data operators."""

from __future__ import annotations

import os
import string
from collections.abc import Callable, Iterator
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strataflow.session import stage

#: A word is a run of anything but space and the controls tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column, pattern: str = WORD) -> Column:
    """The words of a text in order; no word for NULL."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.coalesce(found, F.array().cast("array<string>"))


def id_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def row_key(*columns: Column) -> Column:
    """A 128-bit name of a row's values, NULL told apart from every string."""
    parts = []
    for c in columns:
        text = c.cast("string")
        parts += [F.coalesce(F.octet_length(text).cast("string"), F.lit("-")), F.coalesce(text, F.lit(""))]
    return F.md5(F.concat_ws("\x1f", *parts))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spare_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def on_path(spark: SparkSession) -> None:
    """Put this package on the path of the Python workers.

    On a cluster the package is shipped with the job; where the workers see the
    driver's folders, they find it there even if it is not installed.
    """
    seen = spark.sparkContext.environment
    root = str(Path(__file__).resolve().parents[2])
    paths = [p for p in seen.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        seen["PYTHONPATH"] = os.pathsep.join([*paths, root])


def release_memory() -> None:
    """Give back what this Python worker has freed.

    Workers outlive their tasks, and beside later stages an idle one would keep
    what the allocators hold of the largest task it ever ran.
    """
    import ctypes
    import sys

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def releasing(step: Callable) -> Callable:
    """``step`` over batches; once it has ended and its variables are gone, their memory is given back."""

    def run(batches: Iterator) -> Iterator:
        yield from step(batches)
        release_memory()

    return run


def map_pandas(df: DataFrame, step: Callable, schema: str) -> DataFrame:
    """``mapInPandas`` with this package on the path of the Python workers."""
    on_path(df.sparkSession)
    return df.mapInPandas(step, schema)


def numbered(df: DataFrame, order: list, name: str) -> tuple[DataFrame, DataFrame]:
    """``df`` range-sorted by ``order`` and staged, with ``_part`` and ``_at``.

    ``_part`` numbers the ranges in order, ``_at`` the rows inside one.  No task
    holds more than a range.  The second frame names the ranges that have rows,
    with the number of rows before each: one row per range, not per key.
    """
    at = F.monotonically_increasing_id()
    sorted_rows = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_part", F.shiftright(at, 33))
        .withColumn("_at", at.bitwiseAND(F.lit((1 << 33) - 1)))
    )
    rows = stage(sorted_rows, name)
    return rows, rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))


def ranked_within(df: DataFrame, keys: list[str], order: list, name: str) -> DataFrame:
    """``df`` with ``_nth``, the place of a row, from 1, among the rows of its keys.

    Ranks come from a range sort of all rows, so a key that a third of them share
    is spread over tasks.
    """
    rows, _ = numbered(df, [*(F.asc_nulls_first(k) for k in keys), *order], name)
    # Rows of the keys in earlier ranges; a key is cut only where a range ends.
    held = rows.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_held"), F.min("_at").alias("_from"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = held.withColumn("_before", F.coalesce(F.sum("_held").over(earlier), F.lit(0)))
    same = [F.col(f"r.{k}").eqNullSafe(F.col(f"b.{k}")) for k in ["_part", *keys]]
    nth = F.col("_before") + F.col("_at") - F.col("_from") + 1
    return rows.alias("r").join(before.alias("b"), same).select(*(f"r.{c}" for c in df.columns), nth.alias("_nth"))


def one_each(df: DataFrame, keys: list[str], repeated: DataFrame) -> DataFrame:
    """``df`` with one row for each key of ``repeated``, and all other rows as they are.

    ``repeated`` holds only keys that occur more than once, so that the rows of
    unique keys are not shuffled for it.
    """
    if repeated.isEmpty():
        return df
    same = [F.col(f"d.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    d, r = df.alias("d"), repeated.select(*keys).alias("r")
    single = d.join(r, same, "left_anti")
    return single.unionByName(d.join(r, same, "left_semi").dropDuplicates(keys))
