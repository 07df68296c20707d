"""Incremental scans and merges on plain Parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.operators.filters import after_watermark
from strataflow.operators.windows import keep_latest
from strataflow.session import stage


def scalar_max(df: DataFrame, col: str):
    """Largest value of a column, as a Python value; None on an empty table."""
    return df.agg(F.max(col)).first()[0]


def new_keys(known: DataFrame | None, seen: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``seen`` that ``known`` lacks; no known table means all."""
    keys = seen.select(key).distinct()
    return keys if known is None else keys.join(known.select(key).distinct(), key, "left_anti")


def incremental_scan(
    source: DataFrame,
    target: DataFrame | None,
    *,
    mode: str = "source",
    source_col: str = "_source_file",
    stamp_col: str = "_ingested_at",
) -> DataFrame:
    """Rows of the source that the target has not taken in yet.

    ``source`` compares source files, so a file that is loaded late is still
    taken in.  ``watermark`` takes rows stamped strictly after the newest row
    of the target, and so skips such a file.  Without a target, or with an
    empty one, every row is returned.
    """
    if target is None:
        return source
    if mode == "watermark":
        return after_watermark(source, stamp_col, scalar_max(target, stamp_col))
    if mode == "source":
        # One row per source file: written, so that the planner sees how small it
        # is and does not shuffle the source by file.
        done = stage(target.select(source_col).distinct(), "sources-done")
        return source.join(done, source_col, "left_anti").select(source.columns)
    raise ValueError(f"unknown incremental mode: {mode}")


def merge_upsert(
    target: DataFrame | None, updates: DataFrame, keys: Sequence[str], newest: Sequence[str] = ()
) -> DataFrame:
    """Target with matching rows replaced by the updates and the others added.

    ``updates`` must hold each key once.  With ``newest``, a target row that is
    later by those columns stays, so a file that comes late does not undo a
    newer one; ties are settled as in ``keep_latest``.
    """
    if target is None:
        return updates
    names = updates.select(*keys)
    kept = target.join(names, list(keys), "left_anti").select(updates.columns)
    if newest:
        matching = target.join(names, list(keys), "left_semi").select(updates.columns)
        updates = keep_latest(matching.unionByName(updates), keys, newest)
    return kept.unionByName(updates)


def touched_partitions(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], partition: str
) -> DataFrame:
    """Partitions a merge must rewrite: those that hold a matching key or get a row."""
    holding = target.select(*keys, partition).join(updates.select(*keys), list(keys), "left_semi")
    return holding.select(partition).unionByName(updates.select(partition)).distinct()
