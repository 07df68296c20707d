"""Slowly changing dimension, type 2, as a function of history and current state."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions.keys import scd_id

VERSION_COLUMNS = ("dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to")


def _opened(current: DataFrame, key: str, now: Column) -> DataFrame:
    return current.select(
        *current.columns,
        scd_id(key, now).alias("dbt_scd_id"),
        now.alias("dbt_updated_at"),
        now.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"),
    )


def _met(
    open_versions: DataFrame,
    current: DataFrame,
    key: str,
    check_cols: Sequence[str],
    now: Column,
    invalidate_hard_deletes: bool,
    unchanged: bool,
) -> DataFrame:
    """What becomes of the open versions and the current state; without ``unchanged`` only what changes."""
    columns = [*current.columns, *VERSION_COLUMNS]
    old = open_versions.select(F.struct(*columns).alias("old"))
    new = _opened(current, key, now).select(F.struct(*columns).alias("new"))
    pairs = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full")

    closed = F.struct(
        *[
            now.alias(c) if c == "dbt_valid_to" else F.col(f"old.{c}").alias(c)
            for c in columns
        ]
    )
    same = F.lit(True)
    for c in check_cols:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    as_it_was = F.array(F.col("old")) if unchanged else F.slice(F.array(F.col("old")), 1, 0)
    outcome = (
        F.when(F.col("old").isNull(), F.array(F.col("new")))
        .when(F.col("new").isNull(), F.array(closed) if invalidate_hard_deletes else as_it_was)
        .when(same, as_it_was)
        .otherwise(F.array(closed, F.col("new")))
    )
    return pairs.select(F.inline(outcome)).select(columns)


def scd2_changes(
    history: DataFrame,
    current: DataFrame,
    key: str,
    check_cols: Sequence[str],
    as_of: datetime | str,
    *,
    invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """The versions that a snapshot taken after all of ``history`` opens or closes, and no others.

    A version that is closed appears whole, with the identity it was opened under.
    """
    now = F.lit(str(as_of)).cast("timestamp_ntz")
    open_versions = history.where(F.col("dbt_valid_to").isNull())
    return _met(open_versions, current, key, check_cols, now, invalidate_hard_deletes, False)


def scd2_apply(
    history: DataFrame | None,
    current: DataFrame,
    key: str,
    check_cols: Sequence[str],
    as_of: datetime | str,
    *,
    invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """History after one snapshot of the current state taken at ``as_of``.

    A new key opens a version.  A key whose ``check_cols`` differ (NULL-safe)
    closes its open version and opens another.  An unchanged key keeps its
    version as it is, other columns included.  A key that is gone has its open
    version closed; if it returns it opens a new one.  ``current`` must hold
    each key once; ``as_of`` is on the clock the facts are compared on.  A
    snapshot as of the time of the newest change replaces that snapshot; an
    earlier one is refused.
    """
    now = F.lit(str(as_of)).cast("timestamp_ntz")
    columns = [*current.columns, *VERSION_COLUMNS]
    if history is None:
        return _opened(current, key, now)

    history = history.select(columns)
    changed = F.max(F.greatest("dbt_updated_at", "dbt_valid_from", "dbt_valid_to"))
    later, same = history.agg(changed.alias("last")).select(F.col("last") > now, F.col("last") == now).first()
    if later:
        raise ValueError(f"the history has changes after {as_of}")
    if same:  # that snapshot again: what it changed is undone first
        reopened = F.nullif(F.col("dbt_valid_to"), now)
        history = history.where(F.col("dbt_valid_from") < now).withColumn("dbt_valid_to", reopened)
    is_open = F.col("dbt_valid_to").isNull()
    live = _met(history.where(is_open), current, key, check_cols, now, invalidate_hard_deletes, True)
    return history.where(~is_open).unionByName(live)
