"""Row filters."""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REASON = "rejection_reason"


def accepted(df: DataFrame, reason: str = REASON) -> DataFrame:
    """Rows without a rejection reason; the reason column goes."""
    return df.where(F.col(reason).isNull()).drop(reason)


def rejected(df: DataFrame, reason: str = REASON) -> DataFrame:
    """Rows with a rejection reason."""
    return df.where(F.col(reason).isNotNull())


def both_present(df: DataFrame, *cols: str) -> DataFrame:
    """Rows in which none of the columns is NULL."""
    return df.where(reduce(and_, [F.col(c).isNotNull() for c in cols]))


def after_watermark(df: DataFrame, col: str, mark: Any) -> DataFrame:
    """Rows strictly past the mark; no mark means every row.

    The mark is a plain value, so the filter reaches the Parquet row groups.
    """
    return df if mark is None else df.where(F.col(col) > F.lit(mark))


def capped_by(df: DataFrame, col: str, bound: DataFrame) -> DataFrame:
    """Rows whose value does not pass the single value held by ``bound``."""
    return df.where(F.col(col) <= bound.scalar())
