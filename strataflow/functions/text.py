"""Text clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_lower(c: Column | str) -> Column:
    """Strip outer spaces (spaces only; tabs stay) and lower the case."""
    return F.lower(F.trim(as_col(c)))


def clean_string(c: Column | str) -> Column:
    """Strip outer spaces; a blank becomes NULL."""
    return F.nullif(F.trim(as_col(c)), F.lit(""))


def ieq(c: Column | str, value: str | Column) -> Column:
    """Equality that ignores case on both sides."""
    other = value if isinstance(value, Column) else F.lit(value)
    return F.lower(as_col(c)) == F.lower(other)
