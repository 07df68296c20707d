"""Conditions, defaults and labels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strataflow.functions.text import as_col


def _value(v: Any) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def default_to(c: Column | str, *fallbacks: Any) -> Column:
    """First of the column and its fallbacks that is not NULL."""
    return F.coalesce(as_col(c), *[_value(v) for v in fallbacks])


def first_match(rules: Sequence[tuple[Column, str]]) -> Column:
    """Label of the first rule that holds, NULL when none does."""
    out = F.lit(None).cast("string")
    for condition, name in reversed(rules):
        out = F.when(condition, F.lit(name)).otherwise(out)
    return out


def label(c: Column | str, names: Mapping[str, str], default: str = "Unknown") -> Column:
    """Display name of a code."""
    c = as_col(c)
    known = first_match([(c == code, name) for code, name in names.items()])
    return F.coalesce(known, F.lit(default))


def is_current(valid_to: Column | str) -> Column:
    """1 while a version has no end, else 0."""
    return as_col(valid_to).isNull().cast("int")


def first_in_key(c: Column | str, *keys: str) -> Column:
    """Smallest value of the whole key."""
    return F.min(as_col(c)).over(Window.partitionBy(*keys))


def backdate_first(valid_from: Column | str, *keys: str) -> Column:
    """Start of validity, with each key's earliest one moved to 1970."""
    valid_from = as_col(valid_from)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.when(valid_from == first_in_key(valid_from, *keys), epoch).otherwise(valid_from)


def require(c: Column | str, name: str) -> Column:
    """The value itself; the job fails if it is NULL."""
    return F.coalesce(as_col(c), F.raise_error(F.lit(f"{name} must not be NULL")))


def mean_coord(c: Column | str, digits: int = 6) -> Column:
    """Average of a coordinate, rounded."""
    return F.round(F.avg(as_col(c)), digits)


def exact_mean(c: Column | str, digits: int = 6) -> Column:
    """Average, rounded half up to ``digits`` decimals.

    Values are added up as decimals with 15 places, so the result does not
    depend on the order in which tasks finish, as a sum of doubles would; one too
    large for that (10^22 and up) or not finite falls back to the plain average.
    """
    c = as_col(c)
    exact = c.try_cast("decimal(37,15)")
    mean = F.try_avg(exact).cast("double")
    whole = F.count(c) == F.count(exact)
    return F.round(F.when(whole & mean.isNotNull(), mean).otherwise(F.avg(c.cast("double"))), digits)


def count_where(condition: Column) -> Column:
    """Aggregate: number of rows for which the condition is true."""
    return F.count_if(condition)
