"""Vector arithmetic on array columns, in double precision."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataflow.functions.text import as_col


def vector_literal(values: Sequence[float]) -> Column:
    return F.lit([float(v) for v in values])


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine_distance(a: Column | str, b: Column | str) -> Column:
    """1 minus the cosine of the angle; NULL for a zero vector or unequal lengths."""
    a, b = as_col(a), as_col(b)
    return 1 - F.try_divide(dot(a, b), norm(a) * norm(b))


def cosine_distance_to(a: Column | str, query: Sequence[float]) -> Column:
    """``cosine_distance`` to one given vector, whose length is worked out once."""
    a, length = as_col(a), math.sqrt(sum(float(v) ** 2 for v in query))
    return 1 - F.try_divide(dot(a, vector_literal(query)), norm(a) * F.lit(length))
