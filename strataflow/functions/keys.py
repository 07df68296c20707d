"""Hash keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataflow.functions.text import as_col

# Fixed value: stands in for NULL inside a surrogate key.
NULL_KEY = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: Column | str) -> Column:
    """md5 hex over the columns as text, joined with '-'."""
    parts = [F.coalesce(as_col(c).cast("string"), F.lit(NULL_KEY)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def scd_id(key: Column | str, as_of: Column | str) -> Column:
    """md5 hex that names one version: its key and the time it was captured."""
    stamp = F.date_format(as_col(as_of), "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.md5(F.concat_ws("|", F.coalesce(as_col(key).cast("string"), F.lit("")), stamp))
