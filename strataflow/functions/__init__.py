"""Column to column functions.  All are built-in expressions; none is a UDF."""

from strataflow.functions.geo import geo_km
from strataflow.functions.keys import scd_id, surrogate_key
from strataflow.functions.logic import (
    backdate_first,
    count_where,
    default_to,
    exact_mean,
    first_match,
    is_current,
    label,
    mean_coord,
    require,
)
from strataflow.functions.text import clean_string, ieq, norm_lower
from strataflow.functions.time import (
    date_key,
    date_parts,
    day_name,
    duration_minutes,
    hour_bucket,
    is_weekend,
    local_date,
    local_hour,
    month_name,
    parse_mixed_ts,
    season,
    to_local,
)
from strataflow.functions.vector import cosine_distance

__all__ = [
    "backdate_first",
    "clean_string",
    "cosine_distance",
    "count_where",
    "date_key",
    "date_parts",
    "day_name",
    "default_to",
    "duration_minutes",
    "exact_mean",
    "first_match",
    "geo_km",
    "hour_bucket",
    "ieq",
    "is_current",
    "is_weekend",
    "label",
    "local_date",
    "local_hour",
    "mean_coord",
    "month_name",
    "norm_lower",
    "parse_mixed_ts",
    "require",
    "scd_id",
    "season",
    "surrogate_key",
    "to_local",
]
