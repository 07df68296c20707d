"""Hourly weather payloads."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Payload fields, and the earliest day of history.
PAYLOAD = (
    "hourly struct<time: array<string>, temperature_2m: array<double>, "
    "precipitation: array<double>, windspeed_10m: array<double>, "
    "weathercode: array<int>, is_day: array<int>>"
)
FIRST_DAY = "2021-02-01"
LAG_DAYS = 5


def unpack_hourly(
    payloads: DataFrame, json: str = "json", keep: Sequence[str] = ()
) -> DataFrame:
    """One row per hour from payloads that hold parallel arrays.

    A payload without ``hourly`` gives no rows; a measure without an array is
    NULL.  Columns named in ``keep`` are carried along.
    """
    hourly = F.from_json(json, PAYLOAD)["hourly"]

    def series(name: str, kind: str) -> Column:
        return F.coalesce(hourly[name], F.array().cast(f"array<{kind}>")).alias(name)

    hours = F.arrays_zip(
        series("time", "string"),
        series("temperature_2m", "double"),
        series("precipitation", "double"),
        series("windspeed_10m", "double"),
        series("weathercode", "int"),
        series("is_day", "int"),
    )
    return (
        payloads.select(*keep, hours.alias("hours"))
        .select(*keep, F.inline("hours").alias("time", "temp", "rain", "wind", "code", "day"))
        .select(
            F.try_to_timestamp("time").alias("observation_time"),
            F.col("temp").alias("temperature_c"),
            F.col("rain").alias("precipitation_mm"),
            F.col("wind").alias("wind_speed_kmh"),
            F.col("code").alias("weather_code"),
            F.col("day").cast("boolean").alias("is_daylight"),
            *keep,
        )
    )


def refused_payloads(payloads: DataFrame, name: str, json: str = "json") -> DataFrame:
    """Payloads without readable hours: their name and a message."""
    hourly = F.from_json(json, PAYLOAD)["hourly"]
    message = (
        F.when(F.try_parse_json(json).isNull(), "no JSON")
        .when(hourly.isNull(), "no hourly values")
        .when(F.coalesce(F.size(hourly["time"]), F.lit(0)) <= 0, "no hours")
    )
    return payloads.select(name, message.alias("message")).where("message IS NOT NULL")


def missing_dates(
    target: DataFrame,
    as_of: date | str,
    *,
    ts: str = "observation_time",
    lag_days: int = LAG_DAYS,
    first_day: date | str = FIRST_DAY,
) -> DataFrame:
    """Days still to load: from the day after the newest row to ``as_of`` less the lag.

    An empty target starts at ``first_day``; an up-to-date one gives no rows.
    """
    start = F.coalesce(F.date_add(F.to_date(F.max(ts)), 1), F.lit(str(first_day)).cast("date"))
    end = F.date_sub(F.lit(str(as_of)).cast("date"), lag_days)
    return (
        target.agg(start.alias("start"))
        .where(F.col("start") <= end)
        .select(F.explode(F.sequence("start", end)).alias("day"))
    )
