"""Silver to gold: a star schema."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions import (
    backdate_first,
    date_parts,
    geo_km,
    hour_bucket,
    is_current,
    label,
    require,
    surrogate_key,
)
from strataflow.operators.filters import both_present, capped_by
from strataflow.operators.joins import asof_left, asof_versions, lookup_left, lookup_on, star
from strataflow.operators.sets import date_spine, distinct_values

# First day of the calendar, codes and their display names.
CALENDAR_START = "2021-01-01"
RIDER_TYPES = {"member": "Member", "casual": "Casual"}
BIKE_TYPES = {
    "classic_bike": "Classic Bike",
    "electric_bike": "Electric Bike",
    "docked_bike": "Docked Bike",
}
SORT_KEYS = {
    "dim_date": ["full_date"],
    "dim_station": ["station_key"],
    "dim_rider_type": ["rider_type_key"],
    "dim_bike_type": ["bike_type_key"],
    "fact_trips": ["date_key", "start_station_key"],
}


def dim_date(
    facts: DataFrame, as_of: date | str, start: date | str = CALENDAR_START, col: str = "start_date"
) -> DataFrame:
    """Calendar from ``start`` up to the last day with data, today excluded."""
    days = date_spine(facts.sparkSession, start, as_of)
    capped = capped_by(days, "date_day", facts.agg(F.max(col)))
    key, *parts = date_parts("date_day")
    return capped.select(key, F.col("date_day").alias("full_date"), *parts)


def dim_station(history: DataFrame) -> DataFrame:
    """One row per station version; each station's first one starts in 1970."""
    return history.select(
        require("dbt_scd_id", "dbt_scd_id").alias("station_key"),
        "station_id",
        "station_name",
        "latitude",
        "longitude",
        backdate_first("dbt_valid_from", "station_id").alias("valid_from"),
        F.col("dbt_valid_to").alias("valid_to"),
        is_current("dbt_valid_to").alias("is_current"),
    )


def dim_label(df: DataFrame, col: str, name: str, names: Mapping[str, str]) -> DataFrame:
    """Dimension of the codes that occur: hashed key, code, display name."""
    return distinct_values(df, col).select(
        surrogate_key(col).alias(f"{name}_key"),
        F.col(col).alias(name),
        label(col, names).alias(f"{name}_desc"),
    )


def dim_rider_type(silver: DataFrame) -> DataFrame:
    return dim_label(silver, "member_casual", "rider_type", RIDER_TYPES)


def dim_bike_type(silver: DataFrame) -> DataFrame:
    return dim_label(silver, "rideable_type", "bike_type", BIKE_TYPES)


def distance_km(model: str = "ellipsoid") -> Column:
    return F.round(geo_km("start_lng", "start_lat", "end_lng", "end_lat", model), 2)


def fact_trips(
    silver: DataFrame,
    dates: DataFrame,
    stations: DataFrame,
    riders: DataFrame,
    bikes: DataFrame,
    weather: DataFrame,
    *,
    asof_strategy: str = "auto",
) -> DataFrame:
    """One row per ride with both stations known, resolved against the dimensions.

    Both stations are taken as of the start of the ride.  While the dimensions
    are small enough to broadcast, the rides are read once and never shuffled.
    """
    out = both_present(silver, "start_station_id", "end_station_id")
    versions = asof_versions(
        stations, "station_id", "valid_from", ["station_key"], unique=True, strategy=asof_strategy
    )
    for leg in ("start", "end"):
        out = asof_left(
            out,
            versions,
            {f"{leg}_station_id": "station_id"},
            "started_at",
            "valid_from",
            {"station_key": f"{leg}_station_key"},
            strategy=asof_strategy,
        )
    out = lookup_left(out, dates, {"start_date": "full_date"}, {"date_key": "date_key"})
    out = lookup_left(
        out, riders, {"member_casual": "rider_type"}, {"rider_type_key": "rider_type_key"}
    )
    out = lookup_left(
        out, bikes, {"rideable_type": "bike_type"}, {"bike_type_key": "bike_type_key"}
    )
    measures = ["temperature_c", "precipitation_mm", "wind_speed_kmh", "weather_code", "is_daylight"]
    out = lookup_on(
        out, weather, hour_bucket("started_at"), "observation_time", {c: c for c in measures}
    )
    return out.select(
        surrogate_key("ride_id").alias("trip_key"),
        "ride_id",
        "date_key",
        "start_station_key",
        "end_station_key",
        "rider_type_key",
        "bike_type_key",
        "started_at",
        "ended_at",
        "ride_duration_minutes",
        distance_km().alias("ride_distance_km"),
        "start_lat",
        "start_lng",
        "end_lat",
        "end_lng",
        *measures,
        "_source_file",
        "_ingested_at",
    )


def trip_star(
    fact: DataFrame, dates: DataFrame, stations: DataFrame, riders: DataFrame, bikes: DataFrame
) -> DataFrame:
    """The fact with all dimensions, for analysis; station columns are the start's."""
    return star(
        fact,
        [
            (dates, "date_key", "date_key"),
            (riders, "rider_type_key", "rider_type_key"),
            (bikes, "bike_type_key", "bike_type_key"),
            (stations, "start_station_key", "station_key"),
        ],
    )


TABLE_DOCS = {
    "dim_date": "One row per day of the calendar",
    "dim_station": "One row per version of a station's name",
    "dim_rider_type": "Kinds of riders",
    "dim_bike_type": "Kinds of bikes",
    "fact_trips": "One row per accepted ride, with the weather of the hour it began",
}
# Descriptions kept with the gold tables.
DOCS = {
    "dim_date": {
        "date_key": "Day as a YYYYMMDD integer",
        "full_date": "The day",
        "year": "Year of the day",
        "month": "Month, 1 to 12",
        "day": "Day of the month, 1 to 31",
        "quarter": "Quarter, 1 to 4",
        "week_of_year": "ISO week",
        "day_of_week_num": "ISO weekday, 1 is Monday",
        "day_name": "Weekday in English",
        "month_name": "Month in English",
        "is_weekend": "1 on Saturday and Sunday, else 0",
        "season": "Winter, Spring, Summer or Fall",
    },
    "dim_station": {
        "station_key": "One per station version",
        "station_id": "Id in the source; repeats once per version",
        "station_name": "Name of the station",
        "latitude": "Mean latitude",
        "longitude": "Mean longitude",
        "valid_from": "When this version came into force",
        "valid_to": "When it was replaced; empty while current",
        "is_current": "1 for the version in force, else 0",
    },
    "dim_rider_type": {
        "rider_type_key": "Hash key",
        "rider_type": "Code in the source",
        "rider_type_desc": "Display name",
    },
    "dim_bike_type": {
        "bike_type_key": "Hash key",
        "bike_type": "Code in the source",
        "bike_type_desc": "Display name",
    },
    "fact_trips": {
        "trip_key": "Hash key of the ride",
        "ride_id": "Id in the source",
        "date_key": "Day the ride began, in dim_date",
        "start_station_key": "Version of the start station in force when the ride began",
        "end_station_key": "Version of the end station in force when the ride began",
        "rider_type_key": "Rider type, in dim_rider_type",
        "bike_type_key": "Bike type, in dim_bike_type",
        "started_at": "Start, local wall clock",
        "ended_at": "End, local wall clock",
        "ride_duration_minutes": "Minutes, 2 decimals",
        "ride_distance_km": "Kilometres between the end points; empty if one is unknown",
        "start_lat": "Latitude of the start",
        "start_lng": "Longitude of the start",
        "end_lat": "Latitude of the end",
        "end_lng": "Longitude of the end",
        "temperature_c": "Temperature in the hour the ride began, Celsius",
        "precipitation_mm": "Precipitation in that hour, millimetres",
        "wind_speed_kmh": "Wind speed in that hour, km/h",
        "weather_code": "Weather code of that hour",
        "is_daylight": "Whether that hour was daylight",
        "_source_file": "Source file of the row",
        "_ingested_at": "When the row was ingested",
    },
}
