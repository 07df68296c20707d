"""The checks of each layer."""

from __future__ import annotations

from strataflow.operators.quality import (
    Check,
    accepted_values,
    column_anomalies,
    freshness,
    invalid_count,
    missing_count,
    not_null,
    relationships,
    row_count,
    unique,
)

# The codes allowed.
BIKES = ("electric_bike", "classic_bike", "docked_bike")
RIDERS = ("member", "casual")
REASONS = (
    "non_positive_duration",
    "duration_exceeds_24h",
    "missing_start_lat",
    "missing_start_lng",
)


def _present(table: str, *columns: str) -> list[Check]:
    return [not_null(table, c) for c in columns]


def _key(table: str, column: str) -> list[Check]:
    return [not_null(table, column), unique(table, column)]


# Before silver is built.
LANDED_CHECKS = [
    row_count("trips"),
    *[missing_count("trips", c) for c in ("ride_id", "started_at", "ended_at")],
    invalid_count("trips", "member_casual", RIDERS),
    invalid_count("trips", "rideable_type", BIKES),
    freshness("trips", "started_at", 40),
]

BRONZE_CHECKS = [
    *_present("bronze_trips", "ride_id"),
    *_present("bronze_weather", "observation_time"),
]

SILVER_CHECKS = [
    *_key("int_trips_cleaned", "ride_id"),
    *_key("silver_trips", "ride_id"),
    *_present(
        "silver_trips",
        "rideable_type",
        "started_at",
        "ended_at",
        "ride_duration_minutes",
        "start_lat",
        "start_lng",
        "member_casual",
    ),
    accepted_values("silver_trips", "rideable_type", BIKES),
    accepted_values("silver_trips", "member_casual", RIDERS),
    column_anomalies("silver_trips", "ride_id", "started_at", "null_count"),
    column_anomalies("silver_trips", "ride_id", "started_at", "null_percent"),
    *_present("silver_trips_rejected", "ride_id", "rejection_reason"),
    accepted_values("silver_trips_rejected", "rejection_reason", REASONS),
    *_key("int_weather_cleaned", "observation_time"),
    *_key("silver_weather", "observation_time"),
]

GOLD_CHECKS = [
    *_key("dim_date", "date_key"),
    *_present("dim_date", "full_date"),
    *_key("dim_station", "station_key"),
    *_present("dim_station", "station_id"),
    *_key("dim_rider_type", "rider_type_key"),
    accepted_values("dim_rider_type", "rider_type", RIDERS),
    *_key("dim_bike_type", "bike_type_key"),
    accepted_values("dim_bike_type", "bike_type", BIKES),
    *_present(
        "fact_trips",
        "trip_key",
        "ride_id",
        "date_key",
        "start_station_key",
        "end_station_key",
        "rider_type_key",
        "bike_type_key",
    ),
    relationships("fact_trips", "date_key", "dim_date", "date_key"),
    relationships("fact_trips", "start_station_key", "dim_station", "station_key"),
    relationships("fact_trips", "end_station_key", "dim_station", "station_key"),
    relationships("fact_trips", "rider_type_key", "dim_rider_type", "rider_type_key"),
    relationships("fact_trips", "bike_type_key", "dim_bike_type", "bike_type_key"),
]
