"""The test tables in the shapes the operators expect.

Plain arithmetic on every row, so that ``oracle`` can state the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BASE_STAMP = "2024-03-01 00:00:00"
# Event type to bike type, with the case and padding a raw file may have.
BIKE_OF_EVENT = {
    "view": "classic_bike",
    "click": " Classic_Bike ",
    "signup": "electric_bike",
    "purchase": "ELECTRIC_BIKE",
    "error": "docked_bike",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain(df: DataFrame) -> DataFrame:
    """Instants as UTC wall clocks, the form in which the tables hold them."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _station_id(n: Column) -> Column:
    event = F.col("event_id")
    suffix = F.when(n % 5 == 0, F.concat(F.lit("-"), (event % 2).cast("string"))).otherwise("")
    known = F.concat(F.lit("ID"), n.cast("string"), suffix)
    return F.when(event % 7 != 0, known).when(event % 2 == 0, F.lit(""))


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as raw trips: duplicates, blanks, bad durations and gaps included."""
    event, ts = F.col("event_id"), F.col("ts").cast("timestamp")
    start, end = F.col("user_id") % 40, event % 40
    seconds = F.round((F.col("value") * 5 - 20) * 60).cast("bigint")
    bike = F.lit(None).cast("string")
    for kind, name in BIKE_OF_EVENT.items():
        bike = F.when(F.col("event_type") == kind, name).otherwise(bike)
    base = F.unix_micros(F.lit(BASE_STAMP).cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        F.when(event % 10 == 9, event - 1).otherwise(event).cast("string").alias("ride_id"),
        bike.alias("rideable_type"),
        ts.alias("started_at"),
        F.timestamp_micros(F.unix_micros(ts) + seconds * 1_000_000).alias("ended_at"),
        F.concat(F.lit("S"), start.cast("string")).alias("start_station_name"),
        _station_id(start).alias("start_station_id"),
        F.concat(F.lit("S"), end.cast("string")).alias("end_station_name"),
        _station_id(end).alias("end_station_id"),
        F.when(event % 97 != 0, 40.70 + start / 1000.0).alias("start_lat"),
        (-74.0 - start / 1000.0).alias("start_lng"),
        F.when(event % 89 != 0, 40.70 + end / 1000.0).alias("end_lat"),
        F.when(event % 89 != 0, -74.0 - end / 1000.0).alias("end_lng"),
        F.when(F.col("user_id") % 2 == 1, " Member").otherwise("casual").alias("member_casual"),
        F.concat(F.lit("m"), (event % 4).cast("string")).alias("_source_file"),
        F.timestamp_micros(base + (event % 4) * 3_600_000_000).alias("_ingested_at"),
    )


def weather_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as hourly observations, many per hour and with gaps."""
    event, value = F.col("event_id"), F.col("value")
    hour = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    base = F.unix_micros(F.lit(BASE_STAMP).cast("timestamp"))
    return table(spark, sf_dir, "events").select(
        hour.alias("observation_time"),
        F.when(event % 3 != 0, value).alias("temperature_c"),
        F.when(event % 5 != 0, value / 10).alias("precipitation_mm"),
        F.when(event % 7 != 0, value / 4).alias("wind_speed_kmh"),
        F.when(event % 11 != 0, event % 100).cast("int").alias("weather_code"),
        F.when(event % 13 != 0, F.hour(hour).between(6, 18)).alias("is_daylight"),
        F.timestamp_micros(base + (event % 4) * 3_600_000_000).alias("_ingested_at"),
    )


def station_batches(silver: DataFrame) -> list[tuple[str, Column]]:
    """Snapshot times on the local clock, and which rides each one has seen."""
    stamps = ["2024-01-11 00:00:00", "2024-01-21 00:00:00", "2024-02-01 00:00:00"]
    return [(s, F.col("started_at") < F.lit(s).cast("timestamp_ntz")) for s in stamps]
