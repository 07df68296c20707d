"""Bronze to silver: one cleaned, flagged table per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.functions import (
    clean_string,
    day_name,
    default_to,
    duration_minutes,
    first_match,
    local_date,
    local_hour,
    mean_coord,
    norm_lower,
    to_local,
)
from strataflow.functions.time import LOCAL_ZONE
from strataflow.operators.joins import lookup_left
from strataflow.operators.sets import single_valued, unpivot_pairs
from strataflow.operators.windows import first_per_key, keep_latest
from strataflow.session import stage

NAME_ID_LEGS = (
    ("start_station_name", "start_station_id"),
    ("end_station_name", "end_station_id"),
)
# Fixed value: from this many (rounded) minutes on, a ride is refused.
MAX_MINUTES = 1440


def deduplicate(bronze: DataFrame) -> DataFrame:
    """One row per ride: the one ingested last."""
    return keep_latest(bronze, ["ride_id"], ["_ingested_at", "_source_file"])


def clean_trips(trips: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Normalised text, local wall clocks and their parts, duration.

    Everything is computed in one projection over the raw columns, so the
    duration is that of the instants although the outputs reuse their names.
    """
    start, end = to_local("started_at", zone), to_local("ended_at", zone)
    return trips.select(
        "ride_id",
        norm_lower("rideable_type").alias("rideable_type"),
        start.alias("started_at"),
        end.alias("ended_at"),
        local_date(start).alias("start_date"),
        local_hour(start).alias("start_hour"),
        day_name(start).alias("day_of_week"),
        duration_minutes("started_at", "ended_at").alias("ride_duration_minutes"),
        *[clean_string(c).alias(c) for leg in NAME_ID_LEGS for c in leg],
        "start_lat",
        "start_lng",
        "end_lat",
        "end_lng",
        norm_lower("member_casual").alias("member_casual"),
        "_source_file",
        "_ingested_at",
    )


def name_id_pairs(
    cleaned: DataFrame, history: DataFrame | None = None, known: DataFrame | None = None
) -> DataFrame:
    """Station names and ids of both legs, from the batch and, if given, the target.

    The target is read as rides (``history``), or as the pairs counted when its
    rides were merged (``known``, see ``pair_counts``).
    """
    names = ("station_name", "station_id")
    pairs = unpivot_pairs(cleaned, NAME_ID_LEGS, names)
    if history is not None:
        pairs = pairs.unionByName(unpivot_pairs(history, NAME_ID_LEGS, names))
    if known is not None:
        pairs = pairs.unionByName(known.select(*names))
    return pairs


def pair_counts(trips: DataFrame) -> DataFrame:
    """Rides by station name and id, both legs, for each ``_part`` of ``trips``.

    NULLs are counted too, so that every part has a row.
    """
    legs = F.array(
        *[F.struct(F.col(n).alias("station_name"), F.col(i).alias("station_id")) for n, i in NAME_ID_LEGS]
    )
    pairs = trips.select("_part", F.inline(legs))
    return pairs.groupBy("_part", "station_name", "station_id").agg(F.count(F.lit(1)).alias("rides"))


def station_lookup(
    cleaned: DataFrame, history: DataFrame | None = None, known: DataFrame | None = None
) -> DataFrame:
    """Names seen with exactly one id."""
    return single_valued(
        name_id_pairs(cleaned, history, known), "station_name", "station_id", "resolved_station_id"
    )


def backfill(cleaned: DataFrame, lookup: DataFrame) -> DataFrame:
    """Fill missing station ids from unambiguous names."""
    out = cleaned
    for name, station_id in NAME_ID_LEGS:
        out = lookup_left(
            out, lookup, {name: "station_name"}, {"resolved_station_id": f"_found_{station_id}"}
        )
    filled = {i: default_to(i, F.col(f"_found_{i}")).alias(i) for _, i in NAME_ID_LEGS}
    return out.select(*[filled.get(c, F.col(c)) for c in cleaned.columns])


def rejection_reason() -> Column:
    """Why a ride is refused; the first rule that holds counts.

    A missing duration passes, as do missing end coordinates.
    """
    minutes = F.col("ride_duration_minutes")
    return first_match(
        [
            (minutes <= 0, "non_positive_duration"),
            (minutes >= MAX_MINUTES, "duration_exceeds_24h"),
            (F.col("start_lat").isNull(), "missing_start_lat"),
            (F.col("start_lng").isNull(), "missing_start_lng"),
        ]
    )


def flag(df: DataFrame) -> DataFrame:
    return df.withColumn("rejection_reason", rejection_reason())


def silver_trips(
    bronze: DataFrame,
    history: DataFrame | None = None,
    zone: str = LOCAL_ZONE,
    known: DataFrame | None = None,
) -> DataFrame:
    """Cleaned and flagged rides, valid or not.

    Station names of earlier rides come from ``history``, the rides, or from
    ``known``, their pairs of name and id.

    The cleaned batch feeds both the station lookup and the result, so it is
    written once; the lookup, one row per station name, is written too, which
    lets the planner broadcast it only if it is small.
    """
    cleaned = stage(clean_trips(deduplicate(bronze), zone), "cleaned")
    lookup = stage(station_lookup(cleaned, history, known), "station-lookup")
    return flag(backfill(cleaned, lookup))


def silver_weather(bronze: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """One observation per local hour, missing measures as zero.

    In the autumn hour that occurs twice, the row ingested last wins, then the
    later instant.
    """
    converted = bronze.select(
        F.col("observation_time").alias("_instant"),
        to_local("observation_time", zone).alias("observation_time"),
        default_to("temperature_c", 0.0).alias("temperature_c"),
        default_to("precipitation_mm", 0.0).alias("precipitation_mm"),
        default_to("wind_speed_kmh", 0.0).alias("wind_speed_kmh"),
        default_to("weather_code", 0).alias("weather_code"),
        default_to("is_daylight", False).alias("is_daylight"),
        "_ingested_at",
    )
    return keep_latest(converted, ["observation_time"], ["_ingested_at", "_instant"]).drop(
        "_instant"
    )


def station_current(silver: DataFrame) -> DataFrame:
    """Each station's name and mean position.

    Both legs are read in one pass and averaged by id and name; the
    alphabetically first name of an id wins, a start leg before an end leg.
    """
    legs = [
        ("start_station_id", "start_station_name", "start_lat", "start_lng"),
        ("end_station_id", "end_station_name", "end_lat", "end_lng"),
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("leg"),
                F.col(sid).alias("station_id"),
                F.col(name).alias("station_name"),
                F.col(lat).alias("latitude"),
                F.col(lng).alias("longitude"),
            )
            for i, (sid, name, lat, lng) in enumerate(legs)
        ]
    )
    means = (
        silver.select(F.inline(rows))
        .where(F.col("station_id").isNotNull())
        .groupBy("station_id", "station_name", "leg")
        .agg(
            mean_coord("latitude").alias("latitude"),
            mean_coord("longitude").alias("longitude"),
        )
    )
    order = [F.col("station_name").asc_nulls_last(), F.col("leg")]
    return first_per_key(means, ["station_id"], order).drop("leg")
