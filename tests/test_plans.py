"""Physical plans of the operators that matter at scale."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strataflow.operators.filters import accepted, after_watermark
from strataflow.operators.incremental import incremental_scan
from strataflow.operators.joins import missing_in
from strataflow.operators.sets import single_valued
from strataflow.operators.vectors import nearest
from strataflow.plans import gold, silver
from strataflow.session import stage


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def layers(spark):
    ts = F.timestamp_seconds(F.lit(1704110400) + F.col("id") * 600)
    raw = spark.range(2000).select(
        F.col("id").cast("string").alias("ride_id"),
        F.lit("classic_bike").alias("rideable_type"),
        ts.alias("started_at"),
        F.timestamp_seconds(F.unix_seconds(ts) + 900).alias("ended_at"),
        *[
            expr
            for leg, n in (("start", 7), ("end", 5))
            for expr in (
                F.concat(F.lit("S"), F.col("id") % n).alias(f"{leg}_station_name"),
                F.concat(F.lit("ID"), F.col("id") % n).alias(f"{leg}_station_id"),
            )
        ],
        *[F.lit(40.0).alias(f"{leg}_{c}") for leg in ("start", "end") for c in ("lat", "lng")],
        F.lit("member").alias("member_casual"),
        F.lit("m").alias("_source_file"),
        F.lit("2024-02-01").cast("timestamp").alias("_ingested_at"),
    )
    flagged = stage(silver.silver_trips(stage(raw, "raw")), "flagged")
    return stage(raw, "raw"), flagged


def test_deduplication_limits_each_key_before_the_shuffle(layers):
    text = plan(silver.deduplicate(layers[0]))
    assert text.count("Exchange") == 1
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_backfill_does_not_shuffle_the_rides(layers):
    raw, _ = layers
    cleaned = stage(silver.clean_trips(raw), "cleaned")
    lookup = stage(silver.station_lookup(cleaned), "lookup")
    text = plan(silver.flag(silver.backfill(cleaned, lookup)))
    assert text.count("BroadcastHashJoin") == 2 and "hashpartitioning" not in text


def test_lookup_is_hash_aggregated_before_the_shuffle(layers):
    pairs = silver.name_id_pairs(layers[1])
    text = plan(single_valued(pairs, "station_name", "station_id", "id"))
    first = text.rindex("Exchange")
    assert "HashAggregate" in text[first:] and "SortAggregate" not in text[first:]


def test_fact_reads_the_rides_once_and_never_shuffles_them(spark, layers):
    trips = stage(accepted(layers[1]), "silver")
    history = silver.station_current(trips).select(
        "*",
        F.md5("station_id").alias("dbt_scd_id"),
        F.lit("2024-01-02").cast("timestamp_ntz").alias("dbt_updated_at"),
        F.lit("2024-01-02").cast("timestamp_ntz").alias("dbt_valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"),
    )
    dims = [
        stage(d, "dim")
        for d in (
            gold.dim_date(trips, "2024-03-01"),
            gold.dim_station(history),
            gold.dim_rider_type(trips),
            gold.dim_bike_type(trips),
        )
    ]
    hours = stage(
        spark.createDataFrame(
            [], "observation_time timestamp_ntz, temperature_c double, precipitation_mm double,"
            " wind_speed_kmh double, weather_code int, is_daylight boolean",
        ),
        "weather",
    )
    fact = gold.fact_trips(trips, *dims, hours)
    text = plan(fact)
    assert text.count("BroadcastHashJoin") == 6
    assert not any(word in text for word in ("SortMergeJoin", "Cartesian", "NestedLoop", "PythonUDF"))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "ride_id" in line)
    assert "IsNotNull(start_station_id)" in scan and "start_station_name" not in scan
    assert fact.count() == trips.count()


def test_accepted_and_watermark_reach_the_scan(layers):
    _, flagged = layers
    assert "PushedFilters: [IsNull(rejection_reason)]" in plan(accepted(flagged))
    assert "GreaterThan(_ingested_at" in plan(after_watermark(flagged, "_ingested_at", "2024-01-01"))


def test_incremental_scan_does_not_shuffle_the_source(layers):
    raw, flagged = layers
    text = plan(incremental_scan(raw, flagged))
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text


def test_references_are_counted_before_the_shuffle(layers):
    text = plan(missing_in(layers[1], "start_station_id", layers[1], "end_station_id"))
    assert "partial_count" in text[text.index("Exchange") :]


def test_nearest_is_a_bounded_top_k(spark):
    v = stage(spark.createDataFrame([(1, [1.0, 2.0])], "id int, embedding array<float>"), "v")
    text = plan(nearest(v, [1.0, 0.0], 3))
    assert "TakeOrderedAndProject(limit=3" in text and "Exchange" not in text
