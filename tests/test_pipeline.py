"""The whole run on small archives, month by month."""

from __future__ import annotations

import datetime as dt
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from strataflow.operators.quality import QualityError
from strataflow.operators.windows import keep_latest
from strataflow.plans import pipeline, silver
from strataflow.session import new_path
from strataflow.sources.tables import TableStore
from strataflow.streaming.bronze import stream_bronze

COLUMNS = (
    "ride_id,rideable_type,started_at,ended_at,start_station_name,start_station_id,end_station_name,"
    "end_station_id,start_lat,start_lng,end_lat,end_lng,member_casual"
)
JANUARY = """
r1,classic_bike,2024-01-05 12:00:00,2024-01-05 12:30:00,Oak,S1,Elm,S2,40.70,-74.00,40.71,-74.01,member
r2,electric_bike,1/6/2024 12:00,1/6/2024 12:10,Elm,,Oak,S1,40.71,-74.01,,,casual
r3,docked_bike,2024-01-07 12:00:00,2024-01-07 12:00:00,Oak,S1,Elm,S2,40.70,-74.00,40.71,-74.01,member
r4,classic_bike,2024-01-08 12:00:00,2024-01-09 12:00:00,Oak,S1,Elm,S2,40.70,-74.00,40.71,-74.01,member
r5,classic_bike,2024-01-08 12:00:00,2024-01-08 12:05:00,Oak,S1,Elm,S2,,-74.00,40.71,-74.01,member
r6,classic_bike,2024-01-10 04:30:00,2024-01-10 05:00:00,Nowhere,,Elm,S2,40.70,-74.00,40.71,-74.01,casual
"""
FEBRUARY = """
r1,classic_bike,2024-01-05 12:00:00,2024-01-05 12:45:00,Oak,S1,Elm,S2,40.70,-74.00,40.71,-74.01,member
r7,classic_bike,2024-02-03 12:00:00,2024-02-03 12:20:00,Oak,,Fir,S3,40.70,-74.00,40.72,-74.02,member
"""


def archive(folder, name, body):
    folder.mkdir(exist_ok=True)
    with zipfile.ZipFile(folder / f"{name}.csv.zip", "w") as z:
        z.writestr(f"{name}.csv", COLUMNS + body)


def payload(folder, name, day):
    folder.mkdir(exist_ok=True)
    times = [f"{day}T{h:02d}:00" for h in range(24)]
    hourly = {
        "time": times,
        "temperature_2m": [float(h) for h in range(24)],
        "precipitation": [None] * 24,
        "windspeed_10m": [2.0] * 24,
        "weathercode": list(range(24)),
        "is_day": [1] * 24,
    }
    (folder / name).write_text(json.dumps({"hourly": hourly}))


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("pipeline")
    keys = ["2023-12", "2024-01", "broken", "2024-02"]
    listing = "".join(f"<Key>{k}.csv.zip</Key>" for k in keys)
    (base / "listing.xml").write_text(f"<ListBucketResult>{listing}</ListBucketResult>")
    cfg = pipeline.Config(
        str(base / "zips"),
        str(base / "weather"),
        str(base / "lake"),
        listing=str(base / "listing.xml"),
        start_from="2024-01.csv.zip",
    )
    archive(base / "zips", "2023-12", JANUARY.replace("2024-01", "2023-12"))  # before the start
    archive(base / "zips", "2024-01", JANUARY)
    (base / "zips" / "broken.csv.zip").write_bytes(b"junk")
    payload(base / "weather", "w1.json", "2024-01-05")
    store = TableStore(spark, f"{cfg.root}/tables")

    def snapshot():
        names = ("int_trips_cleaned", "fact_trips", "dim_station", "dim_date", "silver_weather")
        return {n: [tuple(r) for r in store.read(n).collect()] for n in names}

    reports, tables = [], []
    reports.append(pipeline.run(spark, cfg, "2024-02-02 00:00:00", "2024-02-01 19:00:00"))
    tables.append(snapshot())
    archive(base / "zips", "2024-02", FEBRUARY)
    payload(base / "weather", "w2.json", "2024-02-03")
    for _ in range(2):  # the second time there is nothing new
        reports.append(pipeline.run(spark, cfg, "2024-03-02 00:00:00", "2024-03-01 19:00:00"))
        tables.append(snapshot())
    return store, cfg, reports, tables


def by_ride(store, table):
    return {r.ride_id: r for r in store.read(table).collect()}


def test_flags(runs):
    flagged = by_ride(runs[0], "int_trips_cleaned")
    assert {k: r.rejection_reason for k, r in flagged.items()} == {
        "r1": None,
        "r2": None,
        "r3": "non_positive_duration",
        "r4": "duration_exceeds_24h",
        "r5": "missing_start_lat",
        "r6": None,
        "r7": None,
    }
    assert flagged["r1"].ride_duration_minutes == 45.0  # replaced by the later file
    assert flagged["r2"].start_station_id == "S2" and flagged["r2"].rideable_type == "electric_bike"
    assert flagged["r7"].start_station_id == "S1"  # known from the month before
    assert flagged["r6"].start_station_id is None
    assert flagged["r6"].start_date == dt.date(2024, 1, 9) and flagged["r6"].start_hour == 23


def test_fact(runs):
    fact = by_ride(runs[0], "fact_trips")
    assert set(fact) == {"r1", "r2", "r7"}
    assert fact["r1"].date_key == 20240105 and fact["r1"].started_at == dt.datetime(2024, 1, 5, 7)
    assert fact["r1"].temperature_c == 12.0 and fact["r1"].precipitation_mm == 0.0
    assert fact["r2"].temperature_c is None and fact["r2"].ride_distance_km is None
    assert fact["r1"].ride_distance_km == pytest.approx(1.40, abs=0.001)
    assert all(r.start_station_key and r.end_station_key for r in fact.values())


def test_stations(runs):
    stations = {r.station_id: r for r in runs[0].read("dim_station").collect()}
    assert set(stations) == {"S1", "S2", "S3"}
    assert stations["S3"].valid_from == dt.datetime(1970, 1, 1) and stations["S3"].is_current == 1


def test_second_run_changes_nothing(runs):
    _, _, reports, tables = runs
    assert tables[2] == tables[1] != tables[0]
    assert reports[2].loaded.count() == 0


def test_reports(runs):
    reports = runs[2]
    assert [r._archive for r in reports[0].refused.collect()] == ["broken.csv.zip"]
    assert [tuple(r) for r in reports[1].loaded.collect()] == [("2024-02.csv.zip", 2, True)]
    assert all(r.passed for r in reports[0].results if r.severity == "error")
    row = reports[1].layers.first()
    assert (row.cleaned, row.accepted, row.rejected, row.in_fact, row.unresolved) == (7, 4, 3, 3, 1)
    assert row.split_complete and row.fact_within_accepted


def test_refresh_revisits_every_ride(spark, runs):
    store, cfg, _, tables = runs
    bronze = pipeline.bronze_tables(spark, cfg)
    other = TableStore(spark, new_path(spark, "refresh"))
    pipeline.build_silver(other, cfg, bronze, refresh=True)
    assert sorted(map(str, other.read("int_trips_cleaned").collect())) == sorted(
        map(str, store.read("int_trips_cleaned").collect())
    )
    assert other.read("silver_sources").count() == 2 and tables


def test_gold_is_documented(runs):
    schema = runs[0].read("fact_trips").schema
    assert all(f.metadata.get("comment") for f in schema.fields)


def test_gate_stops_the_run_before_silver(spark, tmp_path):
    archive(tmp_path / "zips", "2024-01", JANUARY)
    payload(tmp_path / "weather", "w.json", "2024-01-05")
    cfg = pipeline.Config(str(tmp_path / "zips"), str(tmp_path / "weather"), str(tmp_path / "lake"))
    with pytest.raises(QualityError, match="freshness"):
        pipeline.run(spark, cfg, "2025-01-01 00:00:00", "2024-12-31 19:00:00")
    assert not TableStore(spark, f"{cfg.root}/tables").exists("int_trips_cleaned")


def test_run_without_weather_or_with_nothing(spark, tmp_path):
    cfg = pipeline.Config(str(tmp_path / "zips"), str(tmp_path / "weather"), str(tmp_path / "lake"))
    with pytest.raises(QualityError, match="row_count"):
        pipeline.run(spark, cfg, "2024-02-02 00:00:00", "2024-02-01 19:00:00")
    archive(tmp_path / "zips", "2024-01", JANUARY)
    pipeline.run(spark, cfg, "2024-02-02 00:00:00", "2024-02-01 19:00:00")
    fact = TableStore(spark, f"{cfg.root}/tables").read("fact_trips")
    assert fact.count() == 2 and fact.where("temperature_c IS NOT NULL").isEmpty()


def test_reissued_archives_and_same_instant_payloads(spark, tmp_path):
    zips, lake = tmp_path / "zips", str(tmp_path / "lake")
    cfg = pipeline.Config(str(zips), str(tmp_path / "weather"), lake)
    archive(zips, "2024-01", JANUARY)
    archive(zips, "empty", "\n")
    payload(tmp_path / "weather", "w1.json", "2024-01-05")
    pipeline.run(spark, cfg, "2024-02-02 00:00:00", "2024-02-01 19:00:00")
    with zipfile.ZipFile(zips / "2024-01-reissue.csv.zip", "w") as z:
        z.writestr("2024-01.csv", COLUMNS + FEBRUARY.replace("r7", "r9").replace("2024-02-03", "2024-01-30"))
    payload(tmp_path / "weather", "w2.json", "2024-01-06")
    (tmp_path / "weather" / "cut.json").write_text('{"hourly": {"time": ["2024')
    report = pipeline.run(spark, cfg, "2024-02-02 00:00:00", "2024-02-01 19:00:00")
    store = TableStore(spark, f"{lake}/tables")
    rides = by_ride(store, "int_trips_cleaned")
    assert rides["r1"].ride_duration_minutes == 45.0 and "r9" in rides
    assert store.read("silver_weather").count() == 48
    assert [tuple(r) for r in report.refused_payloads.collect()] == [("cut.json", "no JSON")]
    assert {r[0] for r in report.loaded.collect()} == {"2024-01-reissue.csv.zip"}
    cfg.keep_versions = 1
    pipeline.run(spark, cfg, "2024-02-02 00:00:00", "2024-02-01 19:00:00")
    assert len(store._versions("fact_trips")) == 1


def weather_row(hour, stamp, temperature, minute_utc="2024-11-03"):
    return (dt.datetime.fromisoformat(f"{minute_utc} {hour}"), temperature, None, None, None, None, dt.datetime.fromisoformat(stamp))


def test_weather_in_the_repeated_hour(spark):
    schema = (
        "observation_time timestamp, temperature_c double, precipitation_mm double, wind_speed_kmh double, "
        "weather_code int, is_daylight boolean, _ingested_at timestamp"
    )
    rows = [
        weather_row("05:00:00", "2024-12-01", 1.0),
        weather_row("06:00:00", "2024-12-01", 2.0),  # same local hour, later instant
        weather_row("07:00:00", "2024-12-01", 3.0),
        weather_row("07:00:00", "2024-12-02", None),  # ingested later
    ]
    got = silver.silver_weather(spark.createDataFrame(rows, schema)).orderBy("observation_time").collect()
    assert [(r.observation_time.hour, r.temperature_c, r.weather_code, r.is_daylight) for r in got] == [
        (1, 2.0, 0, False),
        (2, 0.0, 0, False),
    ]


def test_name_that_becomes_ambiguous_later(spark):
    schema = "start_station_name string, start_station_id string, end_station_name string, end_station_id string"
    first = spark.createDataFrame([("Oak", "S1", "Oak", None)], schema)
    second = spark.createDataFrame([("Oak", "S9", "Oak", None)], schema)

    def filled(batch, history):
        lookup = silver.station_lookup(batch, history)
        return [r.end_station_id for r in silver.backfill(batch, lookup).collect()]

    # The first batch is filled and never revisited; the second is not.
    assert filled(first, None) == ["S1"]
    assert filled(second, first) == [None]
    assert filled(first.unionByName(second), None) == [None, None]


def test_stream_takes_each_file_once(spark):
    root = new_path(spark, "stream-test")
    store = TableStore(spark, f"{root}/tables")
    schema = "k string, v int, stamp int"

    def land(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{root}/in")

    def run():
        q = stream_bronze(spark, f"{root}/in", store, "t", spark.createDataFrame([], schema).schema,
                          ["k"], ["stamp"], f"{root}/checkpoint")
        q.awaitTermination()
        return sorted(tuple(r) for r in store.read("t").collect()), len(store._versions("t"))

    land(("a", 1, 1), ("a", 2, 2), ("b", 1, 1))
    assert run() == ([("a", 2, 2), ("b", 1, 1)], 1)
    land(("b", 5, 3), ("a", 0, 1))  # the older row of a comes late
    assert run() == ([("a", 2, 2), ("b", 5, 3)], 2)
    assert run() == ([("a", 2, 2), ("b", 5, 3)], 2)


def test_group_limit_survives_in_silver(spark):
    df = spark.range(10).select(F.lit("r").alias("ride_id"), F.col("id").alias("n"))
    assert keep_latest(df, ["ride_id"], ["n"]).first().n == 9
