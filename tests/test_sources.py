from __future__ import annotations

import datetime as dt
import zipfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.sources import files, manifest, schemas, weather
from strataflow.sources.tables import bronze_append, land_parquet, landed_sources, read_landed

HEADER = "ride_id,rideable_type,started_at,ended_at,start_station_name,end_station_name,member_casual\n"


def listing(*keys):
    body = "".join(f"<Contents><Key>{k}</Key></Contents>" for k in keys)
    return f'<?xml version="1.0"?><ListBucketResult xmlns="http://s3.amazonaws.com/doc/2006-03-01/">{body}</ListBucketResult>'


def discovered(spark, pages, start):
    df = spark.createDataFrame(list(enumerate(pages)), "page int, xml string")
    found = manifest.discover_sources(df, "AB", ".zip", start)
    return [r.key for r in found.orderBy("page", "pos").collect()]


def test_manifest_from_the_start_key_on(spark):
    page = listing("AB-01.zip", "XY-02.zip", "AB-03.zip", "AB-04.txt", "AB-02.zip")
    assert discovered(spark, [page], "AB-03.zip") == ["AB-03.zip", "AB-02.zip"]
    assert discovered(spark, [page, listing("AB-09.zip")], "AB-02.zip") == ["AB-02.zip", "AB-09.zip"]
    assert discovered(spark, [page], "AB-99.zip") == []
    assert discovered(spark, [page], "XY-02.zip") == []


def test_new_sources(spark):
    keys = spark.createDataFrame([("a",), ("b",)], "key string")
    assert [r.key for r in manifest.new_sources(keys, keys.where("key = 'a'")).collect()] == ["b"]
    assert manifest.new_sources(keys, None).count() == 2


def make_zip(folder: Path, name: str, **members: str) -> None:
    with zipfile.ZipFile(folder / name, "w") as z:
        for member, text in members.items():
            z.writestr(member, text)


@pytest.fixture
def archives(tmp_path):
    ok = HEADER + "r1,classic_bike,2021-02-01 08:00:00,2/1/2021 8:30,,NA,member\n"
    make_zip(tmp_path, "one.csv.zip", **{"__MACOSX/._one.csv": "junk", "dir/one.csv": ok})
    make_zip(tmp_path, "none.zip", **{"notes.txt": "no table"})
    late = HEADER + "r2,x,2021-02-01 08:00:00,2021-02-01 09:00:00,S,E,casual\nr3,x,soon,2021-02-01,S,E,casual\n"
    make_zip(tmp_path, "badtime.csv.zip", **{"badtime.csv": late})
    (tmp_path / "broken.zip").write_bytes(b"not a zip")
    make_zip(tmp_path, "empty.csv.zip", **{"empty.csv": HEADER})
    return tmp_path


def test_archives_one_bad_file_does_not_stop_the_others(spark, archives):
    raw = files.read_archives(spark, str(archives), schemas.TRIP_FILE)
    good, refused = files.split_refused(files.typed(raw, schemas.TRIP_FILE))
    rows = good.collect()
    assert [(r.ride_id, r._source_file, r._archive) for r in rows] == [("r1", "one.csv", "one.csv.zip")]
    assert rows[0].started_at == dt.datetime(2021, 2, 1, 8) and rows[0].ended_at == dt.datetime(2021, 2, 1, 8, 30)
    # Only the empty field is NULL; a column the file lacks is NULL too.
    assert (rows[0].start_station_name, rows[0].end_station_name, rows[0].start_lat) == (None, "NA", None)
    messages = {r._archive: r.message for r in refused.collect()}
    assert messages["none.zip"] == "no CSV in archive"
    assert messages["badtime.csv.zip"] == "unreadable started_at: soon"
    assert messages["broken.zip"].startswith("BadZipFile")
    assert set(messages) == {"none.zip", "badtime.csv.zip", "broken.zip"}


def test_archive_above_the_limit_is_streamed_by_its_path(spark, tmp_path):
    lines = "".join(f"r{i},b{i * 7919},2021-02-01,2021-02-02,S,E,member\n" for i in range(400))
    make_zip(tmp_path, "big one%20.zip", **{"big.csv": HEADER + lines})
    make_zip(tmp_path, "fine.zip", **{"fine.csv": HEADER + "r1,b,2021-02-01,2021-02-02,S,E,member\n"})
    make_zip(tmp_path, "big empty.zip", **{"notes.txt": "".join(chr(32 + i * 7919 % 90) for i in range(9000))})
    whole = (tmp_path / "big one%20.zip").read_bytes()
    (tmp_path / "bad_tail.zip").write_bytes(whole[:-30])
    (tmp_path / "bad_data.zip").write_bytes(whole[:200] + bytes(300) + whole[500:])
    limit = (tmp_path / "fine.zip").stat().st_size
    rows = files.typed(files.read_archives(spark, str(tmp_path), schemas.TRIP_FILE, limit), schemas.TRIP_FILE)
    good, refused = files.split_refused(rows)
    assert {r.ride_id for r in good.where("_archive = 'fine.zip'").collect()} == {"r1"}
    assert good.where("_archive like 'big one%'").count() == 400 and good.count() == 401
    found = {r._archive: r.message for r in refused.collect()}
    assert found.keys() == {"bad_tail.zip", "bad_data.zip", "big empty.zip"} and "no CSV" in found["big empty.zip"]


def test_large_archives_are_not_read_as_one_value(spark, tmp_path):
    make_zip(tmp_path, "x.zip", **{"x.csv": HEADER + "r1,b,2021-02-01,2021-02-02,S,E,member\n"})
    text = files.read_archives(spark, str(tmp_path), schemas.TRIP_FILE)._jdf.queryExecution().executedPlan().toString()
    assert any("length" in line and "content" not in line for line in text.splitlines() if "FileScan" in line)


def test_archive_is_read_in_chunks(spark, tmp_path):
    lines = "".join(f"r{i},b,2021-02-01,2021-02-02,S,E,member\n" for i in range(1000))
    make_zip(tmp_path, "big.zip", **{"big.csv": HEADER + lines})
    binary = spark.read.format("binaryFile").load(str(tmp_path))
    assert files.unpack_archives(binary, schemas.TRIP_FILE, chunk_rows=64).count() == 1000


def test_csv_null_rule(spark, tmp_path):
    names = ["plain", "", "NULL", "n/a", '" two ""words"", "', '""', '"over\ntwo lines"']
    lines = [f"k{n},2022-07-0{n + 1} 10:00:00,{name}" for n, name in enumerate(names)]
    (tmp_path / "x.csv").write_text("\n".join(["ride_id,started_at,start_station_name", *lines]) + "\n")
    rows = files.typed(files.read_csv_raw(spark, str(tmp_path), schemas.TRIP_FILE), schemas.TRIP_FILE)
    got = {r.ride_id: r.start_station_name for r in rows.collect()}
    want = ["plain", None, "NULL", "n/a", ' two "words", ', None, "over\ntwo lines"]
    assert got == {f"k{n}": w for n, w in enumerate(want)}
    assert {r._error for r in rows.collect()} == {None}
    stamped = files.stamp_lineage(rows, "2022-08-01 00:00:00").orderBy("ride_id").first()
    assert stamped._source_file == "x.csv" and stamped._ingested_at == dt.datetime(2022, 8, 1)
    assert stamped.started_at == dt.datetime(2022, 7, 1, 10) and stamped.ended_at is None


def test_csv_rows_of_another_length_are_marked(spark, tmp_path):
    (tmp_path / "y.csv").write_text("ride_id,started_at,end_lat\nok,2022-07-01,1.5\nlong,2022-07-01,1.5,x\nshort,2022-07-01\n")
    rows = files.typed(files.read_csv_raw(spark, str(tmp_path), schemas.TRIP_FILE), schemas.TRIP_FILE)
    got = {r.ride_id: r._error for r in rows.select("ride_id", "_error").collect()}
    assert got["ok"] is None and got["long"].startswith("wrong number") and got["short"].startswith("wrong number")
    assert files.refused_files(rows).first().bad_rows == 2


def trips(spark, *sources):
    return spark.createDataFrame([(s, i) for s in sources for i in range(3)], "_source_file string, n int")


def test_landing_twice_leaves_one_copy(spark, tmp_path):
    root = str(tmp_path / "landing")
    land_parquet(trips(spark, "a b.csv", "c.csv"), root)
    land_parquet(trips(spark, "c.csv"), root)
    assert files.read_parquet(spark, root).count() == 6
    assert {r[0] for r in landed_sources(spark, root).collect()} == {"a b.csv", "c.csv"}


def test_bronze_append_takes_new_files_only(spark, tmp_path):
    landing, bronze = str(tmp_path / "landing"), str(tmp_path / "bronze")
    land_parquet(trips(spark, "a", "b"), landing)
    first = bronze_append(spark, landing, bronze)
    assert {tuple(r) for r in first.collect()} == {("a", 3, True), ("b", 3, True)}
    land_parquet(trips(spark, "c"), landing)
    assert {tuple(r) for r in bronze_append(spark, landing, bronze).collect()} == {("c", 3, True)}
    assert bronze_append(spark, landing, bronze).count() == 0
    assert files.read_parquet(spark, bronze).count() == 9


def test_bronze_append_reports_the_unreadable_file(spark, tmp_path):
    landing, bronze = tmp_path / "landing", str(tmp_path / "bronze")
    land_parquet(trips(spark, "a"), str(landing))
    bad = landing / "_source_file=bad"
    bad.mkdir()
    (bad / "part-0.parquet").write_bytes(b"PAR1 but not really")
    empty = landing / "_source_file=empty"
    trips(spark, "x").drop("_source_file").limit(0).coalesce(1).write.parquet(str(empty))
    got = {r[0]: (r.row_count, r.loaded) for r in bronze_append(spark, str(landing), bronze).collect()}
    assert got == {"a": (3, True), "bad": (0, False), "empty": (0, True)}
    assert files.read_parquet(spark, bronze).count() == 3


def damaged(folder, name, rows, spark, where):
    """A source of two files, the one at ``where`` with damaged pages and a good footer."""
    path = folder / f"_source_file={name}"
    spark.range(rows).selectExpr("CAST(id AS INT) AS n").repartition(2).write.option("compression", "none").parquet(str(path))
    part = sorted(p for p in path.iterdir() if p.name.startswith("part-"))[where]
    body = bytearray(part.read_bytes())
    body[4:200] = b"\xff" * 196
    part.write_bytes(bytes(body))
    for crc in path.glob(".*.crc"):
        crc.unlink()


@pytest.mark.parametrize("where", [0, 1])
def test_bronze_append_writes_nothing_of_a_damaged_source(spark, tmp_path, where):
    landing, bronze = tmp_path / "landing", str(tmp_path / "bronze")
    landing.mkdir()
    damaged(landing, "a first", 4000, spark, where)
    land_parquet(trips(spark, "b", "001", "002"), str(landing))
    for _ in range(2):  # the second time only the damaged source is tried again
        got = {r[0]: (r.row_count, r.loaded) for r in bronze_append(spark, str(landing), bronze).collect()}
        assert got.pop("a first") == (0, False)
    assert got == {}
    assert {r[0] for r in landed_sources(spark, bronze).collect()} == {"b", "001", "002"}
    rows = read_landed(spark, bronze, trips(spark, "b").schema).groupBy("_source_file").count()
    assert {tuple(r) for r in rows.collect()} == {("b", 3), ("001", 3), ("002", 3)}


def test_bronze_append_with_nothing_readable(spark, tmp_path):
    bad = tmp_path / "landing" / "_source_file=only"
    bad.mkdir(parents=True)
    (bad / "part-0.parquet").write_bytes(b"PAR1")
    got = bronze_append(spark, str(tmp_path / "landing"), str(tmp_path / "bronze"))
    assert [tuple(r) for r in got.collect()] == [("only", 0, False)]


def test_partitioned_writes_make_few_files(spark, tmp_path):
    rows = spark.range(24_000, numPartitions=8).selectExpr("CAST(id % 24 AS STRING) AS _source_file", "id")
    land_parquet(rows, str(tmp_path / "landing"))
    assert len(list((tmp_path / "landing").glob("*/part-*"))) <= 48


def test_refused_payloads(spark):
    rows = [("a", '{"hourly": {"time": ["2024-01-01T00:00"]}}'), ("b", '{"hourly": {"time": ["2024'), ("c", "{}"), ("d", '{"hourly": {"time": []}}')]
    df = spark.createDataFrame(rows, "name string, json string")
    got = {tuple(r) for r in weather.refused_payloads(df, "name").collect()}
    assert got == {("b", "no JSON"), ("c", "no hourly values"), ("d", "no hours")}


def test_start_key(spark):
    page = spark.createDataFrame([("p", "<L><Key>a.zip</Key><Key>b.zip</Key></L>")], "page string, xml string")
    keys = manifest.parse_listing(page)
    assert manifest.slice_listing(keys, "", ".zip", "").count() == 2
    assert manifest.start_listed(keys, "b.zip") and manifest.start_listed(keys, "") and not manifest.start_listed(keys, "x")


def test_drop_null_keys(spark):
    df = spark.createDataFrame([(1, None), (None, 2), (1, 2)], "a int, b int")
    assert files.drop_null_keys(df, "a", "b").count() == 1


def hours(spark, text):
    return weather.unpack_hourly(spark.createDataFrame([(text,)], "json string")).collect()


def test_weather_payload(spark):
    got = hours(spark, '{"hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.5, null],'
                       ' "precipitation": [0.0, 0.1], "windspeed_10m": [3, 4], "weathercode": [1, 2], "is_day": [0, 1]}}')
    assert [tuple(r) for r in got] == [
        (dt.datetime(2024, 1, 1, 0), 1.5, 0.0, 3.0, 1, False),
        (dt.datetime(2024, 1, 1, 1), None, 0.1, 4.0, 2, True),
    ]


def test_weather_payload_gaps(spark):
    assert hours(spark, '{"error": true}') == []
    row = hours(spark, '{"hourly": {"time": ["2024-01-01T00:00"], "temperature_2m": [1]}}')[0]
    assert row.temperature_c == 1.0 and row.precipitation_mm is None and row.is_daylight is None


def test_missing_dates(spark):
    seen = spark.createDataFrame([(dt.datetime(2024, 1, 1, 23),)], "observation_time timestamp")

    def days(df, as_of):
        return [r.day.isoformat() for r in weather.missing_dates(df, as_of).collect()]

    assert days(seen, "2024-01-09") == ["2024-01-02", "2024-01-03", "2024-01-04"]
    assert days(seen, "2024-01-06") == []
    assert days(seen.limit(0), "2021-02-07") == ["2021-02-01", "2021-02-02"]


def test_contract(spark):
    contract = T.StructType([T.StructField("b", T.StringType(), False), T.StructField("a", T.DoubleType())])
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    got = schemas.read_contract(df, contract, enforce=True)
    assert [tuple(r) for r in got.collect()] == [("2", 1.0)]
    assert schemas.required_columns(contract) == ["b"]
    with pytest.raises(Exception, match="b must not be NULL"):
        schemas.read_contract(df.withColumn("b", F.lit(None).cast("int")), contract, enforce=True).collect()
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        schemas.read_contract(df.drop("b"), contract)
