from __future__ import annotations

import datetime as dt
import hashlib
import math

import pytest
from pyspark.sql import functions as F

from strataflow import functions as f
from strataflow.functions.keys import NULL_KEY


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize(
    "text, want", [("  Electric_Bike ", "electric_bike"), ("\tA", "\ta"), (None, None)]
)
def test_norm_lower_strips_spaces_only(spark, text, want):
    assert one(spark, f.norm_lower(F.lit(text))) == want


@pytest.mark.parametrize("text, want", [("", None), ("   ", None), (" a ", "a"), (None, None)])
def test_clean_string(spark, text, want):
    assert one(spark, f.clean_string(F.lit(text).cast("string"))) == want


def test_ieq(spark):
    assert one(spark, f.ieq(F.lit("CaSual"), "casual"))
    assert not one(spark, f.ieq(F.lit("CaSual"), "member"))


@pytest.mark.parametrize(
    "utc, local",
    [
        ("2024-01-15 12:00:00", dt.datetime(2024, 1, 15, 7)),
        ("2024-07-15 03:30:00", dt.datetime(2024, 7, 14, 23, 30)),
        # Autumn: two instants share one wall clock.
        ("2024-11-03 05:30:00", dt.datetime(2024, 11, 3, 1, 30)),
        ("2024-11-03 06:30:00", dt.datetime(2024, 11, 3, 1, 30)),
        # Spring: the hour from 2 to 3 does not exist.
        ("2024-03-10 06:59:00", dt.datetime(2024, 3, 10, 1, 59)),
        ("2024-03-10 07:00:00", dt.datetime(2024, 3, 10, 3, 0)),
    ],
)
def test_to_local(spark, utc, local):
    assert one(spark, f.to_local(F.lit(utc).cast("timestamp"))) == local


def minutes(spark, micros):
    start = F.lit("2024-11-03 05:30:00").cast("timestamp")
    end = F.timestamp_micros(F.unix_micros(start) + F.lit(micros))
    return one(spark, f.duration_minutes(start, end))


@pytest.mark.parametrize(
    "micros, want",
    [
        (0, 0.0),
        (200_000, 0.0),
        (299_980, 0.0),  # rounding twice would give 0.01
        (300_000, 0.01),
        (60_000_000, 1.0),
        (1439 * 60_000_000 + 59_400_000, 1439.99),
        (1440 * 60_000_000, 1440.0),
        (-90_000_000, -1.5),
    ],
)
def test_duration_edges(spark, micros, want):
    assert minutes(spark, micros) == want


def test_duration_across_daylight_saving_is_elapsed_time(spark):
    assert minutes(spark, 3600 * 1_000_000) == 60.0


def test_duration_of_open_ride_is_null(spark):
    end = F.lit(None).cast("timestamp")
    assert one(spark, f.duration_minutes(F.lit("2024-01-01").cast("timestamp"), end)) is None


@pytest.mark.parametrize("day", ["2021-01-01", "2020-12-31", "2024-02-29", "2023-06-04", "2022-12-01"])
def test_date_parts_match_the_calendar(spark, day):
    d = dt.date.fromisoformat(day)
    row = spark.range(1).select(*f.date_parts(F.lit(day).cast("date"))).first()
    iso = d.isocalendar()
    season = {12: "Winter", 1: "Winter", 2: "Winter", 6: "Summer", 3: "Spring"}[d.month]
    assert row.asDict() == {
        "date_key": int(d.strftime("%Y%m%d")),
        "year": d.year,
        "month": d.month,
        "day": d.day,
        "quarter": (d.month + 2) // 3,
        "week_of_year": iso.week,
        "day_of_week_num": iso.weekday,
        "day_name": d.strftime("%A"),
        "month_name": d.strftime("%B"),
        "is_weekend": int(iso.weekday >= 6),
        "season": season,
    }


def test_hour_bucket_stays_a_wall_clock(spark):
    c = f.hour_bucket(F.lit("2024-11-03 01:30:00").cast("timestamp_ntz"))
    assert one(spark, c) == dt.datetime(2024, 11, 3, 1)
    assert spark.range(1).select(c.alias("x")).schema["x"].dataType.simpleString() == "timestamp_ntz"


@pytest.mark.parametrize(
    "text, want",
    [
        ("2021-02-01 08:00:00", "2021-02-01 08:00:00"),
        ("2021-02-01 08:00:00.1234", "2021-02-01 08:00:00.123400"),
        ("2021-02-01T08:00:00Z", "2021-02-01 08:00:00"),
        ("2021-02-01 08:00:00+02:00", "2021-02-01 06:00:00"),
        ("2/1/2021 8:00", "2021-02-01 08:00:00"),
        ("2/1/2021 18:00:05", "2021-02-01 18:00:05"),
        ("2/1/2021 6:00 PM", "2021-02-01 18:00:00"),
        (" 2021-02-01 ", "2021-02-01 00:00:00"),
        ("soon", None),
        (None, None),
    ],
)
def test_parse_mixed_ts(spark, text, want):
    got = one(spark, f.parse_mixed_ts(F.lit(text).cast("string")).cast("timestamp_ntz"))
    assert got == (want and dt.datetime.fromisoformat(want))


def test_surrogate_key_marks_null(spark):
    key = one(spark, f.surrogate_key(F.lit("a"), F.lit(None).cast("string"), F.lit(3)))
    assert key == hashlib.md5(f"a-{NULL_KEY}-3".encode()).hexdigest()


def test_scd_id_differs_by_key_and_time(spark):
    def at(key, stamp):
        return one(spark, f.scd_id(F.lit(key), F.lit(stamp).cast("timestamp_ntz")))

    assert len({at(k, s) for k in "ab" for s in ("2024-01-01", "2024-01-02")}) == 4


def test_label_defaults(spark):
    names = {"member": "Member"}
    assert [one(spark, f.label(F.lit(v).cast("string"), names)) for v in ("member", "x", None)] == [
        "Member",
        "Unknown",
        "Unknown",
    ]


def test_require_fails_the_job(spark):
    with pytest.raises(Exception, match="k must not be NULL"):
        spark.range(1).select(f.require(F.lit(None).cast("string"), "k")).collect()


def km(spark, *points, **kw):
    return one(spark, f.geo_km(*[F.lit(p).cast("double") for p in points], **kw))


def test_geo_known_distances(spark):
    # One degree of latitude at 40 N and of longitude on the equator, WGS-84.
    assert km(spark, -74, 39.5, -74, 40.5) == pytest.approx(111.035, abs=0.01)
    assert km(spark, 0, 0, 1, 0) == pytest.approx(111.32, abs=0.01)
    # Far apart: the great circle.
    far = km(spark, -74.0, 40.7, 2.35, 48.86)
    assert far == km(spark, -74.0, 40.7, 2.35, 48.86, model="sphere")
    assert far == pytest.approx(5837, abs=5)


def test_geo_crosses_the_date_line(spark):
    assert km(spark, 179.9, 0, -179.9, 0) == pytest.approx(km(spark, -0.1, 0, 0.1, 0))


def test_geo_opposite_points_and_unknown_ends(spark):
    assert km(spark, 0, 0, 180, 0) == pytest.approx(math.pi * 6371.0)
    for model in ("ellipsoid", "sphere"):
        assert km(spark, -74, 40, None, None, model=model) is None
        assert km(spark, -74, 40, -74, 40, model=model) == 0


def test_cosine_distance(spark):
    def d(a, b):
        return one(spark, f.cosine_distance(F.lit(a), F.lit(b)))

    assert d([1.0, 0.0], [0.0, 2.0]) == pytest.approx(1)
    assert d([1.0, 2.0], [2.0, 4.0]) == pytest.approx(0)
    assert d([1.0, 0.0], [-3.0, 0.0]) == pytest.approx(2)
    assert d([0.0, 0.0], [1.0, 0.0]) is None


@pytest.mark.parametrize(
    "text, want",
    [
        ("Mar 4, 2022 08:05", "2022-03-04 08:05:00"), ("04-Mar-2022 08:05", "2022-03-04 08:05:00"),
        ("23/04/2022 10:00", "2022-04-23 10:00:00"), ("4/6/2022 11:00:00.250", "2022-04-06 11:00:00.250000"),
        ("202204", None), ("08:05", None), ("T08:05", None), ("2022", None), ("2022-04", None),
    ],
)
def test_layouts_need_a_full_date(spark, text, want):
    got = one(spark, f.parse_mixed_ts(F.lit(text)).cast("timestamp_ntz"))
    assert got == (want and dt.datetime.fromisoformat(want))


def test_exact_mean_keeps_small_decimals(spark):
    df = spark.createDataFrame([(0.004,), (0.004,), (1.234,), (None,)], "x double")
    assert df.agg(f.exact_mean("x").alias("m")).first().m == 0.414
    big = spark.createDataFrame([(1e30,), (3e30,)], "x double")
    assert big.agg(f.exact_mean("x").alias("m")).first().m == 2e30
