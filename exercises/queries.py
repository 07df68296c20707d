"""Every operator as a query over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from exercises.adapters import BASE_STAMP, plain, station_batches, table, trips_raw, weather_raw
from strataflow.functions import (
    exact_mean,
    geo_km,
    hour_bucket,
    ieq,
    label,
    parse_mixed_ts,
    surrogate_key,
)
from strataflow.functions.vector import cosine_distance
from strataflow.operators import analyst, quality
from strataflow.operators.filters import accepted, rejected
from strataflow.operators.incremental import incremental_scan, merge_upsert
from strataflow.operators.joins import asof_left, cross_scalar, lookup_on, missing_in, star
from strataflow.operators.scd2 import scd2_apply
from strataflow.operators.sets import distinct_values, measure_by, null_profile
from strataflow.operators.vector_index import VectorMemory
from strataflow.operators.vectors import nearest, nearest_batch, remember
from strataflow.operators.windows import first_per_key, keep_latest
from strataflow.plans import checks, gold, pipeline, silver
from strataflow.session import new_path, stage, use_utc
from strataflow.sources import files, manifest, schemas, weather
from strataflow.sources.history import VersionHistory
from strataflow.sources.tables import TableStore, bronze_append, land_parquet
from strataflow.streaming.bronze import stream_bronze

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query under its name; instants come out as UTC wall clocks."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(fn(use_utc(spark), sf_dir.rstrip("/")))

    REGISTRY[fn.__name__] = run
    return fn


def flagged_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver.silver_trips(trips_raw(spark, sf_dir))


# --- one row per key, silver -------------------------------------------------


@query
def dedup_latest(spark, sf_dir):
    return keep_latest(
        table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]
    )


@query
def clean_trips(spark, sf_dir):
    return silver.clean_trips(silver.deduplicate(trips_raw(spark, sf_dir)))


@query
def station_lookup(spark, sf_dir):
    return silver.station_lookup(silver.clean_trips(silver.deduplicate(trips_raw(spark, sf_dir))))


@query
def backfill(spark, sf_dir):
    return flagged_trips(spark, sf_dir).select(
        "ride_id", "start_station_name", "start_station_id", "end_station_name", "end_station_id"
    )


@query
def silver_accepted(spark, sf_dir):
    return accepted(flagged_trips(spark, sf_dir))


@query
def silver_rejected(spark, sf_dir):
    return rejected(flagged_trips(spark, sf_dir))


@query
def rejection_summary(spark, sf_dir):
    return measure_by(
        flagged_trips(spark, sf_dir).withColumn(
            "reason", F.coalesce("rejection_reason", F.lit("accepted"))
        ),
        ["reason"],
        rides=F.count(F.lit(1)),
        members=F.count_if(F.col("member_casual") == "member"),
        mean_minutes=exact_mean("ride_duration_minutes"),
    )


@query
def weather_hourly(spark, sf_dir):
    return silver.silver_weather(weather_raw(spark, sf_dir))


@query
def hourly_join(spark, sf_dir):
    hours = stage(silver.silver_weather(weather_raw(spark, sf_dir)), "weather")
    trips = silver.clean_trips(silver.deduplicate(trips_raw(spark, sf_dir)))
    return lookup_on(
        trips.select("ride_id", "started_at"),
        hours,
        hour_bucket("started_at"),
        "observation_time",
        {"temperature_c": "temperature_c", "weather_code": "weather_code"},
    )


@query
def geo_distance(spark, sf_dir):
    points = ("start_lng", "start_lat", "end_lng", "end_lat")
    return silver.deduplicate(trips_raw(spark, sf_dir)).select(
        "ride_id",
        F.round(geo_km(*points), 2).alias("ellipsoid_km"),
        F.round(geo_km(*points, model="sphere"), 2).alias("sphere_km"),
    )


# --- dimensions, history, fact ----------------------------------------------


@query
def dim_date(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("start_date"))
    return gold.dim_date(orders, as_of="2010-01-01", start="1990-01-01")


@query
def dim_label(spark, sf_dir):
    names = {"BUILDING": "Building", "MACHINERY": "Machinery", "HOUSEHOLD": "Household"}
    return gold.dim_label(table(spark, sf_dir, "customer"), "c_mktsegment", "segment", names)


@query
def dim_types(spark, sf_dir):
    trips = silver.clean_trips(trips_raw(spark, sf_dir))
    riders, bikes = gold.dim_rider_type(trips), gold.dim_bike_type(trips)
    names = ["type_key", "type", "type_desc"]
    return riders.toDF(*names).unionByName(bikes.toDF(*names))


@query
def scd2_history(spark, sf_dir):
    """Priority per customer, one snapshot per year of those who ordered in it."""
    orders = table(spark, sf_dir, "orders").withColumn("year", F.year("o_orderdate"))
    latest = keep_latest(
        orders.select("o_custkey", "year", "o_orderdate", "o_orderkey", "o_orderpriority"),
        ["o_custkey", "year"],
        ["o_orderdate", "o_orderkey"],
    )
    state = stage(latest, "yearly-state", ["year"])
    store = TableStore(spark, new_path(spark, "history"))
    history = VersionHistory(store, "customers", "o_custkey", ["o_orderpriority"])
    span = state.agg(F.min("year"), F.max("year")).first()
    for year in range(span[0], span[1] + 1):
        current = state.where(F.col("year") == year).select(
            "o_custkey", "o_orderpriority", "o_orderkey"
        )
        as_of = f"{year + 1}-01-01 00:00:00"
        history.snapshot(current, as_of)
    return history.read()


def station_history(accepted_trips: DataFrame) -> DataFrame:
    """Three snapshots of the stations, each over the rides begun by then."""
    history = None
    for stamp, seen in station_batches(accepted_trips):
        current = silver.station_current(accepted_trips.where(seen))
        history = stage(
            scd2_apply(history, current, "station_id", ["station_name"], stamp), "stations"
        )
    return history


@query
def station_current(spark, sf_dir):
    return silver.station_current(accepted(flagged_trips(spark, sf_dir)))


@query
def dim_station(spark, sf_dir):
    return gold.dim_station(station_history(stage(accepted(flagged_trips(spark, sf_dir)), "silver")))


@query
def scd2_backdated(spark, sf_dir):
    """The yearly history as a dimension: first versions backdated, current ones marked."""
    history = scd2_history(spark, sf_dir).select(
        F.col("o_custkey").alias("station_id"),
        F.col("o_orderpriority").alias("station_name"),
        F.col("o_orderkey").cast("double").alias("latitude"),
        F.lit(0.0).alias("longitude"),
        *[f"dbt_{c}" for c in ("scd_id", "updated_at", "valid_from", "valid_to")],
    )
    return gold.dim_station(history)


def _shipments(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = table(spark, sf_dir, "orders")
    owner = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"
    )
    return lines.join(owner, "l_orderkey"), orders.select(
        "o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority"
    )


def _asof(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    lines, orders = _shipments(spark, sf_dir)
    if options:  # the plan that reads both sides more than once
        lines = stage(lines, "lines")
    return asof_left(
        lines,
        stage(keep_latest(orders, ["o_custkey", "o_orderdate"], ["o_orderkey"]), "versions"),
        {"o_custkey": "o_custkey"},
        "l_shipdate",
        "o_orderdate",
        {"o_orderkey": "asof_orderkey", "o_orderpriority": "asof_priority"},
        unique=True,
        **options,
    )


@query
def asof_join(spark, sf_dir):
    """The customer's latest order when the line shipped."""
    return _asof(spark, sf_dir)


@query
def asof_join_window(spark, sf_dir):
    """The same with the plan for a large right side."""
    return _asof(spark, sf_dir, strategy="window")


@query
def asof_join_bounded(spark, sf_dir):
    """As-of join to versions that end: matches after the end are dropped."""
    lines, orders = _shipments(spark, sf_dir)
    versions = keep_latest(orders, ["o_custkey", "o_orderdate"], ["o_orderkey"]).withColumn(
        "ends", F.col("o_orderdate") + F.expr("INTERVAL 60 DAYS")
    )
    return asof_left(
        lines,
        stage(versions, "versions"),
        {"o_custkey": "o_custkey"},
        "l_shipdate",
        "o_orderdate",
        {"o_orderkey": "asof_orderkey"},
        valid_to="ends",
        unique=True,
    )


def gold_from(trips: DataFrame, hours: DataFrame) -> dict[str, DataFrame]:
    """All gold tables from written silver tables."""
    out = {
        "dim_date": gold.dim_date(trips, as_of="2024-03-01"),
        "dim_station": gold.dim_station(station_history(trips)),
        "dim_rider_type": gold.dim_rider_type(trips),
        "dim_bike_type": gold.dim_bike_type(trips),
    }
    out = {name: stage(df, name) for name, df in out.items()}
    out["fact_trips"] = gold.fact_trips(trips, *out.values(), hours)
    return out


def gold_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All gold tables from the raw trips and weather."""
    return gold_from(
        stage(accepted(flagged_trips(spark, sf_dir)), "silver"),
        stage(silver.silver_weather(weather_raw(spark, sf_dir)), "weather"),
    )


@query
def fact_build(spark, sf_dir):
    return gold_tables(spark, sf_dir)["fact_trips"]


@query
def trip_report(spark, sf_dir):
    """Mean ride by rider type, bike type and weekend: the flagship query."""
    g = gold_tables(spark, sf_dir)
    joined = gold.trip_star(
        g["fact_trips"], g["dim_date"], g["dim_station"], g["dim_rider_type"], g["dim_bike_type"]
    )
    return measure_by(
        joined,
        ["rider_type_desc", "bike_type_desc", "is_weekend"],
        rides=F.count(F.lit(1)),
        mean_minutes=exact_mean("ride_duration_minutes"),
        mean_km=exact_mean("ride_distance_km"),
        mean_temperature=exact_mean("temperature_c"),
    )


@query
def star_query(spark, sf_dir):
    """Orders of one region in the latest year covered, by nation and segment."""
    orders = table(spark, sf_dir, "orders")
    covered = analyst.coverage(orders.select(F.to_date("o_orderdate").alias("day")), "day")
    latest = analyst.in_default_year(orders, "o_orderdate", covered)
    # The customers are cut down to the region before they meet the orders.
    nations = star(
        table(spark, sf_dir, "nation"),
        [(table(spark, sf_dir, "region").where(ieq("r_name", "asia")), "n_regionkey", "r_regionkey")],
    )
    buyers = star(
        table(spark, sf_dir, "customer"), [(nations, "c_nationkey", "n_nationkey")]
    ).select("c_custkey", "c_mktsegment", "n_name")
    return measure_by(
        star(latest, [(buyers, "o_custkey", "c_custkey")]),
        ["n_name", "c_mktsegment"],
        orders=F.count(F.lit(1)),
        mean_price=exact_mean("o_totalprice"),
    )


# --- incremental -------------------------------------------------------------


@query
def merge_upserts(spark, sf_dir):
    """Two overlapping slices of the orders; the later one carries new prices."""
    orders = table(spark, sf_dir, "orders")
    target = orders.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    updates = orders.where(
        F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    ).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return merge_upsert(target, updates, ["o_orderkey"])


@query
def merge_partitions(spark, sf_dir):
    """The same on a table partitioned by year, of which only touched years are rewritten."""
    orders = table(spark, sf_dir, "orders").withColumn("order_year", F.year("o_orderdate"))
    store = TableStore(spark, new_path(spark, "merge"))
    store.write(
        "orders",
        orders.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")),
        partition_by=["order_year"],
    )
    updates = orders.where(
        F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    ).withColumn("o_totalprice", F.col("o_totalprice") + 1)
    return store.merge("orders", updates, ["o_orderkey"], partition_by="order_year")


@query
def incremental_watermark(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    loaded = orders.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    return incremental_scan(orders, loaded, mode="watermark", stamp_col="o_orderdate")


@query
def incremental_sources(spark, sf_dir):
    raw = trips_raw(spark, sf_dir)
    return incremental_scan(raw, raw.where(F.col("_source_file") < "m2"))


@query
def silver_incremental(spark, sf_dir):
    """Silver in two batches: the second sees the station names of the first."""
    raw = trips_raw(spark, sf_dir)
    store = TableStore(spark, new_path(spark, "silver"))

    def merge(updates):
        by_month = updates.withColumn("start_month", F.month("start_date"))
        return store.merge("trips", by_month, ["ride_id"], partition_by="start_month")

    target = merge(silver.silver_trips(raw.where(F.col("_source_file") < "m2")))
    known = store.partition_view("trips", "station_pairs", "start_month", silver.pair_counts)
    return merge(silver.silver_trips(incremental_scan(raw, target), known=known)).drop("start_month")


@query
def late_file_merge(spark, sf_dir):
    """Files merged newest first: the late, older ones do not undo newer rides."""
    store = TableStore(spark, new_path(spark, "late"))
    raw = trips_raw(spark, sf_dir)
    for batch in (F.col("_source_file") >= "m2", F.col("_source_file") < "m2"):
        cleaned = silver.clean_trips(silver.deduplicate(raw.where(batch)))
        by_month = cleaned.withColumn("start_month", F.month("start_date"))
        store.merge(
            "trips", by_month, ["ride_id"], partition_by="start_month", newest=["_ingested_at", "_source_file"]
        )
    return store.read("trips").drop("start_month")


@query
def silver_refresh(spark, sf_dir):
    """Silver rebuilt from all of bronze over an earlier, partial state."""
    store = TableStore(spark, new_path(spark, "refresh"))
    cfg = pipeline.Config("", "", store.root)
    bronze = {
        "bronze_trips": trips_raw(spark, sf_dir).withColumn("_archive", F.col("_source_file")),
        "bronze_weather": weather_raw(spark, sf_dir).withColumn("_payload", F.lit("w")),
    }
    some = {**bronze, "bronze_trips": bronze["bronze_trips"].where(F.col("_archive") < "m1")}
    pipeline.build_silver(store, cfg, some)
    pipeline.build_silver(store, cfg, bronze, refresh=True)
    return store.read("int_trips_cleaned").drop("start_month")


@query
def incremental_equals_full(spark, sf_dir):
    """Rides whose flag, duration or station ids differ between the two ways of building."""
    whole = flagged_trips(spark, sf_dir).select(
        "ride_id",
        F.col("rejection_reason").alias("full_reason"),
        F.col("ride_duration_minutes").alias("full_minutes"),
        F.col("start_station_id").alias("full_start"),
        F.col("end_station_id").alias("full_end"),
    )
    both = silver_incremental(spark, sf_dir).join(whole, "ride_id", "full")
    return both.agg(
        F.count(F.lit(1)).alias("rides"),
        F.count_if(~F.col("rejection_reason").eqNullSafe(F.col("full_reason"))).alias("other_reason"),
        F.count_if(~F.col("ride_duration_minutes").eqNullSafe(F.col("full_minutes"))).alias(
            "other_minutes"
        ),
        F.count_if(~F.col("start_station_id").eqNullSafe(F.col("full_start"))).alias("other_start"),
        F.count_if(~F.col("end_station_id").eqNullSafe(F.col("full_end"))).alias("other_end"),
    )


# --- sources -----------------------------------------------------------------


@query
def manifest_scan(spark, sf_dir):
    """Page addresses as an XML listing, one listing page per row, cut at a start key."""
    pages = table(spark, sf_dir, "pages")
    listing = pages.select(
        F.col("page_id").alias("page"),
        F.concat(
            F.lit("<ListBucketResult xmlns='http://s3.amazonaws.com/doc/2006-03-01/'><Contents><Key>"),
            F.replace(F.col("url"), F.lit("&"), F.lit("&amp;")),
            F.lit("</Key></Contents></ListBucketResult>"),
        ).alias("xml"),
    )
    https = F.col("url").startswith("https://") & F.col("url").endswith(".html")
    start = pages.where(https).agg(F.min("url")).first()[0]
    return manifest.discover_sources(listing, "https://", ".html", start or "").select("page", "key")


@query
def new_sources(spark, sf_dir):
    """Addresses not landed yet; those of the first protocol have landed."""
    urls = table(spark, sf_dir, "pages").select(F.col("url").alias("key"))
    return manifest.new_sources(urls, urls.where(F.col("key").startswith("http://")))


@query
def missing_dates(spark, sf_dir):
    return weather.missing_dates(table(spark, sf_dir, "events"), "2024-03-01", ts="ts")


@query
def json_unpack(spark, sf_dir):
    """Payloads of three hours each, made from every event, one measure missing."""
    hour = F.col("ts")
    stamps = [
        F.date_format(hour + F.expr(f"INTERVAL {i} HOURS"), "yyyy-MM-dd'T'HH:mm:ss")
        for i in range(3)
    ]
    payload = F.struct(
        F.struct(
            F.array(*stamps).alias("time"),
            F.array(F.col("value"), F.col("value") + 1, F.lit(None)).alias("temperature_2m"),
            F.array(F.col("value"), F.lit(0.0), F.lit(0.5)).alias("windspeed_10m"),
            F.array(F.lit(1), F.lit(2), (F.col("user_id") % 100).cast("int")).alias("weathercode"),
            F.array(F.lit(1), F.lit(0), (F.col("event_id") % 2).cast("int")).alias("is_day"),
        ).alias("hourly")
    )
    return weather.unpack_hourly(
        table(spark, sf_dir, "events").select(F.to_json(payload).alias("json"))
    )


@query
def props_unpack(spark, sf_dir):
    """The JSON property of the events."""
    k = F.from_json("props", "k int")["k"]
    return table(spark, sf_dir, "events").groupBy(k.alias("k")).agg(
        F.count(F.lit(1)).alias("events")
    )


@query
def archive_scan(spark, sf_dir):
    """Trips packed into zip archives, a few thousand rows each, and read back typed."""
    names = schemas.TRIP_FILE.fieldNames()

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import zipfile

        for batch in batches:
            if not len(batch):
                continue
            name = f"{batch['ride_id'].iloc[0]}"
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as z:
                z.writestr("__MACOSX/._x.csv", "junk")
                z.writestr("notes.txt", "notes")
                z.writestr(f"{name}.csv", batch[names].to_csv(index=False))
            yield pd.DataFrame({"path": [f"/a/{name}.csv.zip"], "content": [buffer.getvalue()]})

    text = trips_raw(spark, sf_dir).select(*[F.col(c).cast("string").alias(c) for c in names])
    archives = text.mapInPandas(pack, "path string, content binary")
    rows = files.typed(files.unpack_archives(archives, schemas.TRIP_FILE), schemas.TRIP_FILE)
    good, _ = files.split_refused(rows)
    return good.select(*names)


def _customer_schema() -> T.StructType:
    return T.StructType(
        [
            T.StructField("c_custkey", T.LongType()),
            T.StructField("c_name", T.StringType()),
            T.StructField("c_nationkey", T.IntegerType()),
            T.StructField("c_acctbal", T.DoubleType()),
            T.StructField("c_mktsegment", T.StringType()),
        ]
    )


@query
def csv_raw(spark, sf_dir):
    """Customers through CSV: a blank field is NULL, NA and NULL stay text, fields hold line feeds.

    A second folder has the same rows with a field too many or too few; the last
    row of the result counts them.
    """
    path, other = new_path(spark, "csv"), new_path(spark, "csv-odd")
    segment = F.col("c_mktsegment")
    odd = (
        F.when(segment == "BUILDING", "NA")
        .when(segment == "MACHINERY", "NULL")
        .when(segment == "FURNITURE", None)
        .otherwise(F.concat(F.lit(" "), segment, F.lit(',\n"x"')))
    )
    table(spark, sf_dir, "customer").withColumn("c_mktsegment", odd).write.option(
        "header", True
    ).option("escape", '"').option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).csv(path)
    schema = _customer_schema()
    good, _ = files.split_refused(files.typed(files.read_csv_raw(spark, path, schema), schema))
    keys = table(spark, sf_dir, "customer").select(F.col("c_custkey").cast("string").alias("k"))
    lines = keys.select(F.explode(F.array(F.concat("k", F.lit(",a,1,2,b,c")), F.concat("k", F.lit(",a,1")))).alias("value"))
    # The rows of a file go below its header; two texts in a file would hide one header in the rows.
    lines.groupBy(F.xxhash64("value") % 4).agg(
        F.concat_ws("\n", F.lit(",".join(schema.fieldNames())), F.concat_ws("\n", F.sort_array(F.collect_list("value")))).alias("value")
    ).select("value").write.option("maxRecordsPerFile", 1).text(f"{other}/rows")
    odd_rows = files.typed(files.read_csv_raw(spark, f"{other}/rows", schema), schema)
    bad = odd_rows.agg(F.count_if(F.col("_error").startswith("wrong number of fields")).alias("bad_rows"))
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return good.select(*schema.fieldNames(), F.lit(0).cast("bigint").alias("bad_rows")).unionByName(
        bad.select(*nulls, "bad_rows")
    )


@query
def mixed_ts(spark, sf_dir):
    """Order dates written in ten layouts and parsed back; junk and bare times give NULL."""
    day = F.col("o_orderdate") + F.make_dt_interval(mins=(F.col("o_orderkey") % 600).cast("int"))
    kind, even = F.col("o_orderpriority"), F.col("o_orderkey") % 2 == 0
    text = (
        F.when((kind == "1-URGENT") & even, F.date_format(day, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == "1-URGENT", F.date_format(day, "MMM d, yyyy H:mm"))
        .when((kind == "2-HIGH") & even, F.date_format(day, "M/d/yyyy H:mm"))
        .when(kind == "2-HIGH", F.date_format(day, "d-MMM-yyyy H:mm"))
        .when((kind == "3-MEDIUM") & even, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
        .when((kind == "3-MEDIUM") & (F.dayofmonth(day) > 12), F.date_format(day, "d/M/yyyy H:mm"))
        .when(kind == "3-MEDIUM", F.date_format(day, "M/d/yyyy H:mm:ss.SSS"))
        .when((kind == "4-NOT SPECIFIED") & even, F.concat(F.date_format(day, "yyyy-MM-dd HH:mm:ss"), F.lit("+02:00")))
        .when(kind == "4-NOT SPECIFIED", F.date_format(day, "MMMM d, yyyy H:mm"))
        .when(even, F.date_format(day, "HH:mm"))
        .when(F.col("o_orderkey") % 3 == 0, F.date_format(day, "yyyyMM"))
        .otherwise(F.concat(F.lit("junk "), F.col("o_orderkey").cast("string")))
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", parse_mixed_ts(text).alias("parsed"))


@query
def refused_sources(spark, sf_dir):
    """Files with an unreadable timestamp are refused whole, the others kept."""
    names = schemas.TRIP_FILE.fieldNames()
    raw = trips_raw(spark, sf_dir)
    text = raw.select(
        *[F.col(c).cast("string").alias(c) for c in names],
        F.concat("_source_file", F.lit("-"), F.col("start_station_name")).alias("_source_file"),
        F.lit(None).cast("string").alias("_error"),
    ).withColumn("_archive", F.col("_source_file"))
    broken = F.when(F.col("start_lat").isNull(), "not a time").otherwise(F.col("started_at"))
    rows = files.typed(text.withColumn("started_at", broken), schemas.TRIP_FILE)
    good, refused = files.split_refused(rows)
    kept = good.groupBy(F.col("_archive").alias("source")).agg(
        F.count(F.lit(1)).alias("row_count"), F.lit(0).cast("bigint").alias("bad_rows")
    )
    return kept.unionByName(
        refused.select(F.col("_archive").alias("source"), F.lit(0).cast("bigint").alias("row_count"), "bad_rows")
    )


@query
def contract_read(spark, sf_dir):
    contract = T.StructType(
        [
            T.StructField("c_custkey", T.StringType(), False),
            T.StructField("c_acctbal", T.DecimalType(12, 2), True),
            T.StructField("c_mktsegment", T.StringType(), False),
        ]
    )
    return schemas.read_contract(table(spark, sf_dir, "customer"), contract, enforce=True)


@query
def drop_null_keys(spark, sf_dir):
    customers = table(spark, sf_dir, "customer").withColumn(
        "segment_key", F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    )
    return files.drop_null_keys(customers, "c_custkey", "segment_key")


@query
def bronze_load(spark, sf_dir):
    """Two landings, one repeated, appended to bronze file by file."""
    landing, bronze = new_path(spark, "landing"), new_path(spark, "bronze")
    raw = files.stamp_lineage(trips_raw(spark, sf_dir), "2024-03-02 00:00:00", F.col("_source_file"))
    land_parquet(raw.where(F.col("_source_file") < "m2"), landing)
    bronze_append(spark, landing, bronze)
    land_parquet(raw, landing)
    bronze_append(spark, landing, bronze)
    return files.read_parquet(spark, bronze).groupBy("_source_file").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct("ride_id").alias("rides"),
        F.max("_ingested_at").alias("ingested_at"),
    )


@query
def stream_load(spark, sf_dir):
    """The same landings taken in as a stream, merged by ride, across two runs."""
    root = new_path(spark, "stream")
    store = TableStore(spark, f"{root}/tables")
    raw = trips_raw(spark, sf_dir)
    for wanted in (F.col("_source_file") < "m2", F.col("_source_file") >= "m2"):
        raw.where(wanted).write.mode("append").parquet(f"{root}/landing")
        run = stream_bronze(
            spark,
            f"{root}/landing",
            store,
            "trips",
            raw.schema,
            ["ride_id"],
            ["_ingested_at", "_source_file"],
            f"{root}/checkpoint",
        )
        run.awaitTermination()
    return store.read("trips")


@query
def sorted_write(spark, sf_dir):
    """Customers as a sorted, documented table, a view over it, and the docs read back."""
    store = TableStore(spark, new_path(spark, "sorted"))
    docs = {"c_custkey": "Key of the customer", "c_name": "Name"}
    store.write(
        "customer", table(spark, sf_dir, "customer"), sort=["c_mktsegment", "c_custkey"], docs=docs
    )
    df = store.register("customer", "documented_customer")
    comment = df.schema["c_custkey"].metadata["comment"]
    return spark.table("documented_customer").withColumn("key_comment", F.lit(comment))


# --- quality -----------------------------------------------------------------

AS_OF = "2024-02-15 00:00:00"


def _quality_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {n: table(spark, sf_dir, n) for n in ("orders", "customer", "lineitem", "events", "nation")}


def _checks(spark: SparkSession, sf_dir: str, checks: list[quality.Check]) -> DataFrame:
    return quality.run_checks(_quality_tables(spark, sf_dir), checks, AS_OF)


@query
def check_not_null(spark, sf_dir):
    return _checks(
        spark,
        sf_dir,
        [
            quality.row_count("orders"),
            quality.not_null("orders", "o_orderkey"),
            quality.not_null("orders", "o_custkey"),
            quality.missing_count("events", "ts"),
            quality.missing_count("events", "props", severity="warn"),
        ],
    )


@query
def check_unique(spark, sf_dir):
    return _checks(
        spark,
        sf_dir,
        [
            quality.unique("orders", "o_orderkey"),
            quality.unique("customer", "c_custkey"),
            quality.unique("lineitem", "l_orderkey", severity="warn"),
        ],
    )


@query
def check_accepted_values(spark, sf_dir):
    return _checks(
        spark,
        sf_dir,
        [
            quality.accepted_values("customer", "c_mktsegment", ["BUILDING", "MACHINERY"], "warn"),
            quality.accepted_values("orders", "o_orderstatus", ["O", "F", "P"]),
            quality.invalid_count("events", "event_type", ["view", "click", "signup", "purchase"]),
        ],
    )


@query
def check_relationships(spark, sf_dir):
    return _checks(
        spark,
        sf_dir,
        [
            quality.relationships("orders", "o_custkey", "customer", "c_custkey"),
            quality.relationships("lineitem", "l_orderkey", "orders", "o_orderkey"),
            quality.relationships("events", "user_id", "nation", "n_nationkey", "warn"),
        ],
    )


@query
def check_freshness(spark, sf_dir):
    return _checks(
        spark,
        sf_dir,
        [quality.freshness("events", "ts", 40), quality.freshness("orders", "o_orderdate", 40, "warn")],
    )


@query
def orphan_keys(spark, sf_dir):
    """User ids that are no nation key, with their events."""
    return missing_in(
        table(spark, sf_dir, "events"), "user_id", table(spark, sf_dir, "nation"), "n_nationkey"
    )


@query
def null_anomalies(spark, sf_dir):
    """NULLs of a start latitude by day, scored against the fortnight before."""
    profile = null_profile(trips_raw(spark, sf_dir), "start_lat", "started_at")
    scored = quality.anomaly_scores(profile, "null_percent")
    return scored.select(
        "day",
        "row_count",
        "null_count",
        F.round("null_percent", 6).alias("null_percent"),
        "past_points",
        F.round("past_mean", 6).alias("past_mean"),
        F.round("past_stddev", 6).alias("past_stddev"),
        F.round("score", 4).alias("score"),
        "anomalous",
    )


@query
def layer_quality(spark, sf_dir):
    """All checks of all layers on the layers built from the events."""
    flagged = stage(flagged_trips(spark, sf_dir), "flagged")
    hours = stage(silver.silver_weather(weather_raw(spark, sf_dir)), "weather")
    trips = stage(accepted(flagged), "silver")
    tables = gold_from(trips, hours)
    tables["fact_trips"] = stage(tables["fact_trips"], "fact")
    tables |= {
        "bronze_trips": trips_raw(spark, sf_dir),
        "bronze_weather": weather_raw(spark, sf_dir),
        "int_trips_cleaned": flagged,
        "silver_trips": trips,
        "silver_trips_rejected": rejected(flagged),
        "int_weather_cleaned": hours,
        "silver_weather": hours,
    }
    all_checks = [*checks.BRONZE_CHECKS, *checks.SILVER_CHECKS, *checks.GOLD_CHECKS]
    return quality.run_checks(tables, all_checks, AS_OF)


@query
def reconciliation(spark, sf_dir):
    flagged = stage(flagged_trips(spark, sf_dir), "flagged")
    hours = stage(silver.silver_weather(weather_raw(spark, sf_dir)), "weather")
    trips = stage(accepted(flagged), "silver")
    return quality.reconcile(flagged, gold_from(trips, hours)["fact_trips"])


@query
def gate_layers(spark, sf_dir):
    """Whether each layer may go on: the verdict of the gate on its checks."""
    flagged = stage(flagged_trips(spark, sf_dir), "flagged")
    hours = stage(silver.silver_weather(weather_raw(spark, sf_dir)), "weather")
    trips = stage(accepted(flagged), "silver")
    tables = gold_from(trips, hours)
    tables["fact_trips"] = stage(tables["fact_trips"], "fact")
    tables |= {
        "bronze_trips": trips_raw(spark, sf_dir),
        "bronze_weather": weather_raw(spark, sf_dir),
        "int_trips_cleaned": flagged,
        "silver_trips": trips,
        "silver_trips_rejected": rejected(flagged),
        "int_weather_cleaned": hours,
        "silver_weather": hours,
    }
    rows = []
    layers = {"bronze": checks.BRONZE_CHECKS, "silver": checks.SILVER_CHECKS, "gold": checks.GOLD_CHECKS}
    for layer, own in layers.items():
        try:
            rows.append((layer, len(quality.gate(quality.run_checks(tables, own, AS_OF))), True))
        except quality.QualityError:
            rows.append((layer, len(own), False))
    return spark.createDataFrame(rows, "layer string, checks bigint, passed boolean")


# --- analyst surface ---------------------------------------------------------


@query
def enum_values(spark, sf_dir):
    wanted = {
        "customer": ["c_mktsegment"],
        "part": ["p_brand", "p_type"],
        "orders": ["o_orderpriority"],
    }
    return analyst.enum_values(
        {name: (table(spark, sf_dir, name), cols) for name, cols in wanted.items()}
    )


@query
def coverage(spark, sf_dir):
    return analyst.coverage(table(spark, sf_dir, "orders"), "o_orderdate")


@query
def describe_gold(spark, sf_dir):
    """Columns of the gold tables, built and stored, with what the tables say of themselves."""
    store = TableStore(spark, new_path(spark, "gold"))
    for name, df in gold_tables(spark, sf_dir).items():
        store.write(name, df, docs=gold.DOCS[name], description=gold.TABLE_DOCS[name])
    names = store.names()
    return analyst.describe(
        {n: store.read(n) for n in names}, spark, {n: store.description(n) for n in names}
    )


TOP_ORDERS = """
SELECT o_orderpriority, o_custkey, count(*) AS orders, round(sum(o_totalprice), 2) AS total_price
FROM orders GROUP BY o_orderpriority, o_custkey
ORDER BY orders DESC, o_custkey, o_orderpriority;
"""


@query
def safe_sql(spark, sf_dir):
    """The rows of a guarded query, with how many there are in all."""
    session = analyst.gold_session(spark, {"orders": f"{sf_dir}/orders.parquet"})
    answer = analyst.safe_sql(session, TOP_ORDERS, timeout=600)
    if answer.error:
        raise RuntimeError(answer.error)
    rows = [(*r, answer.total, answer.truncated) for r in answer.rows]
    schema = "o_orderpriority string, o_custkey bigint, orders bigint, total_price double, total bigint, truncated boolean"
    return spark.createDataFrame(rows, schema)


def query_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as a query log: some made to look like statements."""
    turn, text = F.col("turn"), F.col("text")
    framed = (
        F.when(F.col("role") == "user", F.concat(F.lit(" select '"), text, F.lit("' ;  ")))
        .when(turn % 4 == 1, F.concat(F.lit("WITH x AS (SELECT 1) "), text, F.lit(" delete from x")))
        .when(turn % 4 == 3, F.concat(F.lit("SELECT created_at, "), text, F.lit("; drop table x")))
        .otherwise(text)
    )
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", framed.alias("query"))


@query
def sql_guard_audit(spark, sf_dir):
    return query_texts(spark, sf_dir).select(
        "conv_id", "turn", analyst.guard_verdict("query").alias("verdict")
    )


@query
def document_guard_audit(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy(
        analyst.guard_verdict("text").alias("verdict")
    ).agg(F.count(F.lit(1)).alias("texts"))


@query
def vector_topk(spark, sf_dir):
    """The rows closest to the first vector."""
    vectors = table(spark, sf_dir, "embeddings")
    start = vectors.orderBy("vec_id").select("embedding").first()[0]
    return nearest(vectors, start, 3, tie="vec_id", digits=6).select("vec_id", "label", "distance")


@query
def vector_topk_batch(spark, sf_dir):
    """The rows closest to the first vector of every label."""
    vectors = table(spark, sf_dir, "embeddings")
    starts = first_per_key(vectors, ["label"], [F.col("vec_id")])
    return nearest_batch(
        starts.withColumnRenamed("vec_id", "start_id"),
        vectors,
        3,
        query_id="start_id",
        vector_id="vec_id",
    )


@query
def vector_distance(spark, sf_dir):
    """Distance of every vector to the mean direction of its own halves."""
    half = F.slice("embedding", 1, 32), F.slice("embedding", 33, 32)
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.round(cosine_distance(*half), 6).alias("distance")
    )


@query
def memory_append(spark, sf_dir):
    """All documents as remembered questions, appended in two batches; one without vector has no dimensions."""
    vectors = table(spark, sf_dir, "embeddings").withColumnRenamed("vec_id", "doc_id")
    pairs = table(spark, sf_dir, "documents").join(vectors, "doc_id", "left").select(
        "doc_id", F.col("text").alias("question"), F.col("source").alias("query"), "embedding"
    )
    store = TableStore(spark, new_path(spark, "memory"))
    for half in (0, 1):
        store.append("memory", remember(pairs.where(F.col("doc_id") % 2 == half), BASE_STAMP))
    return store.read("memory").select(
        "id", "query", F.size("embedding").alias("dimensions"), "created_at"
    )


@query
def memory_recall(spark, sf_dir):
    """Vectors remembered in two batches, and those closest to the first of every label, by stored id."""
    vectors = table(spark, sf_dir, "embeddings")
    pairs = vectors.select(
        "vec_id",
        "label",
        F.concat(F.lit("vector "), F.col("vec_id")).alias("question"),
        F.concat(F.lit("label "), F.col("label")).alias("query"),
        "embedding",
    )
    memory = VectorMemory(TableStore(spark, new_path(spark, "recall")), "memory", lists=16)
    for half in (0, 1):
        memory.append(remember(pairs.where(F.col("vec_id") % 2 == half), BASE_STAMP))
    starts = first_per_key(pairs, ["label"], [F.col("vec_id")])
    schemas.read_contract(memory.read(), schemas.MEMORY)
    return memory.nearest(starts, 3, query_id="question")


# --- small operators ---------------------------------------------------------


@query
def distinct_values_of(spark, sf_dir):
    return distinct_values(table(spark, sf_dir, "documents"), "source")


@query
def cross_scalar_max(spark, sf_dir):
    """Each order's share of the highest price."""
    orders = table(spark, sf_dir, "orders")
    with_max = cross_scalar(orders, orders.agg(F.max("o_totalprice")), "top_price")
    return with_max.select(
        "o_orderkey", F.round(F.col("o_totalprice") / F.col("top_price"), 6).alias("share")
    )


@query
def surrogate_keys(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        surrogate_key("p_partkey", F.nullif(F.col("p_type"), F.lit("SMALL"))).alias("part_hash"),
        label("p_type", {"SMALL": "Small", "ECONOMY": "Economy"}).alias("type_desc"),
    )

