"""One run: archives and weather payloads in, checked star schema out.

Every step takes in only what is new and can be repeated: files already landed
or loaded are skipped, merges replace by key, full refreshes switch to a new
table version when it is complete.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from strataflow.functions.time import LOCAL_ZONE
from strataflow.operators.filters import accepted, rejected
from strataflow.operators.incremental import incremental_scan
from strataflow.operators.quality import gate, reconcile, run_checks
from strataflow.plans import checks, gold, silver
from strataflow.session import staging_scope, use_utc
from strataflow.sources import files, schemas, weather
from strataflow.sources.history import VersionHistory
from strataflow.sources.manifest import discover_sources, new_sources, parse_listing, start_listed
from strataflow.sources.tables import (
    TableStore,
    bronze_append,
    land_empty,
    land_parquet,
    landed_sources,
    path_exists,
    read_landed,
)

PAYLOAD = "_payload"


@dataclass
class Config:
    archives: str
    """Folder of the zip archives."""
    payloads: str
    """Folder of the weather payloads, one JSON document per file."""
    root: str
    """Folder of all tables."""
    listing: str | None = None
    """XML listing of the archives that count; without it, all in the folder do."""
    prefix: str = ""
    suffix: str = ".zip"
    start_from: str = ""
    """First key of the listing to take; empty takes all."""
    zone: str = LOCAL_ZONE
    calendar_start: str = gold.CALENDAR_START
    keep_versions: int = 3
    """Versions of each table that stay; a report's frames read those of its run."""

    @property
    def landing(self) -> str:
        return f"{self.root}/landing/trips"

    @property
    def bronze(self) -> str:
        return f"{self.root}/bronze/trips"

    @property
    def bronze_weather(self) -> str:
        return f"{self.root}/bronze/weather"


@dataclass
class Report:
    refused: DataFrame | None = None
    refused_payloads: DataFrame | None = None
    start_listed: bool = True
    """False if the listing lacks the key to start from, so that nothing is taken."""
    loaded: DataFrame | None = None
    results: list = field(default_factory=list)
    layers: DataFrame | None = None


def _new_files(
    spark: SparkSession, folder: str, landed: str, key: str, listed: DataFrame | None = None
) -> list[str]:
    """Paths of a folder's files whose names have no folder in the landing.

    With ``listed`` keys, only files named there count.
    """
    if not path_exists(spark, folder):
        return []
    listing = (
        spark.read.format("binaryFile")
        .load(folder)
        .select("path", F.element_at(F.split("path", "/"), -1).alias(key))
    )
    if listed is not None:
        listing = listing.join(listed.select(F.col("key").alias(key)), key, "left_semi")
    known = landed_sources(spark, landed, key) if path_exists(spark, landed) else None
    wanted = new_sources(listing, known, key)
    return [row.path for row in listing.join(wanted, key, "left_semi").collect()]


def _listing(spark: SparkSession, cfg: Config) -> DataFrame:
    return spark.read.text(cfg.listing, wholetext=True).select(
        F.col("value").alias("xml"), F.col("_metadata.file_name").alias("page")
    )


def listed_archives(spark: SparkSession, cfg: Config) -> DataFrame | None:
    """Keys of the listing from ``start_from`` on; None without a listing."""
    if cfg.listing is None:
        return None
    return discover_sources(_listing(spark, cfg), cfg.prefix, cfg.suffix, cfg.start_from)


def ingest(spark: SparkSession, cfg: Config, ingested_at: str) -> DataFrame | None:
    """Land the archives that are new; return the refused ones with a message.

    An archive that is read and has no rows lands as an empty folder.
    """
    new = _new_files(
        spark, cfg.archives, cfg.landing, files.ARCHIVE, listed_archives(spark, cfg)
    )
    if not new:
        return None
    raw = files.read_archives(spark, new, schemas.TRIP_FILE)
    good, refused = files.split_refused(files.typed(raw, schemas.TRIP_FILE))
    stamped = files.stamp_lineage(good, ingested_at)
    land_parquet(stamped, cfg.landing, files.ARCHIVE)
    landed = {r[0] for r in landed_sources(spark, cfg.landing, files.ARCHIVE).collect()}
    landed |= {r[0] for r in refused.select(files.ARCHIVE).collect()}
    names = [unquote(p.rsplit("/", 1)[-1]) for p in new]
    land_empty(stamped, cfg.landing, [n for n in names if n not in landed], files.ARCHIVE)
    return refused


def ingest_weather(spark: SparkSession, cfg: Config, ingested_at: str) -> DataFrame | None:
    """Append the hours of the payloads that are new; return those without any, with a message."""
    new = _new_files(spark, cfg.payloads, cfg.bronze_weather, PAYLOAD)
    if not new:
        return None
    payloads = spark.read.text(new, wholetext=True).select(
        F.col("value").alias("json"), F.col("_metadata.file_name").alias(PAYLOAD)
    )
    hours = files.drop_null_keys(weather.unpack_hourly(payloads, keep=[PAYLOAD]), "observation_time")
    land_parquet(files.stamp_lineage(hours, ingested_at), cfg.bronze_weather, PAYLOAD)
    return weather.refused_payloads(payloads, PAYLOAD)


def bronze_tables(spark: SparkSession, cfg: Config) -> dict[str, DataFrame]:
    """The bronze tables, each with the name of the file a row came in; one that
    nothing was loaded into yet is empty."""

    def read(path: str, key: str, contract: StructType) -> DataFrame:
        keyed = StructType([*contract.fields, StructField(key, StringType())])
        if landed_sources(spark, path, key).isEmpty():
            return spark.createDataFrame([], keyed)
        return schemas.read_contract(read_landed(spark, path, contract, key), keyed)

    return {
        "bronze_trips": read(cfg.bronze, files.ARCHIVE, schemas.BRONZE_TRIPS),
        "bronze_weather": read(cfg.bronze_weather, PAYLOAD, schemas.BRONZE_WEATHER),
    }


def build_silver(
    store: TableStore, cfg: Config, bronze: dict[str, DataFrame], refresh: bool = False
) -> None:
    """Merge the source files not taken in yet, or with ``refresh`` rebuild from all.

    The files done are kept in a table of their own: a file all of whose rides
    were replaced by a later one leaves no trace in the result.  A merge fills
    missing station ids of the new rides only; a rebuild revisits every ride,
    and so may fill, or leave empty, others.
    """
    trips, hours = bronze["bronze_trips"], bronze["bronze_weather"]
    if refresh:
        cleaned = silver.silver_trips(trips, None, cfg.zone)
        store.write("int_trips_cleaned", _by_month(cleaned), partition_by=["start_month"])
        station_pairs(store)
        store.write("silver_sources", trips.select(files.ARCHIVE).distinct())
        store.write("silver_weather", silver.silver_weather(hours, cfg.zone))
        store.write("silver_payloads", hours.select(PAYLOAD).distinct())
        return
    store.recover("int_trips_cleaned")
    batch, taken = _not_taken(store, "silver_sources", trips, files.ARCHIVE)
    if not batch.isEmpty():
        known = station_pairs(store) if store.exists("int_trips_cleaned") else None
        updates = _by_month(silver.silver_trips(batch, zone=cfg.zone, known=known))
        newest = ["_ingested_at", "_source_file"]
        store.merge("int_trips_cleaned", updates, ["ride_id"], partition_by="start_month", newest=newest)
        station_pairs(store)
        store.write("silver_sources", taken)
    batch, taken = _not_taken(store, "silver_payloads", hours, PAYLOAD)
    if not store.exists("silver_weather") or not batch.isEmpty():
        updates = silver.silver_weather(batch, cfg.zone)
        store.merge("silver_weather", updates, ["observation_time"], newest=["_ingested_at"])
        store.write("silver_payloads", taken)


def station_pairs(store: TableStore) -> DataFrame:
    """Rides by station name and id in silver, counted month by month as months are replaced."""
    return store.partition_view("int_trips_cleaned", "station_pairs", "start_month", silver.pair_counts)


def _not_taken(
    store: TableStore, name: str, bronze: DataFrame, key: str
) -> tuple[DataFrame, DataFrame]:
    """Rows of the files that silver has not taken in, and the files it has with them."""
    done = store.read_or_none(name)
    batch = incremental_scan(bronze, done, source_col=key)
    taken = batch.select(key).distinct()
    return batch, taken if done is None else done.unionByName(taken)


def _by_month(trips: DataFrame) -> DataFrame:
    return trips.withColumn(
        "start_month", F.year("start_date") * 100 + F.month("start_date")
    )


def silver_tables(store: TableStore) -> dict[str, DataFrame]:
    flagged = store.read("int_trips_cleaned").drop("start_month")
    hours = store.read("silver_weather")
    return {
        "int_trips_cleaned": flagged,
        "silver_trips": schemas.read_contract(accepted(flagged), schemas.SILVER_TRIPS),
        "silver_trips_rejected": rejected(flagged),
        "int_weather_cleaned": hours,
        "silver_weather": schemas.read_contract(hours, schemas.SILVER_WEATHER),
    }


def snapshot_stations(store: TableStore, trips: DataFrame, as_of: datetime | str) -> DataFrame:
    """Add today's state of the stations to their history."""
    return station_history(store).snapshot(silver.station_current(trips), as_of)


def station_history(store: TableStore) -> VersionHistory:
    return VersionHistory(
        store, "station_snapshot", "station_id", ["station_name"], schemas.STATION_HISTORY
    )


def build_gold(
    store: TableStore, cfg: Config, layers: dict[str, DataFrame], as_of: str
) -> dict[str, DataFrame]:
    """Full refresh of the star schema, sorted and documented."""
    trips = layers["silver_trips"]
    out: dict[str, DataFrame] = {}

    def write(name: str, df: DataFrame) -> None:
        out[name] = store.write(
            name, df, sort=gold.SORT_KEYS[name], docs=gold.DOCS[name], description=gold.TABLE_DOCS[name]
        )

    write("dim_date", gold.dim_date(trips, as_of[:10], cfg.calendar_start))
    write("dim_station", gold.dim_station(station_history(store).read()))
    write("dim_rider_type", gold.dim_rider_type(trips))
    write("dim_bike_type", gold.dim_bike_type(trips))
    write("fact_trips", gold.fact_trips(trips, *out.values(), layers["silver_weather"]))
    return out


def run(
    spark: SparkSession,
    cfg: Config,
    as_of: datetime | str,
    local_as_of: datetime | str,
    refresh: bool = False,
) -> Report:
    """All layers, with the checks between them.

    ``as_of`` is the instant of the run in UTC, ``local_as_of`` the same on the
    local clock, on which the station versions are compared with the rides.  A
    failed check of severity ``error`` stops the run before the next layer.
    ``refresh`` rebuilds silver from all of bronze.  What the run staged is
    deleted at its end.
    """
    use_utc(spark)
    with staging_scope(spark):
        return _run(spark, cfg, str(as_of), str(local_as_of), refresh)


def _run(
    spark: SparkSession, cfg: Config, as_of: str, local_as_of: str, refresh: bool
) -> Report:
    store = TableStore(spark, f"{cfg.root}/tables")
    report = Report()

    refused = ingest(spark, cfg, as_of)
    if refused is not None:
        report.refused = store.write("refused_archives", refused)
    if cfg.listing is not None:
        report.start_listed = start_listed(parse_listing(_listing(spark, cfg)), cfg.start_from)
    report.loaded = bronze_append(
        spark, cfg.landing, cfg.bronze, files.ARCHIVE, schemas.BRONZE_TRIPS
    )
    refused = ingest_weather(spark, cfg, as_of)
    if refused is not None:
        report.refused_payloads = store.write("refused_payloads", refused)
    bronze = bronze_tables(spark, cfg)
    report.results += gate(
        run_checks({"trips": bronze["bronze_trips"]}, checks.LANDED_CHECKS, as_of)
    )
    if not report.loaded.where("NOT loaded").isEmpty():
        raise RuntimeError("some landing files could not be loaded; silver is not built")

    build_silver(store, cfg, bronze, refresh)
    layers = silver_tables(store)
    report.results += gate(
        run_checks({**bronze, **layers}, checks.BRONZE_CHECKS + checks.SILVER_CHECKS, as_of)
    )
    snapshot_stations(store, layers["silver_trips"], local_as_of)
    star = build_gold(store, cfg, layers, local_as_of)
    report.results += gate(run_checks(star, checks.GOLD_CHECKS, as_of))
    report.layers = reconcile(layers["int_trips_cleaned"], star["fact_trips"])
    for name in store.names():
        store.drop_old(name, cfg.keep_versions)
    return report

