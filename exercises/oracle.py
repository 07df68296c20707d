"""The SQL counterpart of each query, over the same tables."""

from __future__ import annotations

from exercises.adapters import BASE_STAMP, BIKE_OF_EVENT
from strataflow.plans.gold import DOCS, TABLE_DOCS

ORACLE: dict[str, str] = {}


def mean(c: str) -> str:
    """Plain average to six decimals."""
    return f"round(avg({c}), 6)"


def with_(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n" + select.strip()


# --- shared steps ------------------------------------------------------------


def _station_id(n: str) -> str:
    return (
        f"CASE WHEN event_id % 7 <> 0 THEN 'ID' || ({n}) || "
        f"CASE WHEN ({n}) % 5 = 0 THEN '-' || (event_id % 2) ELSE '' END "
        "WHEN event_id % 2 = 0 THEN '' END"
    )


_BIKES = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in BIKE_OF_EVENT.items())

TRIPS_RAW = f"""
trips_raw AS (
  SELECT CAST(CASE WHEN event_id % 10 = 9 THEN event_id - 1 ELSE event_id END AS VARCHAR) AS ride_id,
    CASE event_type {_BIKES} END AS rideable_type,
    ts AS started_at,
    ts + to_microseconds(CAST(round((value * 5 - 20) * 60) AS BIGINT) * 1000000) AS ended_at,
    'S' || (user_id % 40) AS start_station_name,
    {_station_id("user_id % 40")} AS start_station_id,
    'S' || (event_id % 40) AS end_station_name,
    {_station_id("event_id % 40")} AS end_station_id,
    CASE WHEN event_id % 97 <> 0 THEN 40.70::DOUBLE + (user_id % 40) / 1000.0::DOUBLE END AS start_lat,
    -74.0::DOUBLE - (user_id % 40) / 1000.0::DOUBLE AS start_lng,
    CASE WHEN event_id % 89 <> 0 THEN 40.70::DOUBLE + (event_id % 40) / 1000.0::DOUBLE END AS end_lat,
    CASE WHEN event_id % 89 <> 0 THEN -74.0::DOUBLE - (event_id % 40) / 1000.0::DOUBLE END AS end_lng,
    CASE WHEN user_id % 2 = 1 THEN ' Member' ELSE 'casual' END AS member_casual,
    'm' || (event_id % 4) AS _source_file,
    TIMESTAMP '{BASE_STAMP}' + to_hours(CAST(event_id % 4 AS INTEGER)) AS _ingested_at
  FROM events)
"""

WEATHER_RAW = f"""
weather_raw AS (
  SELECT date_trunc('hour', ts) AS observation_time,
    CASE WHEN event_id % 3 <> 0 THEN value END AS temperature_c,
    CASE WHEN event_id % 5 <> 0 THEN value / 10 END AS precipitation_mm,
    CASE WHEN event_id % 7 <> 0 THEN value / 4 END AS wind_speed_kmh,
    CASE WHEN event_id % 11 <> 0 THEN CAST(event_id % 100 AS INTEGER) END AS weather_code,
    CASE WHEN event_id % 13 <> 0 THEN hour(ts) BETWEEN 6 AND 18 END AS is_daylight,
    TIMESTAMP '{BASE_STAMP}' + to_hours(CAST(event_id % 4 AS INTEGER)) AS _ingested_at
  FROM events)
"""

RAW_COLUMNS = [
    "ride_id", "rideable_type", "started_at", "ended_at", "start_station_name",
    "start_station_id", "end_station_name", "end_station_id", "start_lat", "start_lng",
    "end_lat", "end_lng", "member_casual", "_source_file", "_ingested_at",
]
CLEAN_COLUMNS = [
    "ride_id", "rideable_type", "started_at", "ended_at", "start_date", "start_hour",
    "day_of_week", "ride_duration_minutes", "start_station_name", "start_station_id",
    "end_station_name", "end_station_id", "start_lat", "start_lng", "end_lat", "end_lng",
    "member_casual", "_source_file", "_ingested_at",
]
FLAGGED_COLUMNS = [*CLEAN_COLUMNS, "rejection_reason"]


def latest(name: str, source: str, keys: list[str], newest: list[str], columns: list[str]) -> str:
    """One row per key: newest first, the other columns settle ties, largest first."""
    order = [*newest, *[c for c in columns if c not in keys and c not in newest]]
    by = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    return (
        f"{name} AS (SELECT {', '.join(columns)} FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {', '.join(keys)} ORDER BY {by}) AS rn FROM {source}) WHERE rn = 1)"
    )


def dedup(name: str = "deduplicated", source: str = "trips_raw") -> str:
    return latest(name, source, ["ride_id"], ["_ingested_at", "_source_file"], RAW_COLUMNS)


def _local(c: str) -> str:
    return f"timezone('America/New_York', {c} AT TIME ZONE 'UTC')"


def clean(name: str = "cleaned", source: str = "deduplicated") -> str:
    local = _local("r.started_at")
    blank = ", ".join(
        f"nullif(trim(r.{c}), '') AS {c}"
        for c in ("start_station_name", "start_station_id", "end_station_name", "end_station_id")
    )
    return f"""
{name} AS (
  SELECT r.ride_id, lower(trim(r.rideable_type)) AS rideable_type,
    {local} AS started_at, {_local("r.ended_at")} AS ended_at,
    CAST({local} AS DATE) AS start_date, CAST(hour({local}) AS INTEGER) AS start_hour,
    strftime({local}, '%A') AS day_of_week,
    round((epoch_us(r.ended_at) - epoch_us(r.started_at)) / 60000000.0::DOUBLE, 2) AS ride_duration_minutes,
    {blank}, r.start_lat, r.start_lng, r.end_lat, r.end_lng,
    lower(trim(r.member_casual)) AS member_casual, r._source_file, r._ingested_at
  FROM {source} r)
"""


def lookup(name: str = "lookup", *sources: str) -> str:
    legs = " UNION ALL ".join(
        f"SELECT {leg}_station_name AS station_name, {leg}_station_id AS station_id FROM {s}"
        for s in (sources or ("cleaned",))
        for leg in ("start", "end")
    )
    return f"""
{name} AS (
  SELECT station_name, max(station_id) AS resolved_station_id FROM ({legs})
  WHERE station_name IS NOT NULL AND station_id IS NOT NULL
  GROUP BY station_name HAVING count(DISTINCT station_id) = 1)
"""


def flag(name: str = "flagged", source: str = "cleaned", found: str = "lookup") -> str:
    filled = {
        f"{leg}_station_id": f"coalesce(c.{leg}_station_id, {leg[0]}.resolved_station_id)"
        for leg in ("start", "end")
    }
    columns = ", ".join(f"{filled.get(c, 'c.' + c)} AS {c}" for c in CLEAN_COLUMNS)
    return f"""
{name} AS (
  SELECT {columns},
    CASE WHEN c.ride_duration_minutes <= 0 THEN 'non_positive_duration'
      WHEN c.ride_duration_minutes >= 1440 THEN 'duration_exceeds_24h'
      WHEN c.start_lat IS NULL THEN 'missing_start_lat'
      WHEN c.start_lng IS NULL THEN 'missing_start_lng' END AS rejection_reason
  FROM {source} c
  LEFT JOIN {found} s ON c.start_station_name = s.station_name
  LEFT JOIN {found} e ON c.end_station_name = e.station_name)
"""


WEATHER = f"""
{latest('picked', '''(SELECT w.observation_time AS instant,
    ''' + _local('w.observation_time') + ''' AS observation_time,
    coalesce(w.temperature_c, 0) AS temperature_c, coalesce(w.precipitation_mm, 0) AS precipitation_mm,
    coalesce(w.wind_speed_kmh, 0) AS wind_speed_kmh, coalesce(w.weather_code, 0) AS weather_code,
    coalesce(w.is_daylight, false) AS is_daylight, w._ingested_at FROM weather_raw w)''',
    ['observation_time'], ['_ingested_at', 'instant'],
    ['observation_time', 'temperature_c', 'precipitation_mm', 'wind_speed_kmh', 'weather_code',
     'is_daylight', '_ingested_at'])},
weather AS (SELECT * FROM picked)
"""
SILVER = [TRIPS_RAW, dedup(), clean(), lookup(), flag()]
ACCEPTED = "accepted AS (SELECT * EXCLUDE (rejection_reason) FROM flagged WHERE rejection_reason IS NULL)"

# --- one row per key, silver -------------------------------------------------

LINE = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]
ORACLE["dedup_latest"] = with_(
    latest("d", "lineitem", ["l_orderkey", "l_linenumber"], ["l_shipdate"], LINE),
    select="SELECT * FROM d",
)
ORACLE["clean_trips"] = with_(TRIPS_RAW, dedup(), clean(), select="SELECT * FROM cleaned")
ORACLE["station_lookup"] = with_(
    TRIPS_RAW, dedup(), clean(), lookup(), select="SELECT * FROM lookup"
)
ORACLE["backfill"] = with_(
    *SILVER,
    select="SELECT ride_id, start_station_name, start_station_id, end_station_name, end_station_id FROM flagged",
)
ORACLE["silver_accepted"] = with_(*SILVER, ACCEPTED, select="SELECT * FROM accepted")
ORACLE["silver_rejected"] = with_(
    *SILVER, select="SELECT * FROM flagged WHERE rejection_reason IS NOT NULL"
)
ORACLE["rejection_summary"] = with_(
    *SILVER,
    select="""
SELECT coalesce(rejection_reason, 'accepted') AS reason, count(*) AS rides,
  count(*) FILTER (WHERE member_casual = 'member') AS members,
  """
    + mean("ride_duration_minutes")
    + """ AS mean_minutes FROM flagged GROUP BY 1""",
)
ORACLE["weather_hourly"] = with_(WEATHER_RAW, WEATHER, select="SELECT * FROM weather")
ORACLE["hourly_join"] = with_(
    TRIPS_RAW,
    dedup(),
    clean(),
    WEATHER_RAW,
    WEATHER,
    select="""
SELECT c.ride_id, c.started_at, w.temperature_c, w.weather_code FROM cleaned c
LEFT JOIN weather w ON date_trunc('hour', c.started_at) = w.observation_time""",
)


def haversine(lng1: str, lat1: str, lng2: str, lat2: str) -> str:
    return (
        f"2 * 6371.0::DOUBLE * asin(sqrt(pow(sin(radians({lat2} - {lat1}) / 2), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lng2} - {lng1}) / 2), 2)))"
    )


def ellipsoid(lng1: str, lat1: str, lng2: str, lat2: str) -> str:
    """Valid for points less than 13 degrees of longitude apart, as all of these are."""
    m = f"radians(({lat1} + {lat2}) / 2)"
    per_lat = f"(111.13209::DOUBLE - 0.56605::DOUBLE * cos(2 * {m}) + 0.00120::DOUBLE * cos(4 * {m}))"
    per_lng = (
        f"(111.41513::DOUBLE * cos({m}) - 0.09455::DOUBLE * cos(3 * {m}) "
        f"+ 0.00012::DOUBLE * cos(5 * {m}))"
    )
    return f"sqrt(pow({per_lat} * ({lat1} - {lat2}), 2) + pow({per_lng} * ({lng1} - {lng2}), 2))"


POINTS = ("start_lng", "start_lat", "end_lng", "end_lat")
ORACLE["geo_distance"] = with_(
    TRIPS_RAW,
    dedup(),
    select=f"""
SELECT ride_id, round({ellipsoid(*POINTS)}, 2) AS ellipsoid_km,
  round({haversine(*POINTS)}, 2) AS sphere_km FROM deduplicated""",
)

# --- dimensions, history, fact ----------------------------------------------


def calendar(start: str, as_of: str, last: str) -> str:
    return f"""
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
  CAST(year(d) AS INTEGER) AS "year", CAST(month(d) AS INTEGER) AS "month",
  CAST(day(d) AS INTEGER) AS "day", CAST(quarter(d) AS INTEGER) AS "quarter",
  CAST(week(d) AS INTEGER) AS week_of_year, CAST(isodow(d) AS INTEGER) AS day_of_week_num,
  strftime(d, '%A') AS day_name, strftime(d, '%B') AS month_name,
  CASE WHEN isodow(d) IN (6, 7) THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN month(d) IN (12, 1, 2) THEN 'Winter' WHEN month(d) IN (3, 4, 5) THEN 'Spring'
    WHEN month(d) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season
FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '{start}', TIMESTAMP '{as_of}' - INTERVAL 1 DAY,
  INTERVAL 1 DAY)) AS DATE) AS d) WHERE d <= ({last})"""


ORACLE["dim_date"] = calendar(
    "1990-01-01", "2010-01-01", "SELECT max(CAST(o_orderdate AS DATE)) FROM orders"
)
ORACLE["dim_label"] = """
SELECT md5(c_mktsegment) AS segment_key, c_mktsegment AS segment,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'Building' WHEN 'MACHINERY' THEN 'Machinery'
    WHEN 'HOUSEHOLD' THEN 'Household' ELSE 'Unknown' END AS segment_desc
FROM (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL)"""


def rider_types(source: str) -> str:
    return f"""
SELECT md5(t) AS rider_type_key, t AS rider_type,
  CASE t WHEN 'member' THEN 'Member' WHEN 'casual' THEN 'Casual' ELSE 'Unknown' END AS rider_type_desc
FROM (SELECT DISTINCT member_casual AS t FROM {source} WHERE member_casual IS NOT NULL)"""


def bike_types(source: str) -> str:
    return f"""
SELECT md5(t) AS bike_type_key, t AS bike_type,
  CASE t WHEN 'classic_bike' THEN 'Classic Bike' WHEN 'electric_bike' THEN 'Electric Bike'
    WHEN 'docked_bike' THEN 'Docked Bike' ELSE 'Unknown' END AS bike_type_desc
FROM (SELECT DISTINCT rideable_type AS t FROM {source} WHERE rideable_type IS NOT NULL)"""


ORACLE["dim_types"] = with_(
    TRIPS_RAW,
    clean(source="trips_raw"),
    select=f"""
SELECT rider_type_key AS type_key, rider_type AS "type", rider_type_desc AS type_desc
FROM ({rider_types("cleaned")})
UNION ALL SELECT bike_type_key, bike_type, bike_type_desc FROM ({bike_types("cleaned")})""",
)

# Snapshots as runs: a run ends when the key is missing from, or differs in, the
# next snapshot; a run is one version and keeps the columns of its first row.
YEARLY = [
    """
state AS (
  SELECT o_custkey, y, o_orderkey, o_orderpriority FROM (
    SELECT *, year(o_orderdate) AS y, row_number() OVER (PARTITION BY o_custkey, year(o_orderdate)
      ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1)""",
    """
starts AS (
  SELECT *, CASE WHEN lag(y) OVER w = y - 1 AND lag(o_orderpriority) OVER w = o_orderpriority
    THEN 0 ELSE 1 END AS opens FROM state WINDOW w AS (PARTITION BY o_custkey ORDER BY y))""",
    "runs AS (SELECT *, sum(opens) OVER (PARTITION BY o_custkey ORDER BY y) AS run FROM starts)",
    """
versions AS (
  SELECT o_custkey, arg_min(o_orderpriority, y) AS o_orderpriority,
    arg_min(o_orderkey, y) AS o_orderkey, min(y) AS y0, max(y) AS y1
  FROM runs GROUP BY o_custkey, run)""",
    """
history AS (
  SELECT o_custkey, o_orderpriority, o_orderkey,
    md5(o_custkey || '|' || (y0 + 1) || '-01-01 00:00:00.000000') AS dbt_scd_id,
    make_timestamp(y0 + 1, 1, 1, 0, 0, 0) AS dbt_updated_at,
    make_timestamp(y0 + 1, 1, 1, 0, 0, 0) AS dbt_valid_from,
    CASE WHEN y1 < (SELECT max(y) FROM state)
      THEN make_timestamp(y1 + 2, 1, 1, 0, 0, 0) END AS dbt_valid_to
  FROM versions)""",
]
ORACLE["scd2_history"] = with_(*YEARLY, select="SELECT * FROM history")
ORACLE["scd2_backdated"] = with_(
    *YEARLY,
    select="""
SELECT dbt_scd_id AS station_key, o_custkey AS station_id, o_orderpriority AS station_name,
  CAST(o_orderkey AS DOUBLE) AS latitude, 0.0::DOUBLE AS longitude,
  CASE WHEN dbt_valid_from = min(dbt_valid_from) OVER (PARTITION BY o_custkey)
    THEN TIMESTAMP '1970-01-01' ELSE dbt_valid_from END AS valid_from,
  dbt_valid_to AS valid_to, CASE WHEN dbt_valid_to IS NULL THEN 1 ELSE 0 END AS is_current
FROM history""",
)


def stations(name: str, source: str) -> str:
    legs = " UNION ALL ".join(
        f"SELECT {leg}_station_id AS station_id, {leg}_station_name AS station_name, {i} AS leg, "
        f"round(avg({leg}_lat), 6) AS latitude, round(avg({leg}_lng), 6) AS longitude "
        f"FROM {source} WHERE {leg}_station_id IS NOT NULL GROUP BY 1, 2"
        for i, leg in enumerate(("start", "end"))
    )
    return f"""
{name} AS (
  SELECT station_id, station_name, latitude, longitude FROM (
    SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY station_name ASC NULLS LAST, leg) AS rn
    FROM ({legs})) WHERE rn = 1)
"""


ORACLE["station_current"] = with_(
    *SILVER, ACCEPTED, stations("stations", "accepted"), select="SELECT * FROM stations"
)

STAMPS = ["2024-01-11 00:00:00", "2024-01-21 00:00:00", "2024-02-01 00:00:00"]
# A station once seen stays in every later snapshot, and the checked name is
# fixed by its id, but both are derived here rather than assumed.
STATION_HISTORY = [
    *[
        c
        for i, stamp in enumerate(STAMPS)
        for c in (
            f"seen{i} AS (SELECT * FROM accepted WHERE started_at < TIMESTAMP '{stamp}')",
            stations(f"snap{i}", f"seen{i}"),
        )
    ],
    "snaps AS ("
    + " UNION ALL ".join(
        f"SELECT {i} AS n, TIMESTAMP '{s}' AS stamp, * FROM snap{i}" for i, s in enumerate(STAMPS)
    )
    + ")",
    """
snap_starts AS (
  SELECT *, CASE WHEN lag(n) OVER w = n - 1 AND lag(station_name) OVER w IS NOT DISTINCT FROM station_name
    THEN 0 ELSE 1 END AS opens FROM snaps WINDOW w AS (PARTITION BY station_id ORDER BY n))""",
    "snap_runs AS (SELECT *, sum(opens) OVER (PARTITION BY station_id ORDER BY n) AS run FROM snap_starts)",
    f"""
station_history AS (
  SELECT station_id, first(station_name ORDER BY n) AS station_name,
    first(latitude ORDER BY n) AS latitude, first(longitude ORDER BY n) AS longitude,
    min(stamp) AS valid_from,
    CASE max(n) {" ".join(f"WHEN {i} THEN TIMESTAMP '{s}'" for i, s in enumerate(STAMPS[1:]))} END AS valid_to
  FROM snap_runs GROUP BY station_id, run)""",
    """
dim_station AS (
  SELECT md5(station_id || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f')) AS station_key,
    station_id, station_name, latitude, longitude,
    CASE WHEN valid_from = min(valid_from) OVER (PARTITION BY station_id)
      THEN TIMESTAMP '1970-01-01' ELSE valid_from END AS valid_from,
    valid_to, CASE WHEN valid_to IS NULL THEN 1 ELSE 0 END AS is_current
  FROM station_history)""",
]
ORACLE["dim_station"] = with_(*SILVER, ACCEPTED, *STATION_HISTORY, select="SELECT * FROM dim_station")

SHIPMENTS = [
    """
lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, o_custkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    """
versions AS (
  SELECT o_custkey AS k, o_orderdate, max(o_orderkey) AS asof_orderkey,
    arg_max(o_orderpriority, o_orderkey) AS asof_priority FROM orders GROUP BY 1, 2)""",
]
ORACLE["asof_join"] = with_(
    *SHIPMENTS,
    select="""
SELECT l.*, v.asof_orderkey, v.asof_priority FROM lines l
ASOF LEFT JOIN versions v ON l.o_custkey = v.k AND l.l_shipdate >= v.o_orderdate""",
)
ORACLE["asof_join_window"] = ORACLE["asof_join"]
ORACLE["asof_join_bounded"] = with_(
    *SHIPMENTS,
    select="""
SELECT l.*, CASE WHEN l.l_shipdate < v.o_orderdate + INTERVAL 60 DAYS THEN v.asof_orderkey END
  AS asof_orderkey FROM lines l
ASOF LEFT JOIN versions v ON l.o_custkey = v.k AND l.l_shipdate >= v.o_orderdate""",
)
FACT = [
    *SILVER,
    ACCEPTED,
    *STATION_HISTORY,
    WEATHER_RAW,
    WEATHER,
    f"dim_date AS ({calendar('2021-01-01', '2024-03-01', 'SELECT max(start_date) FROM accepted')})",
    f"dim_rider_type AS ({rider_types('accepted')})",
    f"dim_bike_type AS ({bike_types('accepted')})",
    f"""
fact_trips AS (
  SELECT md5(t.ride_id) AS trip_key, t.ride_id, dd.date_key, ds.station_key AS start_station_key,
    de.station_key AS end_station_key, dr.rider_type_key, db.bike_type_key, t.started_at, t.ended_at,
    t.ride_duration_minutes,
    round({ellipsoid("t.start_lng", "t.start_lat", "t.end_lng", "t.end_lat")}, 2) AS ride_distance_km,
    t.start_lat, t.start_lng, t.end_lat, t.end_lng, w.temperature_c, w.precipitation_mm,
    w.wind_speed_kmh, w.weather_code, w.is_daylight, t._source_file, t._ingested_at
  FROM (SELECT * FROM accepted WHERE start_station_id IS NOT NULL AND end_station_id IS NOT NULL) t
  LEFT JOIN dim_date dd ON t.start_date = dd.full_date
  ASOF LEFT JOIN dim_station ds ON t.start_station_id = ds.station_id AND t.started_at >= ds.valid_from
  ASOF LEFT JOIN dim_station de ON t.end_station_id = de.station_id AND t.started_at >= de.valid_from
  LEFT JOIN dim_rider_type dr ON t.member_casual = dr.rider_type
  LEFT JOIN dim_bike_type db ON t.rideable_type = db.bike_type
  LEFT JOIN weather w ON date_trunc('hour', t.started_at) = w.observation_time)""",
]
ORACLE["fact_build"] = with_(*FACT, select="SELECT * FROM fact_trips")
ORACLE["trip_report"] = with_(
    *FACT,
    select=f"""
SELECT dr.rider_type_desc, db.bike_type_desc, dd.is_weekend, count(*) AS rides,
  {mean("t.ride_duration_minutes")} AS mean_minutes, {mean("t.ride_distance_km")} AS mean_km,
  {mean("t.temperature_c")} AS mean_temperature
FROM fact_trips t JOIN dim_date dd ON t.date_key = dd.date_key
JOIN dim_rider_type dr ON t.rider_type_key = dr.rider_type_key
JOIN dim_bike_type db ON t.bike_type_key = db.bike_type_key
JOIN dim_station ds ON t.start_station_key = ds.station_key GROUP BY 1, 2, 3""",
)
ORACLE["star_query"] = f"""
SELECT n_name, c_mktsegment, count(*) AS orders, {mean("o_totalprice")} AS mean_price
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
WHERE lower(r_name) = 'asia' AND year(o_orderdate) = (SELECT year(max(o_orderdate)) FROM orders)
GROUP BY 1, 2"""

# --- incremental -------------------------------------------------------------

ORACLE["merge_upserts"] = """
SELECT o_orderkey, o_custkey, o_orderstatus,
  CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
  o_orderdate, o_orderpriority FROM orders"""
ORACLE["merge_partitions"] = ORACLE["merge_upserts"].replace(
    "o_orderpriority FROM", "o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS order_year FROM"
)
ORACLE["incremental_watermark"] = """
SELECT * FROM orders WHERE o_orderdate >
  (SELECT max(o_orderdate) FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01')"""
ORACLE["incremental_sources"] = with_(
    TRIPS_RAW, select="SELECT * FROM trips_raw WHERE _source_file >= 'm2'"
)
TWO_BATCHES = [
    TRIPS_RAW,
    "raw1 AS (SELECT * FROM trips_raw WHERE _source_file < 'm2')",
    "raw2 AS (SELECT * FROM trips_raw WHERE _source_file >= 'm2')",
    dedup("dedup1", "raw1"),
    clean("clean1", "dedup1"),
    lookup("lookup1", "clean1"),
    flag("target", "clean1", "lookup1"),
    dedup("dedup2", "raw2"),
    clean("clean2", "dedup2"),
    lookup("lookup2", "clean2", "target"),
    flag("batch", "clean2", "lookup2"),
    """
merged AS (
  SELECT * FROM target WHERE ride_id NOT IN (SELECT ride_id FROM batch)
  UNION ALL SELECT * FROM batch)""",
]
ORACLE["silver_incremental"] = with_(*TWO_BATCHES, select="SELECT * FROM merged")
ORACLE["late_file_merge"] = with_(TRIPS_RAW, dedup(), clean(), select="SELECT * FROM cleaned")
ORACLE["silver_refresh"] = with_(*SILVER, select="SELECT * FROM flagged")
ORACLE["incremental_equals_full"] = with_(
    *TWO_BATCHES,
    dedup(),
    clean(),
    lookup(),
    flag(),
    select="""
SELECT count(*) AS rides,
  count(*) FILTER (WHERE m.rejection_reason IS DISTINCT FROM f.rejection_reason) AS other_reason,
  count(*) FILTER (WHERE m.ride_duration_minutes IS DISTINCT FROM f.ride_duration_minutes) AS other_minutes,
  count(*) FILTER (WHERE m.start_station_id IS DISTINCT FROM f.start_station_id) AS other_start,
  count(*) FILTER (WHERE m.end_station_id IS DISTINCT FROM f.end_station_id) AS other_end
FROM merged m FULL JOIN flagged f ON m.ride_id = f.ride_id""",
)

# --- sources -----------------------------------------------------------------

ORACLE["manifest_scan"] = """
WITH wanted AS (SELECT page_id, url FROM pages WHERE url LIKE 'https://%' AND url LIKE '%.html')
SELECT page_id AS page, url AS "key" FROM wanted WHERE page_id >=
  (SELECT min(page_id) FROM wanted WHERE url = (SELECT min(url) FROM wanted))"""
ORACLE["new_sources"] = """
SELECT DISTINCT url AS "key" FROM pages WHERE url NOT LIKE 'http://%'"""
ORACLE["missing_dates"] = """
SELECT CAST(unnest(generate_series(CAST(m AS TIMESTAMP) + INTERVAL 1 DAY,
  TIMESTAMP '2024-03-01' - INTERVAL 5 DAY, INTERVAL 1 DAY)) AS DATE) AS "day"
FROM (SELECT CAST(max(ts) AS DATE) AS m FROM events)"""
ORACLE["json_unpack"] = " UNION ALL ".join(
    f"""
SELECT date_trunc('second', ts) + INTERVAL {i} HOURS AS observation_time,
  CAST({t} AS DOUBLE) AS temperature_c, CAST(NULL AS DOUBLE) AS precipitation_mm,
  CAST({w} AS DOUBLE) AS wind_speed_kmh, CAST({c} AS INTEGER) AS weather_code,
  CAST({d} AS BOOLEAN) AS is_daylight FROM events"""
    for i, (t, w, c, d) in enumerate(
        [
            ("value", "value", "1", "1"),
            ("value + 1", "0.0", "2", "0"),
            ("NULL", "0.5", "user_id % 100", "event_id % 2"),
        ]
    )
)
ORACLE["props_unpack"] = """
SELECT CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k, count(*) AS events
FROM events GROUP BY 1"""
# Text fields pass through CSV: an empty one comes back as NULL.
ORACLE["archive_scan"] = with_(
    TRIPS_RAW,
    select="SELECT "
    + ", ".join(
        f"nullif({c}, '') AS {c}" if c.endswith("station_id") else c
        for c in RAW_COLUMNS
        if not c.startswith("_")
    )
    + " FROM trips_raw",
)
ORACLE["csv_raw"] = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal,
  CASE c_mktsegment WHEN 'BUILDING' THEN 'NA' WHEN 'MACHINERY' THEN 'NULL' WHEN 'FURNITURE' THEN NULL
    ELSE ' ' || c_mktsegment || ',' || chr(10) || '"x"' END AS c_mktsegment,
  CAST(0 AS BIGINT) AS bad_rows FROM customer
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, CAST(2 * count(*) AS BIGINT) FROM customer"""
ORACLE["mixed_ts"] = """
SELECT o_orderkey, CASE WHEN o_orderpriority LIKE '5%' THEN NULL
  WHEN o_orderpriority LIKE '4%' AND o_orderkey % 2 = 0 THEN t - INTERVAL 2 HOURS ELSE t END AS parsed
FROM (SELECT *, o_orderdate + to_minutes(CAST(o_orderkey % 600 AS INTEGER)) AS t FROM orders)"""
ORACLE["refused_sources"] = with_(
    TRIPS_RAW,
    select="""
SELECT _source_file || '-' || start_station_name AS "source",
  CASE WHEN count(*) = count(start_lat) THEN count(*) ELSE 0 END AS row_count,
  count(*) - count(start_lat) AS bad_rows FROM trips_raw GROUP BY 1""",
)
ORACLE["contract_read"] = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(c_acctbal AS DECIMAL(12, 2)) AS c_acctbal,
  c_mktsegment FROM customer"""
ORACLE["drop_null_keys"] = """
SELECT *, c_mktsegment AS segment_key FROM customer WHERE c_mktsegment <> 'BUILDING'"""
ORACLE["bronze_load"] = with_(
    TRIPS_RAW,
    select="""
SELECT _source_file, count(*) AS row_count, count(DISTINCT ride_id) AS rides,
  TIMESTAMP '2024-03-02 00:00:00' AS ingested_at FROM trips_raw GROUP BY 1""",
)
ORACLE["stream_load"] = with_(TRIPS_RAW, dedup(), select="SELECT * FROM deduplicated")
ORACLE["sorted_write"] = "SELECT *, 'Key of the customer' AS key_comment FROM customer"

# --- quality -----------------------------------------------------------------


def check(kind: str, table: str, column: str, failing: str, *, severity: str = "error",
          observed: str | None = None) -> str:
    """One result row; ``failing`` is a scalar expression."""
    return f"""
SELECT '{kind}' AS check_name, '{table}' AS table_name, '{column}' AS column_name,
  '{severity}' AS severity, CAST(f AS BIGINT) AS failing_rows,
  CAST({observed or "f"} AS VARCHAR) AS observed, f = 0 AS passed FROM (SELECT {failing} AS f)"""


def nulls(table: str, column: str, kind: str = "not_null", severity: str = "error") -> str:
    failing = f"(SELECT count(*) - count({column}) FROM {table})"
    return check(kind, table, column, failing, severity=severity)


def repeated(table: str, column: str, severity: str = "error") -> str:
    failing = (
        f"(SELECT count(*) FROM (SELECT {column} FROM {table} WHERE {column} IS NOT NULL "
        f"GROUP BY 1 HAVING count(*) > 1))"
    )
    return check("unique", table, column, failing, severity=severity)


def outside(table: str, column: str, values: list[str], kind: str = "accepted_values",
            severity: str = "error") -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    failing = f"(SELECT count(*) FROM {table} WHERE {column} NOT IN ({listed}))"
    return check(kind, table, column, failing, severity=severity)


def orphans(table: str, column: str, parent: str, key: str, severity: str = "error") -> str:
    failing = (
        f"(SELECT count(*) FROM {table} WHERE {column} IS NOT NULL AND {column} NOT IN "
        f"(SELECT {key} FROM {parent} WHERE {key} IS NOT NULL))"
    )
    return check("relationships", table, column, failing, severity=severity)


def anomalies(table: str, column: str, ts: str, metric: str) -> str:
    value = {"null_count": "n", "null_percent": "n * 100.0 / c"}[metric]
    failing = f"""(
  SELECT count(*) FROM (
    SELECT v, count(v) OVER w AS p, avg(v) OVER w AS m, stddev_samp(v) OVER w AS s FROM (
      SELECT d, CAST({value} AS DOUBLE) AS v FROM (
        SELECT CAST({ts} AS DATE) AS d, count(*) AS c, count(*) - count({column}) AS n
        FROM {table} GROUP BY 1))
    WINDOW w AS (ORDER BY d ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING))
  WHERE p >= 7 AND s > 0 AND abs(v - m) / s > 3)"""
    return check("column_anomalies", table, column, failing, severity="warn")


ORACLE["check_not_null"] = " UNION ALL ".join(
    [
        check(
            "row_count",
            "orders",
            "",
            "CASE WHEN (SELECT count(*) FROM orders) = 0 THEN 1 ELSE 0 END",
            observed="(SELECT count(*) FROM orders)",
        ),
        nulls("orders", "o_orderkey"),
        nulls("orders", "o_custkey"),
        nulls("events", "ts", "missing_count"),
        nulls("events", "props", "missing_count", "warn"),
    ]
)
ORACLE["check_unique"] = " UNION ALL ".join(
    [
        repeated("orders", "o_orderkey"),
        repeated("customer", "c_custkey"),
        repeated("lineitem", "l_orderkey", "warn"),
    ]
)
ORACLE["check_accepted_values"] = " UNION ALL ".join(
    [
        outside("customer", "c_mktsegment", ["BUILDING", "MACHINERY"], severity="warn"),
        outside("orders", "o_orderstatus", ["O", "F", "P"]),
        outside("events", "event_type", ["view", "click", "signup", "purchase"], "invalid_count"),
    ]
)
ORACLE["check_relationships"] = " UNION ALL ".join(
    [
        orphans("orders", "o_custkey", "customer", "c_custkey"),
        orphans("lineitem", "l_orderkey", "orders", "o_orderkey"),
        orphans("events", "user_id", "nation", "n_nationkey", "warn"),
    ]
)
ORACLE["check_freshness"] = " UNION ALL ".join(
    check(
        "freshness",
        t,
        c,
        f"CASE WHEN TIMESTAMP '2024-02-15' - (SELECT max({c}) FROM {t}) < INTERVAL 40 DAYS THEN 0 ELSE 1 END",
        severity=s,
        observed=f"(SELECT strftime(max({c}), '%Y-%m-%d %H:%M:%S') FROM {t})",
    )
    for t, c, s in [("events", "ts", "error"), ("orders", "o_orderdate", "warn")]
)
ORACLE["orphan_keys"] = """
SELECT user_id, count(*) AS row_count FROM events
WHERE user_id NOT IN (SELECT n_nationkey FROM nation) GROUP BY 1"""
ORACLE["null_anomalies"] = with_(
    TRIPS_RAW,
    """
profile AS (
  SELECT CAST(started_at AS DATE) AS "day", count(*) AS row_count,
    count(*) - count(start_lat) AS null_count FROM trips_raw GROUP BY 1)""",
    'shares AS (SELECT *, null_count * 100.0::DOUBLE / row_count AS v FROM profile)',
    """
past AS (
  SELECT *, count(v) OVER w AS past_points, avg(v) OVER w AS past_mean, stddev_samp(v) OVER w AS past_stddev
  FROM shares WINDOW w AS (ORDER BY "day" ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING))""",
    """
scored AS (
  SELECT *, CASE WHEN past_points < 7 THEN NULL WHEN past_stddev = 0 THEN 0
    ELSE (v - past_mean) / past_stddev END AS score FROM past)""",
    select="""
SELECT "day", row_count, null_count, round(v, 6) AS null_percent, past_points,
  round(past_mean, 6) AS past_mean, round(past_stddev, 6) AS past_stddev, round(score, 4) AS score,
  coalesce(abs(score) > 3, false) AS anomalous FROM scored""",
)
BIKES = ["electric_bike", "classic_bike", "docked_bike"]
RIDERS = ["member", "casual"]
REASONS = [
    "non_positive_duration", "duration_exceeds_24h", "missing_start_lat", "missing_start_lng",
]


def _key(table: str, column: str) -> list[str]:
    return [nulls(table, column), repeated(table, column)]


ORACLE["layer_quality"] = with_(
    *FACT,
    "bronze_trips AS (SELECT * FROM trips_raw)",
    "bronze_weather AS (SELECT * FROM weather_raw)",
    "int_trips_cleaned AS (SELECT * FROM flagged)",
    "silver_trips AS (SELECT * FROM accepted)",
    "silver_trips_rejected AS (SELECT * FROM flagged WHERE rejection_reason IS NOT NULL)",
    "int_weather_cleaned AS (SELECT * FROM weather)",
    "silver_weather AS (SELECT * FROM weather)",
    select=" UNION ALL ".join(
        [
            nulls("bronze_trips", "ride_id"),
            nulls("bronze_weather", "observation_time"),
            *_key("int_trips_cleaned", "ride_id"),
            *_key("silver_trips", "ride_id"),
            *[
                nulls("silver_trips", c)
                for c in (
                    "rideable_type", "started_at", "ended_at", "ride_duration_minutes",
                    "start_lat", "start_lng", "member_casual",
                )
            ],
            outside("silver_trips", "rideable_type", BIKES),
            outside("silver_trips", "member_casual", RIDERS),
            anomalies("silver_trips", "ride_id", "started_at", "null_count"),
            anomalies("silver_trips", "ride_id", "started_at", "null_percent"),
            nulls("silver_trips_rejected", "ride_id"),
            nulls("silver_trips_rejected", "rejection_reason"),
            outside("silver_trips_rejected", "rejection_reason", REASONS),
            *_key("int_weather_cleaned", "observation_time"),
            *_key("silver_weather", "observation_time"),
            *_key("dim_date", "date_key"),
            nulls("dim_date", "full_date"),
            *_key("dim_station", "station_key"),
            nulls("dim_station", "station_id"),
            *_key("dim_rider_type", "rider_type_key"),
            outside("dim_rider_type", "rider_type", RIDERS),
            *_key("dim_bike_type", "bike_type_key"),
            outside("dim_bike_type", "bike_type", BIKES),
            *[
                nulls("fact_trips", c)
                for c in (
                    "trip_key", "ride_id", "date_key", "start_station_key", "end_station_key",
                    "rider_type_key", "bike_type_key",
                )
            ],
            orphans("fact_trips", "date_key", "dim_date", "date_key"),
            orphans("fact_trips", "start_station_key", "dim_station", "station_key"),
            orphans("fact_trips", "end_station_key", "dim_station", "station_key"),
            orphans("fact_trips", "rider_type_key", "dim_rider_type", "rider_type_key"),
            orphans("fact_trips", "bike_type_key", "dim_bike_type", "bike_type_key"),
        ]
    ),
)
ORACLE["gate_layers"] = f"""
SELECT layer, count(*) AS checks, bool_and(passed OR severity <> 'error') AS passed FROM (
  SELECT *, CASE WHEN table_name LIKE 'bronze%' THEN 'bronze'
    WHEN table_name LIKE 'dim%' OR table_name LIKE 'fact%' THEN 'gold' ELSE 'silver' END AS layer
  FROM ({ORACLE["layer_quality"]})) GROUP BY layer"""
ORACLE["reconciliation"] = with_(
    *FACT,
    select="""
SELECT cleaned, accepted, rejected, in_fact, accepted - in_fact AS unresolved,
  cleaned = accepted + rejected AS split_complete, in_fact <= accepted AS fact_within_accepted
FROM (SELECT count(*) AS cleaned, count(*) FILTER (WHERE rejection_reason IS NULL) AS accepted,
    count(rejection_reason) AS rejected, (SELECT count(*) FROM fact_trips) AS in_fact FROM flagged)""",
)

# --- analyst surface ---------------------------------------------------------

ORACLE["enum_values"] = " UNION ALL ".join(
    f"SELECT DISTINCT '{t}' AS table_name, '{c}' AS column_name, {c} AS \"value\" FROM {t}"
    for t, c in [
        ("customer", "c_mktsegment"), ("part", "p_brand"), ("part", "p_type"),
        ("orders", "o_orderpriority"),
    ]
)
ORACLE["coverage"] = "SELECT min(o_orderdate) AS min_value, max(o_orderdate) AS max_value FROM orders"
GOLD_TYPES = {
    "dim_date": "int date int int int int int int string string int string",
    "dim_station": "string string string double double timestamp_ntz timestamp_ntz int",
    "dim_rider_type": "string string string",
    "dim_bike_type": "string string string",
    "fact_trips": "string string int string string string string timestamp_ntz timestamp_ntz double double "
    "double double double double double double double int boolean string timestamp",
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


ORACLE["describe_gold"] = (
    "SELECT table_name, CAST(pos AS INTEGER) AS \"position\", column_name, data_type, \"comment\", table_comment FROM (VALUES "
    + ", ".join(
        f"('{t}', {n + 1}, '{c}', '{kind}', {_quoted(note)}, {_quoted(TABLE_DOCS[t])})"
        for t, kinds in GOLD_TYPES.items()
        for n, ((c, note), kind) in enumerate(zip(DOCS[t].items(), kinds.split(), strict=True))
    )
    + ') AS v(table_name, pos, column_name, data_type, "comment", table_comment)'
)
ORACLE["safe_sql"] = """
WITH found AS (
  SELECT o_orderpriority, o_custkey, count(*) AS orders, round(sum(o_totalprice), 2) AS total_price
  FROM orders GROUP BY 1, 2)
SELECT *, (SELECT count(*) FROM found) AS total, (SELECT count(*) FROM found) > 50 AS truncated
FROM found ORDER BY orders DESC, o_custkey, o_orderpriority LIMIT 50"""
WORDS = (
    "DROP|DELETE|UPDATE|INSERT|ALTER|TRUNCATE|CREATE|GRANT|REVOKE|ATTACH|DETACH|RENAME|OPTIMIZE|"
    "SYSTEM|KILL|SET"
)
EDGE = r"[^\p{L}\p{N}\p{M}_]"


def verdict(text: str) -> str:
    parts = f"list_filter(string_split({text}, ';'), lambda p: regexp_matches(p, '\\S'))"
    first = f"upper(ltrim({parts}[1], ' ' || chr(9) || chr(10) || chr(13)))"
    return f"""CASE WHEN len({parts}) <> 1 THEN 'not_single'
  WHEN NOT (starts_with({first}, 'SELECT') OR starts_with({first}, 'WITH')) THEN 'not_select'
  WHEN regexp_matches({first}, '(^|{EDGE})({WORDS})({EDGE}|$)') THEN 'not_read_only' ELSE 'ok' END"""


ORACLE["sql_guard_audit"] = f"""
SELECT conv_id, turn, {verdict("q")} AS verdict FROM (
  SELECT conv_id, turn, CASE WHEN role = 'user' THEN ' select ''' || text || ''' ;  '
    WHEN turn % 4 = 1 THEN 'WITH x AS (SELECT 1) ' || text || ' delete from x'
    WHEN turn % 4 = 3 THEN 'SELECT created_at, ' || text || '; drop table x' ELSE text END AS q
  FROM conversations)"""
ORACLE["document_guard_audit"] = f"""
SELECT {verdict("text")} AS verdict, count(*) AS texts FROM documents GROUP BY 1"""


def cosine(a: str, b: str) -> str:
    return (
        f"1 - list_dot_product({a}, {b}) / "
        f"(sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b})))"
    )


ORACLE["vector_topk"] = f"""
WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
q AS (SELECT e AS s FROM v ORDER BY vec_id LIMIT 1)
SELECT vec_id, label, round({cosine("e", "s")}, 6) AS distance FROM v, q
ORDER BY distance, vec_id LIMIT 3"""
ORACLE["vector_topk_batch"] = f"""
WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
q AS (SELECT min(vec_id) AS query_id, arg_min(e, vec_id) AS s FROM v GROUP BY label),
d AS (SELECT query_id, vec_id AS neighbour_id, round({cosine("e", "s")}, 6) AS distance FROM v, q)
SELECT query_id, CAST(neighbour_rank AS INTEGER) AS neighbour_rank, neighbour_id, distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS neighbour_rank
  FROM d) WHERE neighbour_rank <= 3"""
ORACLE["vector_distance"] = f"""
SELECT vec_id, round({cosine("a", "b")}, 6) AS distance FROM (
  SELECT vec_id, CAST(embedding[1:32] AS DOUBLE[]) AS a, CAST(embedding[33:64] AS DOUBLE[]) AS b
  FROM embeddings)"""
ORACLE["memory_append"] = f"""
SELECT md5(text || '|' || "source" || '|' || '{BASE_STAMP}') AS id, "source" AS "query",
  CAST(len(embedding) AS INTEGER) AS dimensions, TIMESTAMP '{BASE_STAMP}' AS created_at
FROM documents LEFT JOIN embeddings ON doc_id = vec_id"""
ORACLE["memory_recall"] = f"""
WITH v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, 'vector ' || vec_id AS question,
    md5('vector ' || vec_id || '|label ' || label || '|{BASE_STAMP}') AS id FROM embeddings),
q AS (SELECT arg_min(question, vec_id) AS query_id, arg_min(e, vec_id) AS s FROM v GROUP BY label),
d AS (SELECT query_id, id AS neighbour_id, round({cosine("e", "s")}, 6) AS distance FROM v, q)
SELECT query_id, CAST(neighbour_rank AS INTEGER) AS neighbour_rank, neighbour_id, distance FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS neighbour_rank
  FROM d) WHERE neighbour_rank <= 3"""

# --- small operators ---------------------------------------------------------

ORACLE["distinct_values_of"] = 'SELECT DISTINCT "source" FROM documents WHERE "source" IS NOT NULL'
ORACLE["cross_scalar_max"] = """
SELECT o_orderkey, round(o_totalprice / (SELECT max(o_totalprice) FROM orders), 6) AS share FROM orders"""
ORACLE["surrogate_keys"] = """
SELECT p_partkey, md5(p_partkey || '-' || coalesce(nullif(p_type, 'SMALL'),
    '_dbt_utils_surrogate_key_null_')) AS part_hash,
  CASE p_type WHEN 'SMALL' THEN 'Small' WHEN 'ECONOMY' THEN 'Economy' ELSE 'Unknown' END AS type_desc
FROM part"""
