"""Joins.

No side is broadcast blindly.  Lookups are expected as written tables, whose
size Spark knows: below ``spark.sql.autoBroadcastJoinThreshold`` it broadcasts
them, above it shuffles, and adaptive execution splits the skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strataflow.operators.windows import keep_latest
from strataflow.session import stage

MICROS_PER_DAY = 86_400_000_000


def lookup_left(
    df: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, str],
    values: Mapping[str, str],
) -> DataFrame:
    """Left join to a lookup that is unique on its key.

    ``on`` maps columns of ``df`` to key columns of the lookup, ``values`` maps
    columns of the lookup to output names.
    """
    keys = {left: f"_key_{i}" for i, left in enumerate(on)}
    right = lookup.select(
        *[F.col(on[left]).alias(tmp) for left, tmp in keys.items()],
        *[F.col(c).alias(name) for c, name in values.items()],
    )
    conditions = [F.col(left) == F.col(tmp) for left, tmp in keys.items()]
    return df.join(right, conditions, "left").drop(*keys.values())


def lookup_on(df: DataFrame, lookup: DataFrame, key: Column, on: str, values: Mapping[str, str]):
    """``lookup_left`` on a derived key, such as the hour of a timestamp."""
    probe = df.withColumn("_probe", key)
    return lookup_left(probe, lookup, {"_probe": on}, values).drop("_probe")


def missing_in(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Keys of the child that the parent lacks, with their number of rows.

    Child rows are counted by key first, so the anti join sees each key once
    however many rows share it.  NULL keys are not references and are left out.
    """
    counted = (
        child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    )
    parents = parent.select(F.col(parent_key).alias(key)).distinct()
    return counted.join(parents, key, "left_anti")


def cross_scalar(df: DataFrame, one_row: DataFrame, name: str) -> DataFrame:
    """Add the single value held by ``one_row`` to every row, as a subquery."""
    return df.withColumn(name, one_row.scalar())


def star(fact: DataFrame, dims: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Inner star join: for each ``(dimension, fact key, dimension key)``.

    The dimension's key takes the fact's name, so it appears once.
    """
    out = fact
    for dim, fact_key, dim_key in dims:
        out = out.join(dim.withColumnRenamed(dim_key, fact_key), fact_key)
    return out


@dataclass(frozen=True)
class Versions:
    """The right side of as-of joins, prepared once for any number of them.

    ``rows`` hold ``_k``, ``_from`` and the payload, one row per key and time.
    ``cut``, if they are small enough to broadcast, are their intervals cut by
    stretches of ``width`` microseconds between ``first`` and ``last``.
    """

    rows: DataFrame
    payload: tuple[str, ...]
    valid_to: str | None
    cut: DataFrame | None = None
    first: int = 0
    last: int = 0
    width: int = 1


def asof_versions(
    right: DataFrame,
    key: str,
    ts: str,
    columns: Sequence[str],
    *,
    valid_to: str | None = None,
    unique: bool = False,
    strategy: str = "auto",
    max_broadcast_bytes: int = 64 << 20,
) -> Versions:
    """Prepare the versions of each ``key``, in force from ``ts`` on, for ``asof_left``."""
    payload = tuple(dict.fromkeys([*columns, *([valid_to] if valid_to else [])]))
    rows = right.select(
        F.col(key).alias("_k"), F.col(ts).alias("_from"), *[F.col(c).alias(f"_v_{c}") for c in payload]
    ).where(F.col("_k").isNotNull() & F.col("_from").isNotNull())
    if not unique:
        rows = keep_latest(rows, ["_k", "_from"], [])
    if strategy not in ("auto", "range", "window"):
        raise ValueError(f"unknown as-of strategy: {strategy}")
    versions = Versions(rows, payload, valid_to)
    if strategy == "window":
        return versions
    versions = _cut_intervals(versions, max_broadcast_bytes)
    if versions.cut is None and strategy == "range":
        raise ValueError(f"the versions take more than {max_broadcast_bytes} bytes")
    return versions


def asof_left(
    left: DataFrame,
    right: DataFrame | Versions,
    key: Mapping[str, str],
    left_ts: str,
    right_ts: str,
    values: Mapping[str, str],
    *,
    valid_to: str | None = None,
    unique: bool = False,
    strategy: str = "auto",
    max_broadcast_bytes: int = 64 << 20,
    bucket_days: float = 30.0,
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """Left as-of join: for each left row, the version of its key in force.

    That is the row with the latest ``right_ts`` at or before ``left_ts``; left
    rows without one keep NULLs.  ``key`` maps the one key column of the left
    to that of the right, ``values`` maps right columns to output names.  With
    ``valid_to``, a version that has ended matches no longer.  Unless the right
    side is declared ``unique`` on key and time, ties are settled first.
    ``right`` may be prepared by ``asof_versions``, so that several joins share
    one table of intervals; what describes the right side is then taken from it.

    Two plans, chosen by the measured size of the right side:

    * ``range``: the versions fit a broadcast.  Each gets the start of the next
      one, and is cut by stretches of time; the left side is joined to these
      intervals by key, stretch and range without being shuffled, so its skew
      does not matter, and a key with very many versions costs its rows those of
      one stretch only.  The size is that of the cut intervals, from their
      number and the width of their columns.
      Asked for by name, it is refused above ``max_broadcast_bytes``.
    * ``window``: more than that.  Both sides are sorted together by key and
      time, and each left row takes the last version before it.  Work is split
      by key and stretch of ``bucket_days``; stretches that hold more than
      ``hot_rows`` rows of both sides together are cut at quantiles of the times
      of both, so that a piece holds a like share of left rows and versions
      whichever of them is hot.  A piece starts with the version carried over
      from earlier ones.  Both sides are read more than once, so they should be
      tables rather than costly results.
    """
    if len(key) != 1:
        raise ValueError("an as-of join takes exactly one key column")
    ((left_key, right_key),) = key.items()
    if not isinstance(right, Versions):
        right = asof_versions(
            right, right_key, right_ts, list(values), valid_to=valid_to, unique=unique,
            strategy=strategy, max_broadcast_bytes=max_broadcast_bytes,
        )
    if right.cut is not None and strategy != "window":
        out = _asof_range(left, right, left_key, left_ts)
    else:
        out = _asof_window(left, right, left_key, left_ts, bucket_days, hot_rows)
    found = {name: F.col(f"_v_{c}") for c, name in values.items()}
    if right.valid_to:
        ended = F.col(f"_v_{right.valid_to}") <= F.col(left_ts)
        found = {name: F.when(ended, None).otherwise(c) for name, c in found.items()}
    return out.select(*left.columns, *[c.alias(name) for name, c in found.items()])


def _row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row in a hash table: eight a column, and the text of strings."""
    total = F.lit(24 + 8 * len(df.columns))
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            total = total + F.coalesce(F.octet_length(c), F.lit(0))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            total = total + F.coalesce(F.length(F.to_json(F.struct(c))), F.lit(0))
    return total


def _micros(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def _stretch(c: str, first: int, last: int, width: int) -> Column:
    """The stretch an instant is in; what lies before or after belongs to the outer ones."""
    inside = F.least(F.greatest(_micros(c), F.lit(first)), F.lit(last))
    return F.when(F.col(c).isNotNull(), F.floor((inside - F.lit(first)) / F.lit(width)))


def _cut_intervals(versions: Versions, max_bytes: int) -> Versions:
    """With the cut intervals, if these take no more than ``max_bytes``.

    Time is cut into equal stretches between the first change and the last, four
    for each version an average key has, so that the cut intervals are at most
    about five times as many.
    """
    until = F.lead("_from").over(Window.partitionBy("_k").orderBy("_from"))
    intervals = stage(versions.rows.withColumn("_until", until), "asof-intervals")
    seen = intervals.agg(
        F.min(_micros("_until")).alias("first"),
        F.max(_micros("_from")).alias("last"),
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("_k").alias("keys"),
        F.coalesce(F.sum(_row_bytes(intervals)), F.lit(0)).alias("bytes"),
    ).first()
    rows = intervals.select(versions.rows.columns)
    if seen.bytes > max_bytes:
        return replace(versions, rows=rows)
    first, last = seen.first or 0, seen.last or 0
    count = -(-4 * seen.rows // max(1, seen.keys))
    width = max(1, -(-(last - first) // max(1, count)))
    end = F.coalesce(_stretch("_until", first, last, width), F.floor(F.lit((last - first) // width)))
    spans = intervals.withColumns({"_b": _stretch("_from", first, last, width), "_end": end})
    # Each stretch an interval reaches into is a row: known before any of them is made.
    size = spans.agg(F.sum(_row_bytes(intervals) * (F.col("_end") - F.col("_b") + 1))).first()[0] or 0
    if size > max_bytes:
        return replace(versions, rows=rows)
    cut = spans.withColumn("_b", F.explode(F.sequence("_b", "_end"))).drop("_end")
    return replace(versions, rows=rows, cut=cut, first=first, last=last, width=width)


def _asof_range(left: DataFrame, versions: Versions, key: str, ts: str) -> DataFrame:
    """Join to the broadcast cut intervals."""
    in_force = (
        (F.col(key) == F.col("_k"))
        & (_stretch(ts, versions.first, versions.last, versions.width) == F.col("_b"))
        & (F.col(ts) >= F.col("_from"))
        & (F.col("_until").isNull() | (F.col(ts) < F.col("_until")))
    )
    return left.join(F.broadcast(versions.cut), in_force, "left")


#: Quantiles at which a hot stretch may be cut.
QUANTILES = 256


def _with_pieces(rows: DataFrame, cuts: DataFrame | None) -> DataFrame:
    """``_p``, the piece of its stretch a row falls into: the cuts at or before it."""
    if cuts is None:
        return rows.withColumn("_p", F.lit(0))
    piece = F.size(F.filter("_cuts", lambda c: c <= F.col("_us")))
    return (
        rows.withColumn("_us", _micros("_t")).join(cuts, ["_k", "_b"], "left")
        .withColumn("_p", F.when(F.col("_cuts").isNull(), 0).otherwise(piece)).drop("_cuts", "_us")
    )


def _equal_cuts(times: DataFrame, hot_rows: int) -> DataFrame | None:
    """Cuts of the stretches ``(_k, _b)`` that hold more than ``hot_rows`` of ``times``; None if none does.

    ``times`` holds the rows of both sides, so a piece has a like share of their
    sum.  A stretch gets as many pieces as it has ``hot_rows``, 256 at most.
    """
    groups = times.groupBy("_k", "_b").agg(F.count(F.lit(1)).alias("_n"))
    hot = stage(groups.where(F.col("_n") > hot_rows), "asof-hot")
    if hot.isEmpty():
        return None
    every = [k / QUANTILES for k in range(1, QUANTILES)]
    found = (
        times.join(hot, ["_k", "_b"]).groupBy("_k", "_b", "_n")
        .agg(F.percentile_approx(_micros("_t"), every, 20 * QUANTILES).alias("_q"))
    )
    pieces = F.least(F.ceil(F.col("_n") / F.lit(hot_rows)), F.lit(QUANTILES))
    nth = F.transform(
        F.sequence(F.lit(1).cast("bigint"), pieces - 1),
        lambda k: F.element_at("_q", F.greatest(F.round(k * QUANTILES / pieces), F.lit(1)).cast("int")),
    )
    return stage(found.select("_k", "_b", F.array_distinct(nth).alias("_cuts")), "asof-cuts")


def _asof_window(
    left: DataFrame, versions: Versions, key: str, ts: str, bucket_days: float, hot_rows: int
) -> DataFrame:
    width = int(bucket_days * MICROS_PER_DAY)
    payload = [f"_v_{c}" for c in versions.payload]

    def stretch(c: str) -> Column:
        return F.floor(_micros(c) / F.lit(width))

    probes = left.select(
        F.col(key).alias("_k"),
        F.col(ts).alias("_t"),
        stretch(ts).alias("_b"),
        F.struct(*[F.col(c) for c in left.columns]).alias("_row"),
    )
    events = versions.rows.select(
        "_k",
        F.col("_from").alias("_t"),
        stretch("_from").alias("_b"),
        F.struct(F.col("_from"), *[F.col(c) for c in payload]).alias("_version"),
    )
    matched = F.col("_k").isNotNull() & F.col("_t").isNotNull()
    times = probes.where(matched).select("_k", "_b", "_t").unionByName(events.select("_k", "_b", "_t"))
    cuts = _equal_cuts(times, hot_rows)
    probes, events = _with_pieces(probes, cuts), _with_pieces(events, cuts)
    piece = ["_k", "_b", "_p"]

    # One row per piece that has left rows: needed for the carried versions and
    # to find what cuts cannot part, so it is computed once.
    groups = stage(
        probes.where(matched).groupBy(*piece).agg(F.count(F.lit(1)).alias("_n")), "asof-groups"
    )
    last_of_piece = events.groupBy(*piece).agg(F.max("_version").alias("_version"))
    marks = groups.select(*piece, F.lit(0).alias("_kind")).unionByName(
        last_of_piece.withColumn("_kind", F.lit(1)), allowMissingColumns=True
    )
    earlier = Window.partitionBy("_k").orderBy("_b", "_p", "_kind")
    carried = (
        marks.withColumn("_version", F.last("_version", ignorenulls=True).over(earlier))
        .where("_kind = 0 AND _version IS NOT NULL")
        .select("_k", F.col("_version._from").alias("_t"), "_b", "_p", "_version")
    )
    events = events.unionByName(carried)

    # A NULL key or time matches nothing; such rows are spread out instead of
    # meeting in one group.  Row copies are spread by the partition they are in.
    spread = F.xxhash64(F.spark_partition_id(), "_row")
    # Left rows of one instant cannot be cut: they are dealt out with copies of
    # the few versions of their piece.
    hot = stage(
        groups.where(F.col("_n") > 2 * hot_rows).select(*piece, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("bigint").alias("_parts")),
        "asof-crowded",
    )
    if hot.isEmpty():
        probes = probes.withColumn("_s", F.when(matched, 0).otherwise(F.pmod(spread, F.lit(1024))))
        events = events.withColumn("_s", F.lit(0).cast("bigint"))
    else:
        parts = F.coalesce("_parts", F.lit(1))
        probes = (
            probes.join(hot, piece, "left")
            .withColumn("_s", F.pmod(spread, F.when(matched, parts).otherwise(1024)))
            .drop("_parts")
        )
        copies = F.sequence(F.lit(0).cast("bigint"), parts - 1)
        events = events.join(hot, piece, "left").withColumn("_s", F.explode(copies)).drop("_parts")

    timeline = (
        events.withColumn("_side", F.lit(0))
        .unionByName(probes.withColumn("_side", F.lit(1)), allowMissingColumns=True)
        .withColumn(
            "_version",
            F.last("_version", ignorenulls=True).over(
                Window.partitionBy(*piece, "_s").orderBy("_t", "_side")
            ),
        )
    )
    return timeline.where("_side = 1").select(
        "_row.*", *[F.col(f"_version.{c}").alias(c) for c in payload]
    )
