"""Station history and incremental tables."""

from __future__ import annotations

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from strataflow.operators.key_summaries import may_hold, summarise
from strataflow.operators.incremental import incremental_scan, merge_upsert, new_keys
from strataflow.operators.scd2 import scd2_apply
from strataflow.plans import gold, silver
from strataflow.session import new_path, stage
from strataflow.sources.history import VersionHistory
from strataflow.sources.tables import TableStore, _children, path_exists, sorted_by, with_docs

T1, T2, T3, T4 = (dt.datetime(2024, m, 1) for m in (1, 2, 3, 4))


def state(spark, *rows):
    return spark.createDataFrame(rows, "station_id string, station_name string, latitude double, longitude double")


def versions(df):
    names = ["station_id", "station_name", "latitude", "dbt_valid_from", "dbt_valid_to"]
    return sorted((tuple(r) for r in df.select(names).collect()), key=str)


def test_scd2_life_of_stations(spark):
    h = scd2_apply(None, state(spark, ("a", "A", 1.0, 1.0), ("b", "B", 2.0, 2.0), ("n", None, 3.0, 3.0)),
                   "station_id", ["station_name"], T1)
    h = stage(h, "h")
    # a moves (not checked), b is renamed, c is new, n keeps its NULL name.
    h = stage(scd2_apply(h, state(spark, ("a", "A", 9.0, 9.0), ("b", "B2", 2.0, 2.0), ("c", "C", 4.0, 4.0), ("n", None, 3.0, 3.0)),
                         "station_id", ["station_name"], T2), "h")
    # a vanishes, n gets a name.
    h = stage(scd2_apply(h, state(spark, ("b", "B2", 2.0, 2.0), ("c", "C", 4.0, 4.0), ("n", "N", 3.0, 3.0)),
                         "station_id", ["station_name"], T3), "h")
    # a returns unchanged.
    h = scd2_apply(h, state(spark, ("a", "A", 9.0, 9.0), ("b", "B2", 2.0, 2.0), ("c", "C", 4.0, 4.0), ("n", "N", 3.0, 3.0)),
                   "station_id", ["station_name"], T4)
    assert versions(h) == sorted(
        [
            ("a", "A", 1.0, T1, T3),
            ("a", "A", 9.0, T4, None),
            ("b", "B", 2.0, T1, T2),
            ("b", "B2", 2.0, T2, None),
            ("c", "C", 4.0, T2, None),
            ("n", None, 3.0, T1, T3),
            ("n", "N", 3.0, T3, None),
        ],
        key=str,
    )
    assert h.select("dbt_scd_id").distinct().count() == 7

    dim = {(r.station_id, r.station_name, r.latitude): r for r in gold.dim_station(h).collect()}
    epoch = dt.datetime(1970, 1, 1)
    assert dim["a", "A", 1.0].valid_from == epoch and dim["a", "A", 1.0].is_current == 0
    assert dim["a", "A", 9.0].valid_from == T4 and dim["a", "A", 9.0].is_current == 1
    assert dim["b", "B2", 2.0].valid_from == T2


def test_scd2_repeated_snapshot_changes_nothing(spark):
    now = state(spark, ("a", "A", 1.0, 1.0))
    h = stage(scd2_apply(None, now, "station_id", ["station_name"], T1), "h")
    assert versions(scd2_apply(h, now, "station_id", ["station_name"], T2)) == versions(h)


def test_scd2_options(spark):
    h = stage(scd2_apply(None, state(spark, ("a", "A", 1.0, 1.0)), "station_id", ["station_name"], T1), "h")
    kept = scd2_apply(h, state(spark, ("b", "B", 1.0, 1.0)), "station_id", ["station_name"], T2, invalidate_hard_deletes=False)
    assert ("a", "A", 1.0, T1, None) in versions(kept)
    moved = scd2_apply(h, state(spark, ("a", "A", 5.0, 1.0)), "station_id", ["station_name", "latitude"], T2)
    assert len(versions(moved)) == 2


def rows(spark, *data):
    return spark.createDataFrame(data, "k string, v int, _source_file string, _ingested_at timestamp")


def test_incremental_scan_modes_and_the_late_file(spark):
    source = rows(spark, ("a", 1, "m1", T1), ("b", 2, "m2", T3), ("late", 3, "m0", T2))
    target = rows(spark, ("a", 1, "m1", T1), ("b", 2, "m2", T3))
    assert incremental_scan(source, None).count() == 3
    assert [r.k for r in incremental_scan(source, target).collect()] == ["late"]
    # Stamped before the newest loaded row: the watermark never sees it.
    assert incremental_scan(source, target, mode="watermark").count() == 0
    assert incremental_scan(source, target.limit(0), mode="watermark").count() == 3


def test_new_keys(spark):
    seen = spark.createDataFrame([("x",), ("y",), ("y",)], "key string")
    assert new_keys(None, seen, "key").count() == 2
    assert [r.key for r in new_keys(seen.where("key = 'x'"), seen, "key").collect()] == ["y"]


def test_merge_keeps_the_newer_row(spark):
    target = spark.createDataFrame([("a", 5, 2), ("b", 5, 1), ("c", 5, 1)], "k string, v int, at int")
    updates = spark.createDataFrame([("a", 9, 1), ("b", 9, 2), ("d", 9, 1)], "k string, v int, at int")
    got = {tuple(r) for r in merge_upsert(target, updates, ["k"], ["at"]).collect()}
    assert got == {("a", 5, 2), ("b", 9, 2), ("c", 5, 1), ("d", 9, 1)}


def test_snapshots_do_not_go_back(spark):
    now = spark.createDataFrame([("s", "Oak")], "station_id string, station_name string")
    renamed = spark.createDataFrame([("s", "Elm")], "station_id string, station_name string")
    history = scd2_apply(None, now, "station_id", ["station_name"], "2024-01-02 00:00:00")
    same = scd2_apply(history, renamed, "station_id", ["station_name"], "2024-01-02 00:00:00")
    assert [(r.station_name, r.dbt_valid_from, r.dbt_valid_to) for r in same.collect()] == [("Elm", dt.datetime(2024, 1, 2), None)]
    later = scd2_apply(history, renamed, "station_id", ["station_name"], "2024-01-03 00:00:00")
    again = scd2_apply(later, now, "station_id", ["station_name"], "2024-01-03 00:00:00")
    assert [tuple(r) for r in again.collect()] == [tuple(r) for r in history.collect()]
    assert scd2_apply(later, renamed, "station_id", ["station_name"], "2024-01-03 00:00:00").count() == 2
    with pytest.raises(ValueError, match="after 2024-01-01"):
        scd2_apply(history, renamed, "station_id", ["station_name"], "2024-01-01 00:00:00")


def test_merge_upsert(spark):
    target, updates = rows(spark, ("a", 1, "m", T1), ("b", 1, "m", T1)), rows(spark, ("b", 2, "n", T2), ("c", 2, "n", T2))
    got = {(r.k, r.v) for r in merge_upsert(target, updates, ["k"]).collect()}
    assert got == {("a", 1), ("b", 2), ("c", 2)}
    assert merge_upsert(None, updates, ["k"]).count() == 2


def parts(spark, *data):
    return spark.createDataFrame(data, "k string, v int, month int")


def test_merge_rewrites_only_touched_partitions(spark):
    store = TableStore(spark, new_path(spark, "merge-test"))
    store.merge("t", parts(spark, ("a", 1, 1), ("b", 1, 2), ("c", 1, 3), ("n", 1, None)), ["k"], partition_by="month")

    def files():
        return {f for f in store.read("t").inputFiles()}

    before = files()
    # b moves from month 2, which it leaves empty, to 4; n leaves the NULL month.
    store.merge("t", parts(spark, ("b", 2, 4), ("n", 2, 4)), ["k"], partition_by="month")
    got = {(r.k, r.v, r.month) for r in store.read("t").collect()}
    assert got == {("a", 1, 1), ("c", 1, 3), ("b", 2, 4), ("n", 2, 4)}
    untouched = {f for f in before if "month=1" in f or "month=3" in f}
    assert len(untouched) == 2 and untouched <= files()
    # The same batch again changes nothing.
    store.merge("t", parts(spark, ("b", 2, 4), ("n", 2, 4)), ["k"], partition_by="month")
    assert {(r.k, r.v, r.month) for r in store.read("t").collect()} == got


def test_merge_of_new_keys_opens_no_partition(spark):
    store = TableStore(spark, new_path(spark, "filters"))
    rows = [(f"k{n:05d}", n, n % 5 if n % 7 else None) for n in range(3000)]
    store.merge("t", parts(spark, *rows), ["k"], partition_by="month")

    def opened(updates):
        found = store.touched("t", store.read("t"), updates, ["k"], "month")
        plan = found._jdf.queryExecution().executedPlan().toString()
        scans = [s.split("PartitionFilters: ")[1].split("PushedFilters")[0] for s in plan.split("FileScan")[1:]]
        filters = {f for s in scans for f in re.findall(r"month#\d+ (?:= |IN \()([\d,]+)", s)}
        return filters, {r.month for r in found.collect()}

    assert opened(parts(spark, *[(f"new{n}", 0, 3) for n in range(50)])) == (set(), {3})
    # Keys inside the bounds of every partition, in none of them.
    assert opened(parts(spark, *[(f"k{n:05d}x", 0, 1) for n in range(0, 3000, 60)])) == (set(), {1})
    files, touched = opened(parts(spark, ("k00003", 1, 4)))
    assert touched == {3, 4} and files == {"3"}
    assert opened(parts(spark, ("k00007", 1, 0)))[1] == {None, 0}

    # Filters follow merges; a partition without one is opened.
    store.merge("t", parts(spark, ("k00003", 1, 4), ("late", 1, 2)), ["k"], partition_by="month")
    assert opened(parts(spark, ("k00003", 2, 4)))[1] == {4} and opened(parts(spark, ("late", 2, 2)))[1] == {2}
    store._delete(f"{store._summary_root('t')}/_part=2")
    assert opened(parts(spark, ("none at all", 1, 0))) == ({"2"}, {0})
    store.append("t", parts(spark, ("added", 1, 1)).limit(0))
    assert not path_exists(spark, store._summary_root("t"))


def test_filters_never_miss_a_key(spark):
    rows = spark.range(4000).select(F.concat(F.lit("id"), "id").alias("a"), (F.col("id") % 3).alias("b"), (F.col("id") % 4).alias("p"))
    found = summarise(rows, ["a", "b"], "p")
    for p in range(4):
        own = rows.where(F.col("p") == p)
        assert str(p) in may_hold(found, own, ["a", "b"])
        assert may_hold(found, own.withColumn("b", F.col("b") + 5).limit(300), ["a", "b"]) == []
    assert may_hold(found.limit(0), rows, ["a", "b"]) == []


def test_merge_that_died_is_finished_later(spark, monkeypatch):
    store = TableStore(spark, new_path(spark, "died"))
    store.merge("t", parts(spark, ("a", 1, 1), ("b", 1, 2)), ["k"], partition_by="month")
    finish = TableStore.recover

    def die(self, name):
        if path_exists(spark, f"{self._pending(name)}/rows/_SUCCESS"):
            raise KeyboardInterrupt

    monkeypatch.setattr(TableStore, "recover", die)
    with pytest.raises(KeyboardInterrupt):
        store.merge("t", parts(spark, ("b", 2, 3)), ["k"], partition_by="month")
    monkeypatch.setattr(TableStore, "recover", finish)
    # Worst moment: the old partition is gone, the new one not yet there.
    store._delete(f"{store.path('t')}/month=2")
    store.merge("t", parts(spark, ("c", 1, 1)), ["k"], partition_by="month")
    assert {(r.k, r.v, r.month) for r in store.read("t").collect()} == {("a", 1, 1), ("b", 2, 3), ("c", 1, 1)}
    assert not path_exists(spark, store._pending("t"))


def test_versions_switch_when_complete(spark):
    store = TableStore(spark, new_path(spark, "versions"))
    assert store.read_or_none("t") is None
    with pytest.raises(FileNotFoundError):
        store.read("t")
    store.write("t", spark.range(3).toDF("n"))
    old = store.read("t")
    store.write("t", old.withColumn("n", F.col("n") + 10))
    assert sorted(r.n for r in store.read("t").collect()) == [10, 11, 12]
    assert sorted(r.n for r in old.collect()) == [0, 1, 2]

    # An unfinished version is not seen.
    broken = spark.range(1).withColumn("n", F.raise_error(F.lit("stop")).cast("bigint")).select("n")
    with pytest.raises(Exception, match="stop"):
        store.write("t", broken)
    assert sorted(r.n for r in store.read("t").collect()) == [10, 11, 12]
    store.write("t", spark.range(1).toDF("n"))
    store.drop_old("t", keep=1)
    assert [f for f in _children(spark, f"{store.root}/t") if f.startswith("v")] == ["v4"]
    assert store.read("t").count() == 1 and store.register("t", "t_view").count() == 1


def test_sorted_write_splits_a_hot_key_and_keeps_docs(spark):
    df = spark.range(4000).select(F.lit(1).alias("k"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = sorted_by(df, ["k"]).groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spread) > 1 and max(r["count"] for r in spread) < 3000
    store = TableStore(spark, new_path(spark, "docs"))
    store.write("t", df, sort=["k"], docs={"k": "The key"})
    assert store.read("t").schema["k"].metadata == {"comment": "The key"}
    assert with_docs(df, {}).schema == df.schema


def files_under(spark, path):
    out = set()
    for child in _children(spark, path):
        inner = files_under(spark, f"{path}/{child}") if "." not in child else set()
        out |= {f"{child}/{f}" for f in inner} if inner else {child}
    return out


def test_snapshots_write_what_changed(spark):
    store = TableStore(spark, new_path(spark, "deltas"))
    history = VersionHistory(store, "h", "station_id", ["station_name"])
    many = [(f"s{i}", f"N{i}", 1.0, 1.0) for i in range(500)]
    states = [
        (T1, many),
        (T2, [("s0", "other", 1.0, 1.0), *many[1:]]),
        (T3, many[1:]),
        (T4, many),
    ]
    plain = None
    for at, now in states:
        before = files_under(spark, store.root)
        current = state(spark, *now)
        got = history.snapshot(current, at)
        plain = stage(scd2_apply(plain, current, "station_id", ["station_name"], at), "plain")
        assert versions(got) == versions(plain)
        assert before <= files_under(spark, store.root)
    assert len(store._versions("h")) == 1 and len(history._deltas()) == 3
    held = spark.read.parquet(*[history._path(*d) for d in history._deltas()])
    assert held.count() == 2 + 1 + 1

    # The newest again, with another outcome; without changes nothing is written.
    moved = state(spark, ("s0", "third", 1.0, 1.0), *many[1:])
    history.snapshot(moved, T4)
    plain = stage(scd2_apply(plain, moved, "station_id", ["station_name"], T4), "plain")
    assert versions(history.read()) == versions(plain)
    before = files_under(spark, store.root)
    history.snapshot(moved, dt.datetime(2024, 5, 1))
    assert files_under(spark, store.root) == before
    with pytest.raises(ValueError):
        history.snapshot(moved, T3)

    # Folded into a new base, it reads the same, and the newest can still be taken again.
    history.compact()
    assert history._deltas() == [] and versions(history.read()) == versions(plain)
    assert versions(history.snapshot(state(spark, *many), T4)) == versions(
        scd2_apply(plain, state(spark, *many), "station_id", ["station_name"], T4)
    )
    with pytest.raises(ValueError):
        history.snapshot(moved, T2)
    store.drop_old("h", 1)
    assert history.read().count() == 502


def test_deltas_larger_than_the_base_are_folded(spark):
    store = TableStore(spark, new_path(spark, "deltas"))
    history = VersionHistory(store, "h", "station_id", ["station_name"], most_deltas=3)
    for k, at in enumerate((T1, T2, T3, T4)):
        history.snapshot(state(spark, *[(f"s{i}", f"N{k if i < 1 else 0}", 1.0, 1.0) for i in range(40)]), at)
    assert len(store._versions("h")) == 2 and history._deltas() == []
    assert history.read().count() == 43
    history.snapshot(state(spark, *[(f"s{i}", "all", 1.0, 1.0) for i in range(40)]), dt.datetime(2024, 5, 1))
    assert len(store._versions("h")) == 3 and history.read().count() == 83


def test_pairs_follow_replaced_rides(spark):
    store = TableStore(spark, new_path(spark, "pairs"))
    schema = (
        "ride_id string, start_month int, start_station_name string, start_station_id string, "
        "end_station_name string, end_station_id string"
    )

    def merge(*rides):
        store.merge("t", spark.createDataFrame(rides, schema), ["ride_id"], partition_by="start_month")

    def counts():
        view = store.partition_view("t", "pairs", "start_month", silver.pair_counts)
        return {(r[0], r[1]): r[2] for r in view.groupBy("station_name", "station_id").agg(F.sum("rides")).collect()}

    merge(("a", 1, "Oak", "S1", "Elm", "S2"), ("b", 1, "Oak", "S1", None, None), ("c", 2, "Oak", "S1", "Oak", "S1"))
    assert counts() == {("Oak", "S1"): 4, ("Elm", "S2"): 1, (None, None): 1}
    root = f"{store._views_root('t')}/pairs"
    old = {p: files_under(spark, f"{root}/{p}") for p in _children(spark, root) if "=" in p}
    # a is renamed, b moves to a new month without names, NULL included; month 2 is left alone.
    merge(("a", 1, "Oak", "S9", None, None), ("b", None, None, None, None, None))
    assert set(_children(spark, root)) & set(old) == {"_part=2"}
    assert counts() == {("Oak", "S9"): 1, ("Oak", "S1"): 2, (None, None): 3}
    new = {p: files_under(spark, f"{root}/{p}") for p in _children(spark, root) if "=" in p}
    assert set(new) == {"_part=1", "_part=2", "_part=__HIVE_DEFAULT_PARTITION__"} and new["_part=2"] == old["_part=2"]
    # Ambiguous names are known without a look at the rides.
    batch = spark.createDataFrame([("d", 3, "Oak", None, "Ash", "S3")], schema)
    view = store.partition_view("t", "pairs", "start_month", silver.pair_counts)
    lookup = silver.station_lookup(batch, known=view)
    assert [tuple(r) for r in lookup.collect()] == [("Ash", "S3")]
    assert all(f"{store.root}/_views" in f for f in lookup.inputFiles())
