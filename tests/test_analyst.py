from __future__ import annotations

import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from strataflow.operators import analyst as a
from strataflow.operators.vectors import nearest, nearest_batch, remember
from strataflow.session import new_path
from strataflow.sources.tables import TableStore, with_docs

TEXTS = [
    ("SELECT 1; SELECT 2", a.NOT_SINGLE),
    ("   ", a.NOT_SINGLE),
    ("", a.NOT_SINGLE),
    ("SELECT 1;", None),
    (" ; SELECT 1 ; ; ", None),
    ("EXPLAIN SELECT 1", a.NOT_SELECT),
    ("(SELECT 1)", a.NOT_SELECT),
    ("WITH x AS (SELECT 1) SELECT * FROM x", None),
    ("select 1", None),
    ("\n\t select 1", None),
    ("select * from t; drop table t", a.NOT_SINGLE),
    ("WITH d AS (DELETE FROM t RETURNING *) SELECT * FROM d", a.NOT_READ_ONLY),
    ("SELECT dropped, resettled, killed_by, granted_on FROM t", None),
    *[(f"SELECT 1;{c}", None) for c in "\x1c\x1d\x1e\x1f\x85\u2003"],
    *[(c, a.NOT_SINGLE) for c in "\x1c\x1f\u2003"],
    ("\x1cSELECT 1", None),
    ("\x1f;\x1e select 2 ;", None),
    ("SELECT 'a;b'", a.NOT_SINGLE),
    ("SELECT 'on set'", a.NOT_READ_ONLY),
    ("SELECT éset, üdrop FROM t", None),
    *[(f"SELECT * FROM t WHERE 1=1 {word} x", a.NOT_READ_ONLY) for word in a.FORBIDDEN_WORDS],
    *[(f"select * from t where {word.lower()} = 1", a.NOT_READ_ONLY) for word in a.FORBIDDEN_WORDS],
]
VERDICTS = {None: "ok", a.NOT_SINGLE: "not_single", a.NOT_SELECT: "not_select", a.NOT_READ_ONLY: "not_read_only"}


@pytest.mark.parametrize("text, want", TEXTS)
def test_refusal(text, want):
    assert a.refusal(text) == want


def test_column_verdict_agrees_with_refusal(spark):
    df = spark.createDataFrame([(t,) for t, _ in TEXTS], "q string")
    got = [(r.q, r.v) for r in df.select("q", a.guard_verdict("q").alias("v")).collect()]
    assert got == [(t, VERDICTS[w]) for t, w in TEXTS]


def test_refused_query_does_not_run(spark):
    assert a.safe_sql(spark, "SELECT 1; DROP TABLE x").text == a.NOT_SINGLE
    with pytest.raises(PermissionError):
        a.guarded_frame(spark, "DELETE FROM t")


def test_results(spark):
    assert a.safe_sql(spark, "SELECT 1 AS one WHERE 1 = 0").text == a.NO_DATA
    few = a.safe_sql(spark, "SELECT id FROM range(5);")
    assert few.text == "Columns: ['id']\nRows: [(0,), (1,), (2,), (3,), (4,)]" and not few.truncated
    many = a.safe_sql(spark, "SELECT id FROM range(60) ORDER BY id")
    assert len(many.rows) == 50 and many.total == 60
    assert many.text.endswith("(truncated to first 50 of 60 rows)")
    full = a.safe_sql(spark, "SELECT id FROM range(50)")
    assert full.total == 50 and "truncated" not in full.text


def test_errors_become_text(spark):
    assert a.safe_sql(spark, "SELECT * FROM no_such_table").text.startswith("Database Error: ")


def test_time_budget_cancels_the_query(spark):
    slow = "SELECT count(*) FROM range(10000000) a WHERE length(repeat(sha2(cast(a.id AS string), 512), 50)) > 9"
    start = time.time()
    answer = a.safe_sql(spark, slow.replace("10000000", "2000000000"), timeout=2)
    assert answer.text.startswith("Database Error: ") and time.time() - start < 60
    assert a.safe_sql(spark, "SELECT 1 AS x").rows == [(1,)]


def test_gold_session_sees_only_its_tables(spark):
    path = new_path(spark, "gold")
    spark.range(3).write.parquet(path)
    spark.range(1).createOrReplaceTempView("other_view")
    gold = a.gold_session(spark, {"dim": path})
    assert a.safe_sql(gold, "SELECT count(*) AS n FROM dim").rows == [(3,)]
    assert a.safe_sql(gold, "SELECT * FROM other_view").error
    assert a.safe_sql(gold, f"SELECT * FROM parquet.`{path}`").error


@pytest.mark.parametrize(
    "text",
    [
        "SELECT transform(id) USING 'id -un' AS (x) FROM dim",
        "SELECT reflect('java.util.UUID', 'randomUUID') AS x",
        "SELECT java_method('java.util.UUID', 'randomUUID') AS x",
        "SELECT try_reflect('java.util.UUID', 'randomUUID') AS x",
        "SELECT * FROM dim WHERE id IN (SELECT length(reflect('java.util.UUID', 'randomUUID')) FROM dim)",
        "SELECT * FROM secret_table",
        "SELECT (SELECT max(id) FROM secret_table) AS x",
        "WITH s AS (SELECT * FROM secret_table) SELECT count(*) FROM s",
        "SELECT * FROM dim WHERE EXISTS (SELECT 1 FROM global_temp.secret_view)",
        "SELECT * FROM global_temp.secret_view",
    ],
)
def test_plans_beyond_the_views_are_refused_before_any_job(spark, text):
    path = new_path(spark, "gold")
    spark.range(3).write.parquet(path)
    spark.range(2).createOrReplaceGlobalTempView("secret_view")
    if not spark.catalog.tableExists("secret_table"):
        spark.sql("CREATE TABLE secret_table USING parquet AS SELECT 7L AS id")
    try:
        gold = a.gold_session(spark, {"dim": path})
        answer = a.safe_sql(gold, text)
        assert answer.error == a.NOT_ALLOWED and not answer.rows
        fine = "WITH t AS (SELECT id FROM dim) SELECT x.id FROM t x JOIN dim USING (id) WHERE x.id IN (SELECT max(id) FROM t)"
        assert a.safe_sql(gold, fine).rows == [(2,)]
    finally:
        spark.sql("DROP TABLE IF EXISTS secret_table")


def gold_tables(spark):
    dates = spark.createDataFrame([(dt.date(2023, 5, 1),), (dt.date(2024, 2, 3),)], "full_date date")
    riders = spark.createDataFrame([("member", "Member"), ("casual", "Casual")], "rider_type string, d string")
    return {"dim_rider_type": with_docs(riders, {"rider_type": "Code"}), "dim_date": dates}


def test_describe_is_ordered_and_commented(spark):
    rows = [tuple(r) for r in a.describe(gold_tables(spark), spark, {"dim_date": "Days"}).collect()]
    assert rows == [
        ("dim_date", 1, "full_date", "date", "", "Days"),
        ("dim_rider_type", 1, "rider_type", "string", "Code", ""),
        ("dim_rider_type", 2, "d", "string", "", ""),
    ]


def test_default_year(spark):
    dates = gold_tables(spark)["dim_date"]
    covered = a.coverage(dates, "full_date")
    assert a.default_year(covered).first()[0] == 2024
    assert a.in_default_year(dates, "full_date", covered).count() == 1
    assert a.in_default_year(dates.limit(0), "full_date", a.coverage(dates.limit(0), "full_date")).count() == 0


def vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0]), (4, [2.0, 0.0]), (5, [0.0, 0.0]), (6, None)]
    return spark.createDataFrame(rows, "id int, embedding array<float>")


def test_nearest(spark):
    got = [(r.id, round(r.distance, 6)) for r in nearest(vectors(spark), [3.0, 0.0], 3).collect()]
    assert got == [(1, 0.0), (4, 0.0), (3, round(1 - 0.5**0.5, 6))]


def test_nearest_batch_equals_nearest(spark):
    v = vectors(spark)
    queries = spark.createDataFrame([(7, [3.0, 0.0]), (8, [0.1, 0.9])], "q int, embedding array<float>")
    batch = nearest_batch(queries, v.repartition(3), 2, query_id="q", vector_id="id").collect()
    for q in queries.collect():
        one = [r.id for r in nearest(v, q.embedding, 2, digits=6).collect()]
        assert [r.neighbour_id for r in sorted(batch, key=lambda r: r.neighbour_rank) if r.query_id == q.q] == one
    blocks = nearest_batch(queries, v, 2, query_id="q", vector_id="id", block_bytes=1).collect()
    assert sorted(map(tuple, blocks)) == sorted(map(tuple, batch))


def test_nearest_batch_takes_any_id_and_skips_odd_vectors(spark):
    rows = [("b", [1.0, 0.0]), ("a", [2.0, 0.0]), ("c", [1.0]), ("d", None), ("e", [1.0, None]), ("f", [0.0, 1.0]), (None, [1.0, 0.0])]
    v = spark.createDataFrame(rows, "id string, embedding array<double>")
    queries = spark.createDataFrame([("q", [1.0, 0.0]), ("none", None), ("one", [3.0])], "q string, embedding array<double>")
    got = nearest_batch(queries, v, 2, query_id="q", vector_id="id").collect()
    assert sorted((r.query_id, r.neighbour_rank, r.neighbour_id) for r in got) == [("one", 1, "c"), ("q", 1, "a"), ("q", 2, "b")]


def test_remember(spark):
    pairs = spark.createDataFrame([("how many?", "SELECT 1", [0.5, 1.0])], "question string, query string, embedding array<double>")
    row = remember(pairs, "2024-01-01 00:00:00").first()
    store = TableStore(spark, new_path(spark, "memory"))
    for day in ("2024-01-01", "2024-01-02"):
        store.append("memory", remember(pairs, day))
    assert nearest(store.read("memory"), [1.0, 2.0], 3).count() == 2
    assert row.embedding == [0.5, 1.0] and row.created_at == dt.datetime(2024, 1, 1) and len(row.id) == 32


def test_capped_counts_in_the_run_that_gives_the_rows(spark):
    stored = spark._jsc.sc().getPersistentRDDs().size()
    big = spark.range(0, 100_000, 1, 7)
    rows, more, total = a.capped(big, 10)
    assert rows == [(n,) for n in range(10)] and more and total == 100_000
    ordered = big.orderBy(F.desc("id")).select("id", F.lit(1).alias("id"))
    assert a.capped(ordered, 3) == ([(99_999, 1), (99_998, 1), (99_997, 1)], True, 100_000)
    assert a.capped(big.where("id < 0"), 3) == ([], False, 0)
    assert a.capped(big.where("1 = 0"), 3) == ([], False, 0)
    assert a.capped(spark.sql("select 1 a where false"), 3) == ([], False, 0)
    none = big.join(big.where("id > 200000"), "id").groupBy((F.col("id") % 3).alias("m")).count()
    assert a.capped(none, 3) == ([], False, 0)
    assert a.capped(big.limit(4), 4)[1:] == (False, 4)
    assert spark._jsc.sc().getPersistentRDDs().size() == stored
