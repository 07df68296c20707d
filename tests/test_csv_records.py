from __future__ import annotations

import csv
import io
import random
from contextlib import contextmanager

from pyspark.sql import types as T

from strataflow.sources import files
from strataflow.sources.csv_records import records

SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("a", "b", "c")])


@contextmanager
def small_splits(spark, size):
    names = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "0"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    try:
        yield
    finally:
        for n, v in before.items():
            spark.conf.set(n, v)


def written(path, rows, end="\n"):
    out = io.StringIO()
    csv.writer(out, lineterminator=end).writerows([["a", "b", "c"], *rows])
    path.write_bytes(out.getvalue().encode())
    return out.getvalue()


def got(df):
    return sorted((r.a, r.b, r.c) for r in df.collect())


def test_fields_with_line_feeds_in_any_split(spark, tmp_path):
    draw = random.Random(7)
    parts = ["x", '"', ",", "\n", '""', "é", "long text ", "\n\n"]
    rows = [[f"k{i:04d}", "".join(draw.choices(parts, k=draw.randrange(9))), "end"] for i in range(200)]
    written(tmp_path / "x.csv", rows)
    want = sorted((a, b or None, c) for a, b, c in rows)
    for size in (40, 1000, 1 << 20):
        with small_splits(spark, size):
            df = files.read_csv_raw(spark, str(tmp_path), SCHEMA)
            assert {r._error for r in df.collect()} == {None}
            assert got(df) == want
    with small_splits(spark, 300):
        by_sort = records(spark, str(tmp_path), max_broadcast=0).where("not first")
        assert by_sort.count() == len(rows) and by_sort.where("error is not null").count() == 0
        assert sorted(by_sort.collect()) == sorted(records(spark, str(tmp_path)).where("not first").collect())
    with small_splits(spark, 64):
        text = spark.read.text(str(tmp_path))
        assert text.rdd.getNumPartitions() > 20


def test_one_field_over_many_blocks(spark, tmp_path):
    long = "\n".join(f"line {i}, with comma" for i in range(200))
    written(tmp_path / "x.csv", [["k1", long, "e"], ["k2", "\n", "f"], ["k3", long + '"', "g"]])
    with small_splits(spark, 100):
        df = files.read_csv_raw(spark, str(tmp_path), SCHEMA)
        assert got(df) == [("k1", long, "e"), ("k2", "\n", "f"), ("k3", long + '"', "g")]


def test_carriage_returns_mark_and_quotes_in_plain_fields(spark, tmp_path):
    (tmp_path / "x.csv").write_bytes('\ufeffa,b,c\r\nk1,5" pipe,x\r\n\r\nk2,"two\r\nlines",y\r\nk3,"a"b,"z"\r\n'.encode())
    df = files.read_csv_raw(spark, str(tmp_path), SCHEMA)
    assert got(df) == [("k1", '5" pipe', "x"), ("k2", "two\nlines", "y"), ("k3", '"a"b', "z")]


def test_same_rows_as_the_whole_file_reader(spark, tmp_path):
    draw = random.Random(3)
    for n in range(8):
        body = "".join(draw.choices(["a", "b", ",", ',"x', '",', "\n", '"\n', '""'], k=40))
        if records_open(body):
            continue
        folder = tmp_path / str(n)
        folder.mkdir()
        (folder / "x.csv").write_text("a,b,c\n" + body)
        with small_splits(spark, 13):
            ours = sorted(r.record for r in records(spark, str(folder)).where("not first").collect())
        whole = spark.read.option("escape", '"').option("multiLine", True).option("header", True).schema("a string, b string, c string")
        assert len(ours) == len(whole.csv(str(folder)).collect()), body


def records_open(body):
    """Whether a text ends inside a quoted field, character by character."""
    state = "start"
    for ch in body:
        if state == "quoted":
            state = "closed" if ch == '"' else "quoted"
        elif ch in ",\n":
            state = "start"
        elif ch == '"' and state in ("start", "closed"):
            state = "quoted"
        else:
            state = "plain"
    return state == "quoted"


def test_open_quote_long_record_and_other_header_are_refused_alone(spark, tmp_path):
    (tmp_path / "open.csv").write_text('a,b,c\nk1,x,y\nk2,"never closed,y\n' + "k3,x,y\n" * 50)
    (tmp_path / "other.csv").write_text("a,c,b\nk4,x,y\n")
    (tmp_path / "big.csv").write_text('a,b,c\nk5,"' + "x\n" * 400 + '",y\n')
    (tmp_path / "a_fine.csv").write_text('a,b,c\nk6,"x\n",y\n')
    for size in (40, 1 << 20):
        with small_splits(spark, size):
            paths = [str(tmp_path / n) for n in ("a_fine.csv", "open.csv", "other.csv", "big.csv")]
            rows = files.typed(files.read_csv_raw(spark, paths, SCHEMA, max_record=500), SCHEMA)
            good, refused = files.split_refused(rows)
            assert got(good) == [("k6", "x\n", "y")]
            found = {r._archive: r.message for r in refused.collect()}
            assert found.keys() == {"open.csv", "other.csv", "big.csv"}
            assert "never closed" in found["open.csv"] and "above 500" in found["big.csv"]
            assert "another header" in found["other.csv"]


def test_files_without_rows(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b,c\n")
    (tmp_path / "y.csv").write_text("a,b,c")
    (tmp_path / "z.csv").write_text("")
    assert files.read_csv_raw(spark, [str(tmp_path / n) for n in ("x.csv", "y.csv", "z.csv")], SCHEMA).count() == 0


def test_file_names_as_they_are(spark, tmp_path):
    for name in ("a b+c.csv", "d%20é.csv"):
        (tmp_path / name).write_text('a,b,c\nk1,"x\ny",z\n')
    df = files.read_csv_raw(spark, str(tmp_path), SCHEMA)
    whole = files.read_csv_raw(spark, str(tmp_path), SCHEMA, multi_line=False)
    assert {r._archive for r in df.collect()} == {r._archive for r in whole.collect()}
