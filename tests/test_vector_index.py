from __future__ import annotations

import random

import pytest

from strataflow.operators.vector_index import LIST, VectorMemory
from strataflow.operators.vectors import nearest_batch
from strataflow.session import new_path
from strataflow.sources.tables import TableStore

ROWS = "id string, embedding array<float>"


def clustered(n, seed, size=6, groups=12, spread=0.03):
    draw, fixed = random.Random(seed), random.Random(1)
    middle = [[fixed.gauss(0, 1) for _ in range(size)] for _ in range(groups)]
    return [[x + draw.gauss(0, spread) for x in middle[i % groups]] for i in range(n)]


def results(df):
    return sorted((r.query_id, r.neighbour_rank, r.neighbour_id, r.distance) for r in df.collect())


@pytest.fixture
def memory(spark):
    return VectorMemory(TableStore(spark, new_path(spark, "index")), "memory", lists=24)


def test_same_results_from_a_share_of_the_lists(spark, memory):
    first = spark.createDataFrame([(f"a{i}", v) for i, v in enumerate(clustered(900, 2))], ROWS)
    hot = spark.createDataFrame([(f"h{i}", [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(400)], ROWS)
    drifted = spark.createDataFrame([(f"d{i}", v) for i, v in enumerate(clustered(300, 5, groups=40, spread=0.3))], ROWS)
    memory.append(first)
    before = {p.name for p in _files(memory)}
    memory.append(hot)
    memory.append(drifted)
    assert before <= {p.name for p in _files(memory)}
    rows = first.union(hot).union(drifted)
    asked = spark.createDataFrame([(f"q{i}", v) for i, v in enumerate(clustered(24, 9))] + [("same", [2.0, 4.0, 6.0, 8.0, 10.0, 12.0])], "q string, embedding array<float>")
    for k in (1, 5):
        want = results(nearest_batch(asked, rows, k, query_id="q", vector_id="id"))
        assert results(memory.nearest(asked, k, query_id="q")) == want
        share = memory.read_share
        assert share["read"] < 0.5 * share["pairs"] and share["lists"] > 10
        blocks = memory.nearest(asked, k, query_id="q", block_bytes=900)
        assert results(blocks) == want
    # More rows than any list holds: every list is read, and the result is still whole.
    want = results(nearest_batch(asked, rows, 700, query_id="q", vector_id="id"))
    assert results(memory.nearest(asked, 700, query_id="q")) == want
    other = memory.refit("again")
    assert results(other.nearest(asked, 5, query_id="q")) == results(nearest_batch(asked, rows, 5, query_id="q", vector_id="id"))
    assert sorted(memory.read().collect()) == sorted(rows.collect())


def _files(memory):
    from pathlib import Path

    return list(Path(memory.store.path(memory.name).removeprefix("file:")).rglob("*.parquet"))


def test_only_wanted_lists_are_opened(spark, memory):
    memory.append(spark.createDataFrame([(f"a{i}", v) for i, v in enumerate(clustered(600, 2))], ROWS))
    stored = memory.store.read("memory")
    plan = stored.where(stored[LIST].isin([1, 2]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_list" in plan
    asked = spark.createDataFrame([("q", clustered(1, 9)[0])], "q string, embedding array<float>")
    memory.nearest(asked, 3, query_id="q")
    assert memory.read_share["read"] <= 6 < memory.read_share["lists"]


def test_odd_vectors_ties_and_empty_memory(spark, memory):
    rows = [("b", [1.0, 0.0]), ("a", [2.0, 0.0]), ("c", [1.0]), ("d", None), ("e", [1.0, None]), ("f", [0.0, 1.0]), (None, [1.0, 0.0]), ("z", [0.0, 0.0]), ("n", [float("nan"), 1.0]), ("m", [])]
    v = spark.createDataFrame(rows, ROWS)
    asked = spark.createDataFrame([("q", [1.0, 0.0]), ("none", None), ("one", [3.0]), ("three", [1.0, 1.0, 1.0])], "q string, embedding array<float>")
    memory.append(v.limit(0))
    assert memory.nearest(asked, 2, query_id="q").count() == 0
    memory.append(v.where("id = 'd'"))
    assert memory.nearest(asked, 2, query_id="q").count() == 0
    memory.append(v.where("id is null or id <> 'd'"))
    got = results(memory.nearest(asked, 2, query_id="q"))
    assert [g[:3] for g in got] == [("one", 1, "c"), ("q", 1, "a"), ("q", 2, "b")]
    assert memory.read().count() == len(rows)
    assert memory.nearest(asked.limit(0), 2, query_id="q").count() == 0
