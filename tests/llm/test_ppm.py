from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strataflow.llm import ppm

SCHEMA = "doc_id long, text string, score double, n int, held_out string"
ROWS = [
    (1, "the cat sat on the mat"), (2, "The cat, the dog and the bird"), (3, None), (4, ""), (None, "the null id"),
    (5, "zebra quux ÀB  the\tcat\nsat"), (6, "the cat sat on the mat"), (6, "the cat sat on the mat"), (10, "a dog on a mat " * 300),
]


def slow_log10(text, learnt, order):
    """Byte by byte, over dictionaries."""
    seen: dict = {}
    for t in learnt:
        data = bytes([ppm.BEFORE]) * order + t.encode().lower() + bytes([ppm.END])
        for k in range(order, len(data)):
            seen.setdefault(data[k - order : k], Counter())[data[k]] += 1
    levels = {order: seen}
    for k in range(order - 1, -1, -1):
        levels[k] = {}
        for context, counts in levels[k + 1].items():
            levels[k].setdefault(context[1:], Counter()).update(counts.keys())
    data = bytes([ppm.BEFORE]) * order + text.encode().lower() + bytes([ppm.END])
    total = 0.0
    for at in range(order, len(data)):
        p, ruled = 1.0, set()
        for k in range(order, -1, -1):
            counts = levels[k].get(data[at - k : at])
            if counts is None:
                continue
            left = {b: n for b, n in counts.items() if b not in ruled}
            if not left:
                continue
            whole = sum(2 * n - 1 for n in left.values()) + len(left)
            if data[at] in left:
                p *= (2 * left[data[at]] - 1) / whole
                break
            p *= len(left) / whole
            ruled |= set(counts)
        else:
            p /= 256 - len(ruled)
        total += math.log10(p)
    return total


@pytest.mark.parametrize("order", [1, 3, 5])
def test_against_slow_model(order):
    learnt = [t or "" for _, t in ROWS]
    codes, starts, lengths = ppm.padded(learnt, order)
    found, counts = ppm._places(codes, starts, lengths, order)
    keys, n = np.unique(found, return_counts=True)
    trie = ppm.Trie(keys, n, order)
    asked = ["the cat", "", "xyz", "dog dog", "mat É", None]
    got = trie.log10_of(asked, chunk=5)
    assert got == pytest.approx([slow_log10(t or "", learnt, order) for t in asked])
    for context in (b"the c", b"\xfe" * 5, b"zzzzz"):
        own = np.array([int.from_bytes(context[-order:] + bytes([b]), "big") for b in range(256)], dtype=np.uint64)
        assert np.exp(trie.log_probabilities(own)).sum() == pytest.approx(1)


def brute_base(rows, held):
    tokens = {id(r): [*(r[1] or "").lower().replace(" ", "_").split(), None] for r in rows}
    counts = Counter(w for r in rows if held(r[0]) is False for w in tokens[id(r)])
    n, v = sum(counts.values()), len(counts)
    out = []
    for r in rows:
        own = tokens[id(r)]
        out.append(
            (
                r[0] or -1, len(own), sum(counts[w] > 0 for w in own), n,
                round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own), 8),
            )
        )
    return sorted(out)


def test_query(spark):
    df = spark.createDataFrame([(i, t, 0.0, 1, "x") for i, t in ROWS], SCHEMA).repartition(3)

    def held(i):
        return None if i is None else i % 5 == 0

    got = ppm.score(df, F.col("doc_id") % 5 == 0, order=3).collect()
    assert sorted((r.doc_id or -1, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 8)) for r in got) == brute_base(ROWS, held)
    learnt = [t or "" for i, t in ROWS if held(i) is False]
    want = sorted((i or -1, round(slow_log10(t or "", learnt, 3), 8)) for i, t in ROWS)
    assert sorted((r.doc_id or -1, round(r.score, 8)) for r in got) == want
    assert {r.doc_id for r in got if r.held_out} == {5, 10}


def test_parts_add_up(spark):
    df = spark.createDataFrame([(i, t, 0.0, 1, "x") for i, t in ROWS], SCHEMA)
    buckets = ppm.gram_buckets(ppm.gather(df, F.lit(False), order=4))
    whole, parts = (
        sorted((r.doc_id or -1, round(r.score, 8)) for r in ppm.trie_scores(df, buckets, order=4, max_grams=n).collect())
        for n in (10**6, 20)
    )
    assert whole == parts


def test_nothing_learnt_and_empty(spark):
    df = spark.createDataFrame([(1, "ab", 0.0, 1, "x")], SCHEMA)
    row = ppm.score(df, F.lit(True)).first()
    assert row.score == pytest.approx(-3 * math.log10(256)) and row.train_tokens == 0 and row.base_score == pytest.approx(0)
    assert ppm.score(df.limit(0), F.lit(False)).count() == 0


def test_counts_go_out_in_pieces(spark):
    """Runs, blocks and their rows in several pieces give the same scores, and no piece is larger than asked."""
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{k}" for k in rng.integers(0, 400, 60)), 0.0, 1, "x") for i in range(300)] + [(None, None, 0.0, 1, "x")]
    df = spark.createDataFrame(rows, SCHEMA).repartition(2)
    held = F.col("doc_id") % 7 == 0

    def scores(gathered):
        base = {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 8)) for r in ppm.base_scores(gathered).collect()}
        grams = ppm.gram_buckets(gathered)
        return base, sorted((r.doc_id or -1, round(r.score, 8)) for r in ppm.trie_scores(df, grams, order=4).collect())

    small = ppm.gather(df, held, order=4, block_bytes=9000, run_grams=4000, learn_chars=1000, piece_rows=50)
    numbers = small.where("kind = 't'").groupBy("block").agg(F.max("number").alias("last"), F.count("*").alias("n")).collect()
    assert len(numbers) > 4 and all(r.n == r["last"] + 1 > 50 for r in numbers)
    assert scores(small) == scores(ppm.gather(df, held, order=4))


def test_large_ids_stay_exact_beside_null(spark):
    ids = [2**53 + 1, 2**53 + 2, None]
    df = spark.createDataFrame([(i, "same text", 0.0, 1, "x") for i in ids], SCHEMA).coalesce(1)
    assert {r.doc_id for r in ppm.score(df, F.lit(False), order=2).collect()} == set(ids)


@pytest.mark.parametrize("frequent", [0, 40, 1 << 19])
def test_no_process_holds_the_trie(spark, monkeypatch, frequent):
    """Frequent grams by broadcast, the others by parts: the slow model's scores, and only bounded rows on the driver."""
    df = spark.createDataFrame([(i, t, 0.0, 1, "x") for i, t in ROWS * 3 + [(7, "unseen ÿ wörds"), (8, "the " * 60_000)]], SCHEMA)
    learnt = [t or "" for i, t in ROWS * 3 if i is not None and i != 5]
    buckets = ppm.gram_buckets(ppm.gather(df, (F.col("doc_id") == 5) | F.col("doc_id").isin(7, 8), order=4))
    grams = buckets.agg(F.sum("n")).first()[0]
    sent = []
    plain = type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, v: sent.append(v) or plain(self, v))
    scored = ppm.trie_scores(df, buckets, order=4, max_grams=30, frequent_grams=frequent, block_bytes=500, block_rare=50)
    got = sorted((r.doc_id or -1, r.score) for r in scored.collect())
    held = sum(len(ppm._unpacked_keys(keys)) for rows in sent for keys, _ in rows)
    assert held <= frequent if frequent < grams else held == grams
    asked = [*ROWS * 3, (7, "unseen ÿ wörds"), (8, "the " * 60_000)]
    want = sorted((i or -1, slow_log10(t or "", learnt, 4)) for i, t in asked)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert [x for _, x in got] == pytest.approx([x for _, x in want])


def test_idle_workers_give_memory_back(spark):
    """A worker that has ended a task keeps little of what the task held."""
    from strataflow.llm.common import on_path, releasing

    def anonymous() -> int:
        with open("/proc/self/smaps_rollup") as f:
            return sum(int(line.split()[1]) >> 10 for line in f if line.startswith("Anonymous:"))

    def hold(batches):
        yield from batches
        # Small blocks, freed but for the last, which keeps the heap from shrinking at its end.
        held = [np.ones(2000) for _ in range(10_000)]
        ppm.kept = held[-1]

    def ask(batches):
        for b in batches:
            yield pd.DataFrame({"mb": [anonymous()] * len(b)})

    on_path(spark)
    one = spark.range(1).coalesce(1)
    before = one.mapInPandas(ask, "mb long").first().mb
    one.mapInPandas(releasing(hold), "id long").collect()
    assert one.mapInPandas(ask, "mb long").first().mb < before + 100
