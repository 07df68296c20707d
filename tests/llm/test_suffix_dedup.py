from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from strataflow.llm import suffix_dedup as sd


def brute(rows, length):
    """rows: (doc_id or None, text); of rows equal in both each gets the same result."""
    docs = sorted(
        {(i is None, i or 0, i, t) for i, t in rows}, key=lambda r: (r[0], r[1])
    )
    assert len({r[:2] for r in docs}) == len(docs) or True
    seen, result = {}, {}
    for _, _, i, text in docs:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        for s in range(len(raw) - length + 1):
            g = raw[s : s + length]
            if g in seen:
                gone[s : s + length] = True
            seen.setdefault(g, 1)
        kept = bytes(np.frombuffer(raw, dtype=np.uint8)[~gone])
        edges = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        result[(i, text)] = (len(raw), int(gone.sum()), int((edges == 1).sum()), hashlib.sha256(kept).hexdigest())
    return sorted(((i, *result[(i, t)]) for i, t in rows), key=str)


def made(seed, n=150):
    rng = random.Random(seed)
    words = ["alpha", "be", "Éa", "日本語", "x", "the", "quick", "0101", "\n", "brown fox"]
    passages = [" ".join(rng.choices(words, k=rng.randrange(5, 60))) for _ in range(6)]
    docs = []
    for i in range(n):
        parts = []
        for _ in range(rng.randrange(0, 8)):
            parts.append(rng.choice(passages) if rng.random() < 0.4 else " ".join(str(rng.random()) for _ in range(rng.randrange(1, 8))))
        docs.append((i, " ".join(parts)))
    for i in range(n, n + 40):  # exact and near copies
        text = rng.choice(docs)[1]
        if rng.random() < 0.7 and len(text) > 10:
            at = rng.randrange(len(text))
            text = text[:at] + rng.choice(["!", "", "zz"]) + text[at + 1 :]
        docs.append((i, text))
    docs += [(n + 50, "a" * 700), (n + 51, "ab" * 300 + "a" * 400), (n + 52, "b" * 99), (n + 53, ""), (n + 54, None), (n + 55, "abc" * 400 + "日" * 200)]
    return docs


def got(spark, docs, **settings):
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n int, raw string").repartition(5)
    out = sd.remove(df, **settings).drop("spans").collect()
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize(
    "settings",
    [
        {},
        # several ranges, parts and both ways for open runs
        {"bucket_rows": 40, "part_bytes": 5000, "few": 3},
        {"length": 20, "seed": 9, "bucket_rows": 100, "few": 0},
        {"length": 20, "seed": 20, "bucket_rows": 300, "part_bytes": 20000},
    ],
)
def test_brute_force(spark, settings):
    docs = made(len(settings))
    assert got(spark, docs, **settings) == brute(docs, settings.get("length", 100))


def test_hot_copies_and_lines(spark):
    rng = random.Random(9)
    line = "This line of more than a hundred bytes stands in very many documents and is the same everywhere, word for word. "
    docs = [(i, line * (i % 3) + str(rng.random()) * 4 + line[:60]) for i in range(200)]
    docs += [(i, docs[7][1]) for i in range(200, 400)]
    for settings in ({}, {"bucket_rows": 50, "few": 5}):
        assert got(spark, docs, **settings) == brute(docs, 100)


def test_shared_ids(spark):
    a, b, c = "first text " * 30, "second text " * 30, "third one here " * 20
    docs = [(1, a), (1, a), (None, a), (None, b), (None, b), (3, c), (3, None), (2, c)]
    rows = got(spark, docs)
    assert len(rows) == len(docs)
    by_id = {}
    for r in rows:
        by_id.setdefault(r[0], []).append(r)
    alone = brute([(1, a)], 100)[0]
    assert by_id[1] == [alone, alone]  # rows equal in both are one document
    assert sorted(r[1] for r in by_id[None]) == sorted([len(a), len(b), len(b)])
    assert [r for r in by_id[None] if r[1] == len(a)][0][2] == len(a)  # all of it starts earlier in 1
    assert len({r for r in by_id[None] if r[1] == len(b)}) == 1
    assert {r[1:3] for r in by_id[3]} == {(len(c), len(c)), (0, 0)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert sd.remove(df).count() == 0


def test_spans_and_other_types(spark):
    text = "".join(chr(97 + k % 26) + str(k) for k in range(200))
    df = spark.createDataFrame([(1, text), (2, "new " + text + " end")], "doc_id int, text string")
    out = {r.doc_id: r for r in sd.remove(df).collect()}
    assert [tuple(s) for s in out[2].spans] == [(4, 4 + len(text))]
    assert out[1].spans == [] and out[1].n_removed == 0


def test_multikey_order_finds_equal_strings():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    for length in (5, 8, 11, 20):
        at = np.arange(len(data) - length + 1)
        group = sd.equal_strings(data, at, length)
        raw = data.tobytes()
        want = {}
        for s in at:
            want.setdefault(raw[s : s + length], []).append(s)
        for members in want.values():
            found = {int(group[s]) for s in members}
            assert len(found) == 1 and (found == {0}) == (len(members) == 1)


def test_limits_open_at_the_start_of_equal_suffixes():
    sample = [(5, 1, 1, d, 0, 0) for d in range(50)] + [(9, 0, 0, 1, 0, 0)]
    cuts = sd.limits(sample, 5)
    assert cuts[0][:3] == (5, 1, 1) and cuts[0][5] == -1
    assert all(c in sample for c in cuts[1:])


def test_period_within_a_run(spark):
    """A string repeats one period on, where no window at either end of its run holds the seed twice."""
    rng = random.Random(0)
    docs = []
    for i in range(400):
        d = rng.randrange(40, 69)
        unit = "".join(chr(rng.randrange(33, 126)) for _ in range(d))
        front, back = ("".join(chr(rng.randrange(33, 126)) for _ in range(60)) for _ in range(2))
        docs.append((i, front + (unit * 5)[: 100 + d + rng.randrange(4)] + back))
    assert got(spark, docs) == brute(docs, 100)


def test_long_and_short_runs_of_a_seed(spark):
    docs = [(1, "a" * 2500), (2, "x" + "a" * 300 + "y"), (3, "ab" * 800), (4, "b" + "ab" * 60 + "c"), (5, "ab" * 51)]
    assert got(spark, docs) == brute(docs, 100)
