from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from strataflow.llm import simhash
from strataflow.llm.components import components

SCHEMA = "doc_id long, text string, fp string, _text_hash int"


def brute(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(prints, most=3):
    own = list(range(len(prints)))

    def find(x):
        while own[x] != x:
            x = own[x]
        return x

    for a in range(len(prints)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= most:
                own[find(a)] = find(b)
    return [find(x) for x in range(len(prints))]


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprints():
    for text in ("", None, "one", "one two", "A b C d e f", "é ÀB c", "a b c d e", "x " * 70_000 + "y z"):
        assert simhash.fingerprint(text) == signed(brute(text))


def test_links_of_all_distances(spark, monkeypatch):
    rng = random.Random(3)
    prints = []
    for _ in range(60):
        base = rng.getrandbits(64)
        prints.append(base)
        for n in (1, 2, 3, 4):
            for _ in range(2):
                other = base
                for bit in rng.sample(range(64), n):
                    other ^= 1 << bit
                prints.append(other)
    prints += prints[:20]
    rows = [(k, f"t{k}", signed(p)) for k, p in enumerate(prints)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda d, s: df.withColumn("text_hash", F.xxhash64("text")))
    got = {r.doc_id: r.component_id for r in simhash.group(df).collect()}
    want = classes(prints)
    least: dict = {}
    for k, c in enumerate(want):
        least[c] = min(least.get(c, k), k)
    assert got == {k: least[c] for k, c in enumerate(want)}


def test_dense_clump_gives_no_pairs(spark):
    rng = random.Random(5)
    base = rng.getrandbits(64)
    prints = {base}
    while len(prints) < 1500:
        prints.add(base ^ sum(1 << b for b in rng.sample(range(12), rng.randint(1, 6))))
    fps = spark.createDataFrame([(signed(p), signed(p)) for p in prints], "fp long, root long")
    assert simhash._steps(fps).count() <= 65 * len(prints)
    roots = components(simhash._steps(fps))
    tied = fps.drop("root").join(roots.withColumnRenamed("node", "fp"), "fp")
    assert tied.count() == len(prints)
    assert simhash.linked_cells(tied.select("fp", "root")).count() == 0


def test_odd_rows_and_keep_one(spark):
    long = " ".join(f"w{k}" for k in range(200))
    rows = [
        (4, None), (2, ""), (9, "  "), (None, long), (None, long), (7, long + " x"), (7, long + " x"),
        (1, "quite another text of some words"), (1, "quite another text of some words"), (None, "lonely words here now"),
    ]
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], SCHEMA)
    got = simhash.group(df).collect()
    by_text = {}
    for r in got:
        by_text.setdefault(r.fp, set()).add(r.component_id)
    assert by_text[0] == {2}
    assert all(len(v) == 1 for v in by_text.values())
    want = [signed(brute(t)) for _, t in rows]
    assert sorted(r.fp for r in got) == sorted(want)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert kept.count() == len(set(classes([brute(t) for _, t in rows])))
    none = spark.createDataFrame([], SCHEMA)
    assert simhash.group(none).count() == 0 and simhash.keep_one(none).count() == 0


def test_components(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, x) for x in range(101, 160)] + [(200, 200), (300, 299)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{k: 0 for k in range(61)}, **{k: 100 for k in range(100, 160)}, 299: 299, 300: 299}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_lower_bound():
    rng = np.random.default_rng(2)
    for a, b in rng.integers(0, 1 << 63, (200, 2)).tolist():
        counts = [[(x >> (2 * k) & 3).bit_count() for k in range(32)] for x in (a, b)]
        assert sum(abs(x - y) for x, y in zip(*counts)) <= (a ^ b).bit_count()


def test_bound_above_three(spark):
    with pytest.raises(ValueError):
        simhash.linked_cells(spark.createDataFrame([], "fp long, root long"), 4)
