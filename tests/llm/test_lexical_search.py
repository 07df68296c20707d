from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from strataflow.llm import lexical_search as ls

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def split(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k=10):
    counts = [(d, Counter(split(t))) for d, t in docs]
    n_docs = sum(1 for _, c in counts if c)
    n_terms = sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c in counts:
            n, s = sum(c.values()), 0
            for t in set(split(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 10 + (90 * n * n_docs) // n_terms
                s += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if s > 0:
                found.append((-s, d is None, d or 0, d))
        out += [(item, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def made(n, seed=3):
    rng = random.Random(seed)
    words = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(4000)] + ["Éa", "日本", "İx", "a-b", "c\x00d"]
    docs = [(k, " ".join(rng.choices(words, k=rng.choice([0, 3, 30, 200])))) for k in range(n)]
    items = [(k, " ".join(rng.choices(words, k=25))) for k in range(12)]
    docs += [(n + k, items[k % 12][1] + " tail " * (k % 3)) for k in range(40)]  # passages and their copies
    return docs, items


@pytest.mark.parametrize("shard", [50, 500_000])
def test_brute_force(spark, shard):
    docs, items = made(300)
    docs += [(7, None), (None, items[0][1]), (None, ""), (9, items[1][1]), (9, items[1][1]), (10**6, "w1 " * 60_000 + items[2][1])]
    items += [(None, "w1 w2"), (99, None), (99, ""), (3, "w1 w1 W1"), (3, "w1"), (100, "unheardof")]
    d = spark.createDataFrame([(i, t, 1, 2) for i, t in docs], "doc_id long, text string, n int, score int").repartition(5)
    q = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    got = ls.rank(d, q, shard_postings=shard)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_items_in_blocks(spark):
    docs, items = made(60)
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = ls.rank(d, q, block_bytes=200, k=3)
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items, 3)


def test_empty_tables(spark):
    docs, items = made(5)
    d, q = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert ls.rank(d.limit(0), q).count() == 0
    assert ls.rank(d, q.limit(0)).count() == 0


def shard_of(docs, item, pairs):
    """A shard made by hand: places with impacts for each term."""
    own = ls.Shard.__new__(ls.Shard)
    own.doc_ids, own.lists, places, values = list(range(len(docs))), {}, [], []
    for t in item:
        at = [p for p, d in enumerate(docs) if t in d]
        if at:
            own.lists[t] = (len(places), len(places) + len(at), max(docs[p][t] for p in at))
            places += at
            values += [docs[p][t] for p in at]
    own.places, own.impacts = np.array(places, dtype=np.int32), np.array(values, dtype=np.int64)
    own.pairs, lists = {}, []
    for n, (a, b) in enumerate(pairs):
        if a in own.lists and b in own.lists:
            at = [p for p, d in enumerate(docs) if a in d and b in d]
            own.pairs[n] = (max((docs[p][a] + docs[p][b] for p in at), default=0), len(lists), len(lists) + len(at))
            lists += at
    own.pair_places = np.array(lists, dtype=np.int32)
    return own


def test_pairs_skip_more_than_single_maxima():
    rng = random.Random(5)
    item = list(range(6))
    # Terms 0 to 3 never meet; together their single maxima look large.
    docs = [{rng.randrange(4): rng.randrange(60, 86)} for _ in range(500)] + [{4: 180 + k, 5: 5} for k in range(10)]
    pairs = [(0, 1), (2, 3)]
    own = shard_of(docs, item, pairs)
    named = [(n, a, b) for n, (a, b) in enumerate(pairs)]
    with_pairs, alone = [], []
    a = own.search(item, named, 10, 180, counts=with_pairs)
    b = own.search(item, [], 10, 180, counts=alone)
    assert a[1].tolist() == b[1].tolist() == [194 - k for k in range(10)]
    assert sum(with_pairs) < sum(alone) / 5


def test_bounds_hold_for_every_document():
    rng = random.Random(11)
    for _ in range(50):
        item = list(range(8))
        docs = [{t: rng.randrange(1, 50) for t in item if rng.random() < 0.3} for _ in range(30)]
        pairs = [(a, b) for a in item for b in item[a + 1 :] if rng.random() < 0.5]
        own = shard_of(docs, item, pairs)
        order = sorted(own.lists, key=lambda t: own.lists[t][2])
        bounds = own.bounds(order, [(n, a, b) for n, (a, b) in enumerate(pairs)])
        for p, bound in enumerate(bounds):
            assert all(sum(d.get(t, 0) for t in order[:p]) <= bound for d in docs)
