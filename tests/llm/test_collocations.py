from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from strataflow.llm import collocations as co

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def pieces(text):
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
        yield re.findall(r"[^\x20\x09]+", piece)


def brute(docs, least, top, percent=100):
    counts = {}
    for lang, text in docs:
        own = counts.setdefault(lang or "und" if lang is None else lang, Counter())
        for w in pieces(text):
            for k in range(1, 6):
                own.update(tuple(w[s : s + k]) for s in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(v for g, v in f.items() if len(g) == 1)
        often = {g: v for g, v in f.items() if 2 <= len(g) and v >= least}
        rows = []
        for g, a in often.items():
            inside = any(
                len(h) > len(g) and 100 * v >= percent * a and any(h[s : s + len(g)] == g for s in range(len(h)))
                for h, v in often.items()
            )
            if not inside:
                cuts = [(1000 * a * n // (f[g[:k]] * f[g[k:]]), k) for k in range(1, len(g))]
                score, k = min(cuts)
                rows.append((-score, -a, " ".join(g).encode(), f[g[:k]], f[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def made(seed, n=200):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(12)] + ["Éa", "日本", "a\x01b", "(x)", "n'est"]
    fixed = ["new York city hall clock", "of the", "W1 w2 w3", "日本 Éa"]
    docs = []
    for _ in range(n):
        parts = [rng.choice([rng.choice(words), rng.choice(fixed)]) + rng.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for _ in range(30)]
        docs.append((rng.choice(["en", "en", "de", None]), "".join(parts)))
    return docs


@pytest.mark.parametrize("shard_words", [60, 3_000_000])
def test_brute_force(spark, shard_words):
    docs = [*made(1), ("en", None), ("en", ""), (None, " . ,,"), ("x y%20\n", "one two one two one two one two one two one two"), ("x y%20\n", "one two. " * 20), ("en", "of the " * 3000), ("fr", "seul")]
    df = spark.createDataFrame([(x, t, 1, 2) for x, t in docs], "lang string, text string, n int, ids int").repartition(6)
    got = co.mine(df, least=20, shard_words=shard_words, bucket_rows=100)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute(docs, 20, 2000)


def test_top_and_percent(spark):
    docs = made(2)
    df = spark.createDataFrame(docs, "lang string, text string")
    assert sorted(map(tuple, co.mine(df, least=5, top=7, percent=60).collect())) == brute(docs, 5, 7, 60)


def test_empty_table(spark):
    df = spark.createDataFrame([], "lang string, text string")
    assert co.mine(df).count() == 0
    assert co.mine(spark.createDataFrame([("en", None)], "lang string, text string")).count() == 0


def test_products_beyond_64_bits(spark):
    row = spark.sql("select 4000000000000 a, 9000000000000000 n, 5000000000000 l, 6000000000000 r")
    exact = "cast(a as decimal(17, 0)) * 1000 * cast(n as decimal(17, 0)) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"
    assert row.selectExpr(exact).first()[0] == 1000 * 4000000000000 * 9000000000000000 // (5000000000000 * 6000000000000)


@pytest.mark.parametrize("seed", range(5))
def test_extensions_both_ways(seed):
    rng = np.random.default_rng(seed)
    sequence = np.append(rng.integers(0, 5, 300), 0).astype(np.int32)
    index = co.Index.build(sequence)
    want = Counter()
    for k in range(1, 6):
        for s in range(len(sequence) - k + 1):
            gram = tuple(sequence[s : s + k].tolist())
            if 0 not in gram:
                want[gram] += 1
    words, low, low_reverse, size = index.single()
    held = words[None, :]
    got = Counter({(int(w),): int(n) for w, n in zip(words, size)})
    for right in (bool(seed & 1), True, False, bool(seed & 2)):
        phrase, word, low, low_reverse, size = index.extend(low, low_reverse, size, right=right)
        old = held[:, phrase]
        held = np.vstack([old, word]) if right else np.vstack([word, old])
        got.update({tuple(g): int(n) for g, n in zip(held.T.tolist(), size)})
    assert got == want


def test_pieces_end_between_words_that_are_not_joined():
    sequence = np.array([1, 2, 3, 0, 4, 5, 6, 7, 0, 8, 9, 8, 9, 8, 0], dtype=np.int32)
    joined = np.array([1, 1, 0, 0, 1, 0, 1, 0, 0, 1, 1, 1, 1, 0], dtype=bool)
    assert co.along(sequence, joined, 3).tolist() == [1, 2, 3, 0, 8, 9, 8, 9, 8, 0]
    assert co.along(sequence, joined, 2).tolist() == [1, 2, 3, 0, 4, 5, 0, 6, 7, 0, 8, 9, 8, 9, 8, 0]
    assert not len(co.along(sequence, np.zeros(14, dtype=bool), 2)) and not len(co.along(sequence[:1], joined[:0], 2))


def test_no_transform_is_stored(spark, monkeypatch):
    """A shard's frequent words are staged once: two transforms took twice the room, and again in a shuffle."""
    staged, own = {}, co.stage
    monkeypatch.setattr(co, "stage", lambda df, name: staged.setdefault(name, own(df, name)))
    docs = [(x, t, 1, 2) for x, t in made(3)]
    df = spark.createDataFrame(docs, "lang string, text string, n int, ids int").repartition(2)
    assert sorted(map(tuple, co.mine(df, least=20, shard_words=300).collect())) == brute([d[:2] for d in docs], 20, 2000)
    held = [f.columns for f in staged.values() if "shard" in f.columns and "ids" in f.columns and "kind" not in f.columns]
    assert held == [["shard", "ids", "sequence"]]


def test_nothing_that_grows_with_the_texts_is_broadcast(spark, monkeypatch):
    """The files of the phrases passed for small while their rows, one for each word, did not fit the driver."""
    plans, own = [], co.stage

    def planned(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(co, "stage", lambda df, name: own(planned(df), name))
    docs = made(4)
    df = spark.createDataFrame(docs, "lang string, text string").repartition(2)
    found = planned(co.mine(df, least=20, shard_words=300))
    assert sorted(map(tuple, found.collect())) == brute(docs, 20, 2000)
    joins = re.findall(r"(\w+Join) \[(\w+?)#", "\n".join(plans))
    assert {"ids", "_left", "_right", "id"} <= {key for kind, key in joins if kind == "SortMergeJoin"}
    assert {key for kind, key in joins if kind != "SortMergeJoin"} == {"lang"}  # a row for each language
