"""Ranked lexical search: MaxScore over shards of documents, with bounds of term pairs.

Each shard holds postings with their impacts, each term's largest impact, and
for pairs of terms the list of documents that hold both, with the largest sum of
their impacts.  A query's bound for a set of terms joins disjoint pairs: two
terms together add no more than their joint maximum, or the larger of their own.
"""

from __future__ import annotations

import math
import string
from collections.abc import Iterator
from itertools import combinations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import map_pandas
from strataflow.session import stage

#: ASCII that parts terms becomes a space; A-Z are lower-cased; all else stays.
_KEPT = set((string.ascii_letters + string.digits).encode()) | set(range(0x80, 0x100))
TERM_BYTES = bytes(b if b in _KEPT else 0x20 for b in range(256)).translate(
    bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
)


def terms(text: str | None) -> list[bytes]:
    """The terms of a whole text in order; none for NULL."""
    return text.encode("utf-8", "replace").translate(TERM_BYTES).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def impacts(weights, tf, length, n_docs: int, n_terms: int):
    """What an occurrence list adds to a document's score: whole numbers throughout."""
    m = 10 + (90 * length * n_docs) // n_terms
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def count_terms(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Occurrences of the vocabulary in each document, and sums per task; staged.

    Rows by ``kind``: ``d`` is a document that holds terms of the vocabulary,
    ``t`` a term with the number of a task's documents that hold it, ``s`` a
    task's documents with terms, and all their terms.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"kind string, doc_id {id_type}, n long, df long, terms binary, tfs binary"
    names = [c.split()[0] for c in schema.split(", ")]

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from collections import Counter

        import numpy as np

        df = np.zeros(len(vocabulary), dtype=np.int64)
        n_docs = n_terms = 0
        number = vocabulary.get
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"], b["text"]):
                found = terms(text)
                if not found:
                    continue
                n_docs, n_terms = n_docs + 1, n_terms + len(found)
                times = Counter(map(number, found))
                times.pop(None, None)
                if times:
                    own = np.fromiter(times, dtype=np.int32, count=len(times))
                    tf = np.fromiter(times.values(), dtype=np.int32, count=len(times))
                    df[own] += 1
                    rows.append((doc_id, len(found), own.tobytes(), tf.tobytes()))
            out = pd.DataFrame(rows, columns=["doc_id", "n", "terms", "tfs"])
            yield out.assign(kind="d", df=None).reindex(columns=names)
        held = np.flatnonzero(df)
        yield pd.DataFrame({"kind": "t", "n": held, "df": df[held]}).reindex(columns=names)
        yield pd.DataFrame({"kind": ["s"], "n": [n_terms], "df": [n_docs]}).reindex(columns=names)

    return stage(map_pandas(docs.select("doc_id", "text"), step, schema), "term_counts")


def _pack(numbers, kind: str) -> bytes:
    import numpy as np

    return np.ascontiguousarray(numbers, dtype=kind).tobytes()


def build_shards(counted: DataFrame, weights, pairs, n_docs: int, n_terms: int, shard_postings: int) -> DataFrame:
    """The index: one row per shard of at most ``shard_postings`` postings (or one document); staged.

    ``terms`` names the shard's terms with ``ends`` of their postings, ``places``
    and ``impacts``; ``pairs`` has the number of each pair of terms that the shard
    holds, ``joint`` their largest joint impact (0 if no document holds both),
    and ``pair_ends`` and ``pair_places`` the intersection lists.  Documents are
    numbered in the order of doc_id, NULL last.
    """
    rows = counted.where("kind = 'd'").select("doc_id", "n", "terms", "tfs")
    id_type = rows.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_ids array<{id_type}>, terms binary, ends binary, places binary, impacts binary, "
        "pairs binary, joint binary, pair_ends binary, pair_places binary"
    )

    def shard(ids: list, lengths: list, own: list, tfs: list) -> pd.DataFrame:
        import numpy as np

        order = pd.Series(ids, dtype=object).sort_values(na_position="last", kind="stable").index.tolist()
        sizes = np.array([len(own[k]) for k in order])
        place = np.repeat(np.arange(len(order), dtype=np.int64), sizes)
        term = np.concatenate([own[k] for k in order]).astype(np.int64)
        tf = np.concatenate([tfs[k] for k in order]).astype(np.int64)
        length = np.repeat(np.array([lengths[k] for k in order], dtype=np.int64), sizes)
        by = np.argsort(term, kind="stable")  # places stay ascending inside a term
        term, place = term[by], place[by]
        impact = impacts(weights[term], tf[by], length[by], n_docs, n_terms)
        ends = np.append(np.flatnonzero(np.diff(term)) + 1, len(term))
        names = term[ends - 1]
        slot = {int(t): k for k, t in enumerate(names)}
        starts = np.append(0, ends[:-1])
        held, joint, lists = [], [], []
        for number, (a, b) in enumerate(pairs):
            x, y = slot.get(a), slot.get(b)
            if x is None or y is None:
                continue
            if ends[x] - starts[x] > ends[y] - starts[y]:
                x, y = y, x
            few, many = place[starts[x] : ends[x]], place[starts[y] : ends[y]]
            at = np.minimum(np.searchsorted(many, few), len(many) - 1)
            both = many[at] == few
            sums = impact[starts[x] : ends[x]][both] + impact[starts[y] : ends[y]][at[both]]
            held.append(number)
            joint.append(int(sums.max()) if len(sums) else 0)
            lists.append(few[both])
        pair_ends = np.cumsum([len(p) for p in lists])
        return pd.DataFrame(
            {
                "doc_ids": [[None if pd.isna(ids[k]) else ids[k] for k in order]],
                "terms": [_pack(names, "<i4")], "ends": [_pack(ends, "<i8")],
                "places": [_pack(place, "<i4")], "impacts": [_pack(impact, "<i8")],
                "pairs": [_pack(held, "<i4")], "joint": [_pack(joint, "<i8")], "pair_ends": [_pack(pair_ends, "<i8")],
                "pair_places": [_pack(np.concatenate(lists) if lists else [], "<i4")],
            }
        )

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        ids, lengths, own, tfs, held = [], [], [], [], 0
        for b in batches:
            for doc_id, n, term, tf in zip(b["doc_id"], b["n"], b["terms"], b["tfs"]):
                if ids and held + len(term) // 4 > shard_postings:
                    yield shard(ids, lengths, own, tfs)
                    ids, lengths, own, tfs, held = [], [], [], [], 0
                ids.append(doc_id)
                lengths.append(n)
                own.append(np.frombuffer(term, dtype=np.int32))
                tfs.append(np.frombuffer(tf, dtype=np.int32))
                held += len(term) // 4
        if ids:
            yield shard(ids, lengths, own, tfs)

    return stage(map_pandas(rows, step, schema), "lexical_shards")


class Shard:
    """One row of the index, opened for queries."""

    def __init__(self, row):
        import numpy as np

        def read(name: str, kind: str):
            return np.frombuffer(row[name], dtype=kind)

        self.doc_ids, self.places, self.impacts = row["doc_ids"], read("places", "<i4"), read("impacts", "<i8")
        names, ends = read("terms", "<i4"), read("ends", "<i8")
        begins = np.append(0, ends[:-1]).astype(np.int64)
        largest = np.maximum.reduceat(self.impacts, begins)
        self.lists = dict(zip(names.tolist(), zip(begins.tolist(), ends.tolist(), largest.tolist())))
        pair_ends = read("pair_ends", "<i8")
        pair_begins = np.append(0, pair_ends[:-1]).astype(np.int64)
        self.pair_places = read("pair_places", "<i4")
        self.pairs = dict(
            zip(read("pairs", "<i4").tolist(), zip(read("joint", "<i8").tolist(), pair_begins.tolist(), pair_ends.tolist()))
        )

    def add(self, scores, candidates, term: int) -> None:
        """Add a term's impacts to the scores of candidates, both in order of place."""
        import numpy as np

        begin, end, _ = self.lists[term]
        own = self.places[begin:end]
        at = np.minimum(np.searchsorted(own, candidates), len(own) - 1)
        seen = own[at] == candidates
        scores[seen] += self.impacts[begin:end][at[seen]]

    def bounds(self, order: list[int], item_pairs: list) -> list[int]:
        """For each number of first terms of ``order``, the most they add to one document together.

        Disjoint pairs with the largest savings against single maxima are joined.
        """
        rank = {t: k for k, t in enumerate(order)}
        most = [self.lists[t][2] for t in order]
        savings = []
        for number, a, b in item_pairs:
            if number in self.pairs and a in rank and b in rank:
                x, y = rank[a], rank[b]
                saved = most[x] + most[y] - max(self.pairs[number][0], most[x], most[y])
                if saved > 0:
                    savings.append((saved, max(x, y), min(x, y)))
        savings.sort(reverse=True)
        out, total = [0], 0
        for p in range(1, len(order) + 1):
            total += most[p - 1]
            taken, less = set(), 0
            for saved, high, low in savings:
                if high < p and high not in taken and low not in taken:
                    taken.update((high, low))
                    less += saved
            out.append(total - less)
        return out

    def search(self, item: list[int], item_pairs: list, k: int, least: int, *, counts: list | None = None):
        """Places and scores of the ``k`` best documents of at least ``least``; ties by place.

        ``counts`` collects how many postings were opened as candidates.
        """
        import numpy as np

        held = sorted((t for t in item if t in self.lists), key=lambda t: (self.lists[t][2], t))
        if not held:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        # Documents on the pair lists of largest joint impact give a first threshold.
        lists = sorted((self.pairs[n] for n, _, _ in item_pairs if n in self.pairs), reverse=True)
        seeds, n_seeds = [], 0
        for _, begin, end in lists:
            if n_seeds >= 4 * k:
                break
            seeds.append(self.pair_places[begin:end])
            n_seeds += end - begin
        first = np.unique(np.concatenate(seeds)) if seeds else np.empty(0, dtype=np.int32)
        if len(first) >= k:
            scores = np.zeros(len(first), dtype=np.int64)
            for t in held:
                self.add(scores, first, t)
            least = max(least, int(np.partition(scores, len(scores) - k)[len(scores) - k]))
        bounds = self.bounds(held, item_pairs)
        if bounds[-1] < least:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        # Terms that cannot reach the threshold together open no candidates.
        free = max(p for p, bound in enumerate(bounds) if bound < least)
        total = np.zeros(len(self.doc_ids), dtype=np.int64)
        for t in held[free:]:
            begin, end, _ = self.lists[t]
            total[self.places[begin:end]] += self.impacts[begin:end]
            if counts is not None:
                counts.append(end - begin)
        candidates = np.flatnonzero(total + bounds[free] >= least) if free else np.flatnonzero(total >= least)
        candidates = candidates[total[candidates] > 0]
        scores = total[candidates]
        for p in range(free - 1, -1, -1):
            self.add(scores, candidates, held[p])
            left = scores + bounds[p] >= least
            candidates, scores = candidates[left], scores[left]
        if len(scores) > k:
            cut = np.partition(scores, len(scores) - k)[len(scores) - k]
            left = scores >= cut
            candidates, scores = candidates[left], scores[left]
        best = np.lexsort((candidates, -scores))[:k]
        return candidates[best], scores[best]


def search_shards(shards: DataFrame, items: list[tuple[int, list[int]]], item_pairs: dict, k: int) -> DataFrame:
    """n, doc_id and score of the best documents that each shard has for each item."""
    id_type = shards.schema["doc_ids"].dataType.elementType.simpleString()

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        best: dict[int, object] = {}
        for b in batches:
            for _, row in b.iterrows():
                own, found = Shard(row), []
                for n, item in items:
                    seen = best.get(n)
                    least = int(seen[-1]) if seen is not None and len(seen) == k else 1
                    places, scores = own.search(item, item_pairs[n], k, least)
                    if len(scores):
                        merged = scores if seen is None else np.concatenate([seen, scores])
                        best[n] = -np.sort(-merged)[:k]
                        found += [(n, own.doc_ids[p], s) for p, s in zip(places.tolist(), scores.tolist())]
                yield pd.DataFrame(found, columns=["n", "doc_id", "score"])

    return map_pandas(shards, step, f"n long, doc_id {id_type}, score long")


def rank(
    docs: DataFrame,
    items: DataFrame,
    *,
    k: int = 10,
    heavy: int = 8,
    block_bytes: int = 4 << 20,
    shard_postings: int = 500_000,
) -> DataFrame:
    """item_id, rank, doc_id and score: the ``k`` best documents of each row of ``items``, score above 0.

    Items go in blocks of about ``block_bytes`` of text, each against all
    documents; pairs are those of an item's ``heavy`` terms of largest weight.
    NULL and empty texts have no terms: such a document is never found and not
    counted, such an item finds nothing.  Texts of any length count whole.
    Repeated rows are documents or items of their own; equal scores go by
    ascending doc_id, NULL last.  An empty table gives no rows; other columns
    are ignored.
    """
    import numpy as np

    own_items = stage(items.select("item_id", "text"), "items").withColumn("n", F.monotonically_increasing_id())
    size = own_items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // block_bytes))
    blocks = own_items.withColumn("block", F.pmod(F.xxhash64("n"), F.lit(n_blocks)))
    found = []
    for block in range(n_blocks):
        rows = blocks.where(F.col("block") == block).select("n", "text").collect()  # about block_bytes
        vocabulary: dict[bytes, int] = {}
        numbered = []
        for r in rows:
            own = dict.fromkeys(terms(r.text))
            numbered.append((r.n, [vocabulary.setdefault(t, len(vocabulary)) for t in own]))
        if not vocabulary:
            continue
        counted = count_terms(docs, vocabulary)
        n_terms, n_docs = counted.where("kind = 's'").agg(F.sum("n"), F.sum("df")).first()
        if not n_terms:
            continue
        weights = np.full(len(vocabulary), weight(n_docs, 0), dtype=np.int64)
        for r in counted.where("kind = 't'").groupBy("n").agg(F.sum("df").alias("df")).collect():  # one row a term
            weights[r.n] = weight(n_docs, r.df)
        pairs: dict[tuple[int, int], int] = {}
        item_pairs = {}
        for n, item in numbered:
            top = sorted(item, key=lambda t: (-weights[t], t))[:heavy]
            item_pairs[n] = [(pairs.setdefault(p, len(pairs)), *p) for p in combinations(sorted(top), 2)]
        shards = build_shards(counted, weights, list(pairs), n_docs, n_terms, shard_postings)
        found.append(stage(search_shards(shards, numbered, item_pairs, k), "found_documents"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    best = docs.sparkSession.createDataFrame([], f"n long, doc_id {id_type}, score long")
    for f in found:
        best = best.unionByName(f)
    ranks = F.row_number().over(Window.partitionBy("n").orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    kept = best.withColumn("rank", ranks).where(F.col("rank") <= k)
    return kept.join(own_items.select("n", "item_id"), "n").select("item_id", "rank", "doc_id", "score")
