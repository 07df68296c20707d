"""A memory of vectors kept as inverted lists, and exact nearest neighbours that skip lists.

Directions are points of the unit sphere, each in the list of its closest centre and stored
with its distance to it.  By the triangle inequality a query at distance ``a`` from a centre is
at least ``|a - b|`` from a row stored with ``b``, so lists and rows too far away for the ``k``
best found so far need not be compared.  Centres only steer the cost: results are those of
``nearest_batch``, whatever they were fitted on.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strataflow.operators.vectors import _valid
from strataflow.session import stage
from strataflow.sources.tables import TableStore

LIST, APART = "_list", "_apart"
#: List of what has no place among the centres: vectors of another length, or that cannot be compared.
ODD = -1
# Rounding of a chord near zero is of the order of the root of a double's precision.
SLACK = 1e-6
CELLS = 4_000_000


def _units(rows: list) -> np.ndarray:
    v = np.array([np.asarray(r, dtype="float64") for r in rows])
    v = v / np.abs(v).max(axis=1)[:, None]
    return v / np.linalg.norm(v, axis=1)[:, None]


def _chords(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


def fit_centres(vectors: DataFrame, lists: int, *, key: str, vector: str, sample_rows: int = 16_384, rounds: int = 6) -> np.ndarray:
    """Centres of at most ``lists`` groups of directions, from the ``sample_rows`` rows of smallest key hash.

    Only that sample, whose size is the parameter, reaches the driver; vectors of another
    length than most of it are left out.
    """
    picked = (
        vectors.where(_valid(vector) & F.col(key).isNotNull())
        .orderBy(F.xxhash64(key), F.xxhash64(vector))
        .select(vector)
        .limit(sample_rows)
        .collect()
    )
    if not picked:
        return np.zeros((0, 0))
    sizes = [len(r[0]) for r in picked]
    common = max(set(sizes), key=lambda s: (sizes.count(s), s))
    points = _units([r[0] for r in picked if len(r[0]) == common])
    centres = points[np.linspace(0, len(points) - 1, min(lists, len(points))).astype(int)]
    for _ in range(rounds):
        own = (points @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, points)
        length = np.linalg.norm(sums, axis=1)
        centres = np.where((length > 1e-9)[:, None], sums / np.maximum(length, 1e-9)[:, None], centres)
    return np.unique(centres, axis=0)


def assign(rows: DataFrame, centres: np.ndarray, *, vector: str) -> DataFrame:
    """Rows with the list of the closest centre and the distance to it."""
    size = centres.shape[1]

    @F.pandas_udf("list int, apart double")
    def place(v: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"list": np.full(len(v), ODD, dtype="int32"), "apart": np.zeros(len(v))})
        own = np.flatnonzero([x is not None and len(x) == size for x in v])
        for at in range(0, len(own), max(1, CELLS // max(1, len(centres)))):
            some = own[at : at + max(1, CELLS // max(1, len(centres)))]
            apart = _chords(_units(v.iloc[some].tolist()), centres)
            best = apart.argmin(axis=1)
            out.iloc[some, 0] = best.astype("int32")
            out.iloc[some, 1] = apart[np.arange(len(some)), best]
        return out

    placed = rows.withColumn("_place", place(F.when(_valid(vector), F.col(vector))))
    return placed.select(*rows.columns, F.col("_place.list").alias(LIST), F.col("_place.apart").alias(APART))


def _best(rows: DataFrame, block: list, wanted: dict, within: np.ndarray, apart: np.ndarray, k: int, digits: int, schema: T.StructType) -> DataFrame:
    """The ``k`` closest rows of each task for each query, each list against the queries that want it.

    ``wanted`` maps a list to its queries, ``within`` is the distance each query still asks for,
    ``apart`` the distance of queries to centres.
    """

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best: list = [[] for _ in block]

        def meet(names: list, v: np.ndarray, gaps: np.ndarray, number: int, asked: list) -> None:
            chunk = max(1, CELLS // len(v))
            for at in range(0, len(asked), chunk):
                some = asked[at : at + chunk]
                dist = np.round(1.0 - v @ _units([block[n][1] for n in some]).T, digits) + 0.0
                for j, n in enumerate(some):
                    near = np.arange(len(v))
                    if number != ODD:
                        near = np.flatnonzero(np.abs(gaps - apart[n, number]) <= within[n] + SLACK)
                    if not len(near):
                        continue
                    own = dist[near, j]
                    kth = min(k, len(own)) - 1
                    near = near[own <= np.partition(own, kth)[kth]]
                    found = best[n] + [(float(dist[i, j]), names[i]) for i in near]
                    best[n] = heapq.nsmallest(k, found)

        for batch in batches:
            sizes = batch["_v"].map(len).to_numpy()
            kinds = pd.DataFrame({"l": batch[LIST].to_numpy(), "s": sizes})
            for (number, size), own in kinds.groupby(["l", "s"]).indices.items():
                asked = [n for n in wanted.get(int(number), ()) if len(block[n][1]) == size]
                if asked:
                    some = batch.iloc[own]
                    meet(some["_id"].tolist(), _units(some["_v"].tolist()), some[APART].to_numpy(), int(number), asked)
        for (name, _), found in zip(block, best):
            if found:
                yield pd.DataFrame({"_q": name, "_id": [i for _, i in found], "distance": [d for d, _ in found]})

    return rows.where(F.col(LIST).isin([int(n) for n in wanted])).mapInPandas(step, schema)


class VectorMemory:
    """A table of rows with vectors in inverted lists, beside it the centres and the reach of each list.

    ``lists`` centres are fitted on the first batch that holds a comparable vector; later batches
    are appended to their lists and change no file written before.  A memory that has grown unlike
    its first batch stays exact but reads more; ``refit`` makes one with new centres.
    The reach is written before the rows, so a batch that failed in between, or is repeated, only widens it.
    """

    def __init__(self, store: TableStore, name: str, *, key: str = "id", vector: str = "embedding", lists: int = 256):
        self.store, self.name, self.key, self.vector, self.lists = store, name, key, vector, lists
        #: Of the last search: lists with rows, and pairs of query and list that were there and that were read.
        self.read_share: dict[str, int] = {}

    def _centres(self) -> np.ndarray:
        rows = self.store.read_or_none(f"{self.name}_centres")
        found = [] if rows is None else rows.orderBy(LIST).collect()
        return np.array([r.centre for r in found]) if found else np.zeros((0, 0))

    def _fit(self, rows: DataFrame) -> np.ndarray:
        centres = fit_centres(rows, self.lists, key=self.key, vector=self.vector)
        if len(centres):
            made = [(n, [float(x) for x in c]) for n, c in enumerate(centres)]
            frame = self.store.spark.createDataFrame(made, f"{LIST} int, centre array<double>")
            self.store.write(f"{self.name}_centres", frame.coalesce(1))
        return centres

    def append(self, rows: DataFrame) -> None:
        """Add rows to their lists; a batch without rows changes nothing."""
        if rows.isEmpty():
            return
        centres = self._centres()
        if not len(centres):
            centres = self._fit(rows)
        placed = stage(assign(rows, centres, vector=self.vector), "memory-rows")
        reach = placed.groupBy(LIST).agg(F.min(APART).alias("low"), F.max(APART).alias("high"))
        self.store.append(f"{self.name}_reach", reach)
        self.store.append(self.name, placed, partition_by=[LIST])

    def read(self) -> DataFrame:
        """The rows as they were given."""
        return self.store.read(self.name).drop(LIST, APART)

    def refit(self, name: str) -> VectorMemory:
        """A memory of another name with the same rows, its centres fitted on all of them.

        This one stays as it is, so whoever reads it meanwhile is not disturbed.
        """
        other = VectorMemory(self.store, name, key=self.key, vector=self.vector, lists=self.lists)
        other.append(self.read())
        return other

    def nearest(self, queries: DataFrame, k: int = 3, *, query_id: str, digits: int = 6, probe: int = 1, block_bytes: int = 16 << 20) -> DataFrame:
        """What ``nearest_batch`` gives over all rows, reading the lists that can hold a result.

        The ``probe`` closest lists of each query are read first; the distance of its ``k``-th
        row so far then rules out other lists, and rows of those that are left.  Queries go
        in blocks of about ``block_bytes``, one after the other.  A memory without rows has no
        neighbours to give, and names them by the type of the query's id.
        """
        if not self.store.exists(self.name):
            empty = queries.select(F.col(query_id).alias("query_id"), F.lit(1).alias("neighbour_rank"), F.col(query_id).alias("neighbour_id"), F.lit(0.0).alias("distance"))
            return empty.limit(0)
        spark = self.store.spark
        v = self.vector
        asked = stage(queries.where(_valid(v)).select(F.col(query_id).alias("_q"), F.col(v).alias("_v")), "queries")
        rows = self.store.read(self.name)
        rows = rows.where(_valid(v) & F.col(self.key).isNotNull()).select(F.col(self.key).alias("_id"), F.col(v).alias("_v"), LIST, APART)
        fields = [("_q", asked.schema["_q"].dataType), ("_id", rows.schema["_id"].dataType), ("distance", T.DoubleType())]
        schema = T.StructType([T.StructField(n, t) for n, t in fields])
        reach = {r[LIST]: (r.low, r.high) for r in self.store.read(f"{self.name}_reach").groupBy(LIST).agg(F.min("low").alias("low"), F.max("high").alias("high")).collect()}
        centres = self._centres()
        numbers = sorted(n for n in reach if n != ODD)
        self.read_share = {"lists": len(reach), "pairs": 0, "read": 0}
        size = asked.agg(F.sum(F.size("_v") * 8 + 64)).first()[0] or 0
        blocks = max(1, -(-size // block_bytes))
        found: list[DataFrame] = []
        for b in range(blocks):
            block = [tuple(r) for r in asked.where(F.pmod(F.xxhash64("_q"), F.lit(blocks)) == b).collect()]
            if block:
                found += self._search(rows, block, centres, numbers, reach, k, digits, probe, schema)
        candidates = spark.createDataFrame([], schema)
        for part in found:
            candidates = candidates.unionByName(part)
        rank = F.row_number().over(Window.partitionBy("_q").orderBy("distance", "_id"))
        return (
            candidates.withColumn("neighbour_rank", rank)
            .where(F.col("neighbour_rank") <= k)
            .select(F.col("_q").alias("query_id"), "neighbour_rank", F.col("_id").alias("neighbour_id"), "distance")
        )

    def _search(self, rows, block, centres, numbers, reach, k, digits, probe, schema) -> list[DataFrame]:
        inside = [n for n, (_, v) in enumerate(block) if len(centres) and len(v) == centres.shape[1]]
        apart = np.full((len(block), max(1, len(centres))), math.inf)
        least = np.full((len(block), len(numbers)), math.inf)
        if inside and numbers:
            apart[inside] = _chords(_units([block[n][1] for n in inside]), centres)
            low, high = (np.array([reach[m][side] for m in numbers]) for side in (0, 1))
            mine = apart[np.ix_(inside, numbers)]
            least[inside] = np.maximum(0.0, np.maximum(mine - high, low - mine))
        within = np.full(len(block), math.inf)
        wanted: dict[int, list[int]] = {}
        for n in inside:
            for at in np.lexsort((apart[n, numbers], least[n]))[:probe]:
                wanted.setdefault(numbers[at], []).append(n)
        odd = [n for n in range(len(block)) if n not in set(inside)]
        if odd and ODD in reach:
            wanted[ODD] = odd
        self.read_share["pairs"] += len(inside) * len(numbers) + len(odd)
        self.read_share["read"] += sum(map(len, wanted.values()))
        if not wanted:
            return []
        first = stage(_best(rows, block, wanted, within, apart, k, digits, schema), "memory-first")
        place: dict = {}
        for n, (name, _) in enumerate(block):
            place.setdefault(name, []).append(n)
        nth = F.row_number().over(Window.partitionBy("_q").orderBy("distance"))
        for r in first.withColumn("_k", nth).where(F.col("_k") == k).select("_q", "distance").collect():
            # Equal rounded distances are settled by id, so rows half a step further still count.
            within[place[r._q]] = math.sqrt(2 * max(0.0, r.distance + 0.5 * 10.0**-digits)) + SLACK
        seen = {(m, n) for m, own in wanted.items() for n in own}
        rest: dict[int, list[int]] = {}
        for n in inside:
            for at in np.flatnonzero(least[n] <= within[n] + SLACK):
                if (numbers[at], n) not in seen:
                    rest.setdefault(numbers[at], []).append(n)
        self.read_share["read"] += sum(map(len, rest.values()))
        if not rest:
            return [first]
        return [first, stage(_best(rows, block, rest, within, apart, k, digits, schema), "memory-rest")]
