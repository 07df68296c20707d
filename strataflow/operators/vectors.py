"""Nearest neighbours by cosine distance, and the question memory."""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from datetime import datetime
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from strataflow.functions.vector import cosine_distance_to
from strataflow.session import stage


def nearest(
    vectors: DataFrame,
    query: Sequence[float],
    k: int = 3,
    *,
    vector: str = "embedding",
    tie: str = "id",
    digits: int | None = None,
) -> DataFrame:
    """The ``k`` rows closest to one query vector.

    Each task keeps its own ``k`` best rows, so the driver sees ``k`` per task.
    """
    distance = cosine_distance_to(vector, query)
    if digits is not None:
        distance = F.round(distance, digits)
    return (
        vectors.withColumn("distance", distance)
        .where(F.col("distance").isNotNull())
        .orderBy("distance", tie)
        .limit(k)
    )


def _valid(vector: str) -> Column:
    """Whether a vector can be compared: there, not empty, all components finite, not all zero."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def _best_in_tasks(vectors: DataFrame, block: list, k: int, digits: int, schema: T.StructType) -> DataFrame:
    """The ``k`` closest rows of each task for each (id, vector) of a block."""

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        best: list = [[] for _ in block]
        by_size: dict[int, list[int]] = {}
        for n, (_, v) in enumerate(block):
            by_size.setdefault(len(v), []).append(n)
        for batch in batches:
            sizes = batch["_v"].map(len).to_numpy()
            for size, asked in by_size.items():
                own = np.flatnonzero(sizes == size)
                if not len(own):
                    continue
                names = batch["_id"].to_numpy()[own].tolist()
                v = np.array([np.asarray(x, dtype="float64") for x in batch["_v"].to_numpy()[own]])
                v /= np.linalg.norm(v, axis=1)[:, None]
                for n in asked:
                    q = np.asarray(block[n][1], dtype="float64")
                    dist = np.round(1.0 - v @ (q / np.linalg.norm(q)), digits) + 0.0
                    kth = min(k, len(dist)) - 1
                    near = np.flatnonzero(dist <= np.partition(dist, kth)[kth])
                    found = best[n] + [(float(dist[i]), names[i]) for i in near]
                    best[n] = heapq.nsmallest(k, found)
        for (name, _), rows in zip(block, best):
            if rows:
                yield pd.DataFrame({"_q": name, "_id": [i for _, i in rows], "distance": [d for d, _ in rows]})

    return vectors.mapInPandas(step, schema)


def nearest_batch(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 3,
    *,
    query_id: str,
    vector_id: str,
    vector: str = "embedding",
    digits: int = 6,
    block_bytes: int = 16 << 20,
) -> DataFrame:
    """The ``k`` closest rows for each query vector.

    Queries go to the tasks in blocks of about ``block_bytes``, with a pass over
    the table for each, so their number has no limit.  A task keeps its ``k``
    best rows per query; what is shuffled is those, never the pairs.  Ids are of
    any type with an order.  Vectors that are NULL, empty, zero or hold a NULL or
    non-finite component take no part, and only vectors of equal length meet.
    """
    asked = stage(queries.where(_valid(vector)).select(F.col(query_id).alias("_q"), F.col(vector).alias("_v")), "queries")
    schema = T.StructType(
        [
            T.StructField("_q", queries.schema[query_id].dataType),
            T.StructField("_id", vectors.schema[vector_id].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )
    own = vectors.where(_valid(vector) & F.col(vector_id).isNotNull()).select(
        F.col(vector_id).alias("_id"), F.col(vector).alias("_v")
    )
    size = asked.agg(F.sum(F.size("_v") * 8 + 64)).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    found = []
    for n in range(blocks):
        block = [tuple(r) for r in asked.where(F.pmod(F.xxhash64("_q"), F.lit(blocks)) == n).collect()]
        found.append(_best_in_tasks(own, block, k, digits, schema))
    candidates = reduce(DataFrame.unionByName, found)
    rank = F.row_number().over(Window.partitionBy("_q").orderBy("distance", "_id"))
    return (
        candidates.withColumn("neighbour_rank", rank)
        .where(F.col("neighbour_rank") <= k)
        .select(
            F.col("_q").alias("query_id"),
            "neighbour_rank",
            F.col("_id").alias("neighbour_id"),
            "distance",
        )
    )


def remember(pairs: DataFrame, created_at: datetime | str) -> DataFrame:
    """Rows for the memory table: question, query and embedding, with id and time.

    The id is a hash of the row, so that a retried write gives the same rows.
    """
    return pairs.select(
        F.md5(F.concat_ws("|", "question", "query", F.lit(str(created_at)))).alias("id"),
        "question",
        "query",
        F.col("embedding").cast("array<float>").alias("embedding"),
        F.lit(str(created_at)).cast("timestamp").alias("created_at"),
    )
