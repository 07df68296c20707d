"""Nearest vectors through randomly rotated one-bit codes."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import map_pandas
from strataflow.session import stage


def rotation(dim: int, seed: int = 7):
    """A random orthogonal matrix, the same for a dimension in every task."""
    import numpy as np

    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def usable(vector: str) -> Column:
    """Whether a vector takes part: there, not empty, all components finite, not all zero."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(v, lambda x: x != 0), F.lit(False))


def peak_exponent(vectors: DataFrame) -> int:
    """The power of two above the largest component of all rows."""
    largest = vectors.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0]
    return math.frexp(largest)[1] if largest else 0


def centres(vectors: DataFrame, power: int) -> dict[int, list[float]]:
    """The mean vector for each dimension, over all rows: one row per dimension and task is summed.

    Components are divided by 2^``power``, so none is above 1.
    """

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        sums: dict[int, tuple] = {}
        for b in batches:
            for dim, rows in _by_dimension(b["v"]):
                total, n = sums.get(dim, (np.zeros(dim), 0))
                sums[dim] = total + np.ldexp(rows[1], -power).sum(axis=0), n + len(rows[0])
        for dim, (total, n) in sums.items():
            yield pd.DataFrame({"dim": [dim], "total": [total.tolist()], "n": [n]})

    parts = map_pandas(vectors.select("v"), step, "dim int, total array<double>, n long")
    each = parts.select("dim", "n", F.posexplode("total").alias("k", "x"))
    rows = each.groupBy("dim", "k").agg(F.sum("x").alias("x"), F.sum("n").alias("n")).collect()
    out: dict[int, list[float]] = {}
    for r in rows:
        out.setdefault(r.dim, [0.0] * r.dim)[r.k] = r.x / r.n
    return out


def _by_dimension(vectors):
    """(dimension, (row numbers, matrix)) for the vectors of a batch."""
    import numpy as np

    lengths = np.fromiter(map(len, vectors), dtype=np.int64, count=len(vectors))
    values = vectors.to_numpy()
    for dim in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == dim)
        yield dim, (rows, np.array([np.asarray(values[k], dtype=np.float64) for k in rows]))


def encode(matrix, centre, turn):
    """Packed signs of the rotated unit residuals, their norms, and what the codes keep of them.

    ``kept`` is the inner product of a unit residual with its code's unit vector;
    it scales every estimate made from the code.
    """
    import numpy as np

    residual = matrix - np.asarray(centre)
    norm = np.sqrt((residual * residual).sum(axis=1))
    turned = (residual / np.where(norm > 0, norm, 1.0)[:, None]) @ turn
    kept = np.abs(turned).sum(axis=1) / np.sqrt(matrix.shape[1])
    return np.packbits(turned > 0, axis=1), norm, kept


def build_index(vectors: DataFrame, *, vec_id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, dict, int]:
    """Every usable vector with its code and correction scalars, the centres, and the power of two of their scale.

    Columns id, v, dim, code, norm, kept.  Codes and scalars are those of the
    vectors divided by the power of two above the largest component, so that no
    finite vector makes a square overflow.  The rotation is drawn, the centre is
    the mean of all rows: nothing is fitted on a sample.
    """
    rows = vectors.where(usable(vector)).select(F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v"))
    power = peak_exponent(rows)
    mean = centres(rows, power)
    id_type = rows.schema["id"].dataType.simpleString()

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        for b in batches:
            for dim, (at, matrix) in _by_dimension(b["v"]):
                code, norm, kept = encode(np.ldexp(matrix, -power), mean[dim], rotation(dim))
                yield pd.DataFrame(
                    {
                        "id": b["id"].to_numpy()[at], "v": b["v"].to_numpy()[at], "dim": dim,
                        "code": [c.tobytes() for c in code], "norm": norm, "kept": kept,
                    }
                )

    schema = f"id {id_type}, v array<double>, dim int, code binary, norm double, kept double"
    return stage(map_pandas(rows, step, schema), "vector_codes"), mean, power


def distances(matrix, query):
    """Euclidean distances in double precision, components added in order.

    Where a square leaves the range of doubles, differences are scaled first.
    """
    import numpy as np

    total = np.zeros(len(matrix))
    with np.errstate(over="ignore", under="ignore"):
        for j in range(matrix.shape[1]):
            d = matrix[:, j] - query[j]
            total += d * d
    out = np.sqrt(total)
    odd = np.flatnonzero((total < 1e-290) | ~np.isfinite(total))
    if len(odd):
        # Halves, so that the difference of the largest vectors is finite too.
        d = np.abs(matrix[odd] / 2 - query / 2)
        most = d.max(axis=1)
        safe = np.where(most > 0, most, 1.0)
        with np.errstate(over="ignore"):
            out[odd] = 2 * (most * np.sqrt(((d / safe[:, None]) ** 2).sum(axis=1)))
    return out


def _search_block(index: DataFrame, mean: dict, power: int, queries: list, k: int, sure: float) -> DataFrame:
    """The ``k`` nearest rows of each task for each query of a block."""

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        asked: dict[int, dict] = {}
        for n, (_, v) in enumerate(queries):
            asked.setdefault(len(v), {"at": [], "v": []})
            asked[len(v)]["at"].append(n)
            asked[len(v)]["v"].append(v)
        for dim, own in asked.items():
            own["v"] = np.array(own["v"], dtype=np.float64)
            residual = np.ldexp(own["v"], -power) - np.asarray(mean[dim])
            own["norm"] = np.sqrt((residual * residual).sum(axis=1))
            own["turned"] = (residual / np.where(own["norm"] > 0, own["norm"], 1.0)[:, None]) @ rotation(dim)
        best: list = [(np.empty(0), np.empty(0, dtype=object)) for _ in queries]
        for b in batches:
            for dim, rows in b.groupby("dim"):
                if dim not in asked:
                    continue
                own, ids = asked[dim], rows["id"].to_numpy()
                vectors = np.array(rows["v"].tolist())
                norm, kept = rows["norm"].to_numpy(), rows["kept"].to_numpy()
                bits = np.unpackbits(np.frombuffer(b"".join(rows["code"]), dtype=np.uint8).reshape(len(rows), -1), axis=1)
                signs = (bits[:, :dim].astype(np.float32) * 2 - 1) / np.float32(np.sqrt(dim))
                safe = np.where(kept > 0, kept, 1.0)
                # How far an estimate may be off, with ``sure`` standard deviations.
                off = np.where(kept > 0, sure * np.sqrt(np.maximum(1 - safe * safe, 0) / max(dim - 1, 1)) / safe, 2.0)
                cosine = (signs @ own["turned"].T.astype(np.float32)).astype(np.float64) / safe[:, None]
                for q, n in enumerate(own["at"]):
                    squares = norm * norm + own["norm"][q] ** 2
                    scale = 2 * norm * own["norm"][q]
                    low = squares - scale * np.minimum(cosine[:, q] + off, 1.0)
                    high = squares - scale * np.maximum(cosine[:, q] - off, -1.0)
                    limit = np.partition(high, k)[k] if len(high) > k else np.inf  # one more: the query itself
                    if len(best[n][0]) == k:
                        limit = min(limit, np.ldexp(best[n][0][-1], -power) ** 2)
                    near = np.flatnonzero(low <= limit * (1 + 1e-9) + 1e-12)
                    near = near[ids[near] != queries[n][0]]
                    if len(near):
                        d = np.concatenate([best[n][0], distances(vectors[near], own["v"][q])])
                        i = np.concatenate([best[n][1], ids[near].astype(object)])
                        order = np.lexsort((i.astype(ids.dtype), d))[:k]
                        best[n] = d[order], i[order]
        for (query, _), (d, i) in zip(queries, best):
            if len(d):
                yield pd.DataFrame({"query_id": query, "vec_id": i.astype(np.int64), "score": d})

    candidates = index.select("id", "v", "dim", "code", "norm", "kept")
    return map_pandas(candidates, step, "query_id long, vec_id long, score double")


def search(
    vectors: DataFrame,
    is_query: Column,
    *,
    k: int = 10,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    sure: float = 4.0,
    block_queries: int = 512,
) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` nearest other rows of each row with ``is_query``.

    Every row is indexed and every row's code is compared with every query, in
    blocks of ``block_queries``.  A code estimates the inner product of the
    residuals; rows whose least possible distance, ``sure`` standard deviations
    below the estimate, is within the best found so far are compared exactly, on
    the original vectors.  A task returns ``k`` rows a query.

    Vectors that are NULL, empty, zero or hold a NULL or non-finite component
    take no part; vectors are compared with those of their own dimension; rows
    without id take no part.  Ids are whole numbers; rows that repeat an id are
    separate candidates but never their own query's.  Ties go to the smaller id.
    Fewer than ``k`` candidates give fewer rows, an empty table none.
    """
    taken = vectors.where(F.col(vec_id).isNotNull())
    index, mean, power = build_index(taken, vec_id=vec_id, vector=vector)
    asked = stage(
        taken.where(is_query & usable(vector)).select(
            F.col(vec_id).alias("id"), F.col(vector).cast("array<double>").alias("v")
        ).groupBy("id").agg(F.min("v").alias("v")),
        "query_vectors",
    )
    n = asked.count()
    found = None
    blocks = max(1, -(-n // block_queries))
    for block in range(blocks):
        some = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block)
        queries = [(r.id, r.v) for r in some.collect()]
        if queries or found is None:
            nearest = stage(_search_block(index, mean, power, queries, k, sure), "nearest")
            found = nearest if found is None else found.unionByName(nearest)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    ranked = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
