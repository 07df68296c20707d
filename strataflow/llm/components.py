"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.session import stage


def _smallest(pairs: DataFrame) -> DataFrame:
    """For pairs (u, v) the smallest v or u of each u, as (u, m).  Partial sums keep hot nodes cheap."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of ``edges`` (u, v); the root is the smallest node reachable.

    Large-star and small-star steps in turn: every node is tied to the smallest
    of its neighbours until only stars are left.  The table of edges never grows
    beyond its first size, each step is two shuffles of pairs, and each step's
    result is a written table.  Self loops and repeated edges are allowed.
    """
    pairs = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    pairs = stage(pairs, "edges")
    seen = None
    while True:
        # Large star: neighbours above a node go to its smallest neighbour.
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.where("v > u").join(_smallest(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        # Small star: a node and its neighbours below go to the smallest of them.
        low = _smallest(large)
        small = (
            large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct()
        )
        pairs = stage(small, "edges")
        now = pairs.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.count_distinct("u")
        ).first()
        if now == seen:
            break
        seen = now
    roots = pairs.select(F.col("v").alias("node")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        roots.select("node", F.col("node").alias("root"))
    )
