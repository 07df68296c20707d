"""What keys a partition may hold: Bloom filters and bounds, as tables.

A filter is a row per block of 256 bits.  A key sets eight bits of one block of
its partition, chosen by one hash, at places chosen by another.  Filters have 32
bits a key or more; a key that is not there is taken for one that is about once
in 100,000 times.  That costs a look into the partition, never a row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.session import stage

WORDS = 4
BITS_SET = 8
KEYS_A_BLOCK = 8


def _hashed(keys: Sequence[str]) -> list[Column]:
    """The hash that chooses a block, and the words of the bits to set."""
    block, places = F.xxhash64(*keys), F.xxhash64(*keys, F.lit("places"))
    masks = []
    for word in range(WORDS):
        mask = F.lit(0).cast("long")
        for k in range(BITS_SET):
            at = F.shiftright(F.col("_places"), 8 * k).bitwiseAND(F.lit(255))
            bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
            mask = mask.bitwiseOR(F.when(F.shiftright(at, 6) == word, bit).otherwise(F.lit(0).cast("long")))
        masks.append(mask.alias(f"_m{word}"))
    return [block.alias("_hash"), places.alias("_places"), *masks]


def _masked(rows: DataFrame, keys: Sequence[str], *more: str | Column) -> DataFrame:
    block, places, *masks = _hashed(keys)
    return rows.select(*more, F.col(keys[0]).alias("_key"), block, places).select("*", *masks).drop("_places")


def summarise(rows: DataFrame, keys: Sequence[str], partition: str) -> DataFrame:
    """Filter blocks and bounds of the first key, for each partition of ``rows``.

    Columns ``partition``, ``_value`` (the partition as text), ``_blocks``,
    ``_block``, ``_w0`` to ``_w3``, ``_least``, ``_most``.
    """
    bounds = rows.groupBy(partition).agg(
        F.count(F.lit(1)).alias("_n"), F.min(keys[0]).alias("_least"), F.max(keys[0]).alias("_most")
    )
    # Powers of two, so that a batch is hashed for few numbers of blocks.
    power = F.ceil(F.log2(F.greatest(F.ceil(F.col("_n") / F.lit(KEYS_A_BLOCK)), F.lit(1))))
    blocks = F.call_function("shiftleft", F.lit(1).cast("long"), power.cast("int"))
    sized = stage(bounds.withColumn("_blocks", blocks).drop("_n"), "key-bounds")
    own = _masked(rows, keys, F.col(partition).alias("_own"))
    dealt = own.join(sized, F.col("_own").eqNullSafe(F.col(partition)))
    return (
        dealt.withColumn("_block", F.pmod("_hash", "_blocks"))
        .groupBy(partition, "_blocks", "_block")
        .agg(
            *[F.bit_or(f"_m{w}").alias(f"_w{w}") for w in range(WORDS)],
            F.first("_least").alias("_least"), F.first("_most").alias("_most"),
        )
        .withColumn("_value", F.col(partition).cast("string"))
    )


def may_hold(summaries: DataFrame, updates: DataFrame, keys: Sequence[str]) -> list[str | None]:
    """The partitions, as text, that may hold a key of ``updates``: one value each."""
    sizes = [r[0] for r in summaries.select("_blocks").distinct().collect()]  # powers of two: 63 at most
    if not sizes:
        return []
    probes = (
        _masked(updates, keys)
        .withColumn("_blocks", F.explode(F.array(*[F.lit(s).cast("long") for s in sizes])))
        .withColumn("_block", F.pmod("_hash", "_blocks"))
    )
    bits = F.lit(True)
    for w in range(WORDS):
        bits = bits & (F.col(f"_w{w}").bitwiseAND(F.col(f"_m{w}")) == F.col(f"_m{w}"))
    inside = F.col("_key").between(F.col("_least"), F.col("_most"))
    hits = probes.join(summaries, ["_blocks", "_block"]).where(bits & inside)
    return [r[0] for r in hits.select("_value").distinct().collect()]
