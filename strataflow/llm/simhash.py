"""Near duplicates by SimHash, found through a grid of segment bit counts."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import map_pandas, one_each, spare_name
from strataflow.llm.components import components
from strataflow.session import stage

#: Every second bit, as a signed 64-bit number.
ODD_BITS = 0x5555555555555555
#: Two bits count a segment of two bits; 16 segments are one half of a fingerprint.
SEGMENTS = 16


def _ascii_lower_words(text: str) -> list[bytes]:
    """Words of the lower-cased text; bytes.split() parts at space and tab to carriage return."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The SimHash of a whole text as a signed 64-bit number."""
    import numpy as np
    import xxhash

    words = _ascii_lower_words(text) if text else []
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    set_bits, size = np.zeros(64, dtype=np.int64), 65_536
    for at in range(0, n, size):  # a very long text goes through in pieces
        some = words[at : at + size + shingle - 1]
        grams = some if shingle == 1 else map(b" ".join, zip(*(some[k:] for k in range(shingle))))
        if len(words) < shingle:
            grams = [b" ".join(words)]
        hashes = np.array([xxhash.xxh64_intdigest(g, 42) for g in grams], dtype="<u8")
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * set_bits > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, a hash of the text, and the fingerprint of every row."""

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [fingerprint(t, shingle) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "text_hash": b["text_hash"], "fp": pd.Series(found, dtype="int64")})

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return map_pandas(rows, step, f"doc_id {id_type}, text_hash long, fp long")


def bit_counts(fp: Column) -> Column:
    """The bit count of each two-bit segment, in the two bits of the segment."""
    shifted, lower = F.shiftrightunsigned(fp, 1), F.lit(ODD_BITS)
    one = fp.bitwiseXOR(shifted).bitwiseAND(lower)
    two = F.shiftleft(fp.bitwiseAND(shifted).bitwiseAND(lower), 1)
    return one.bitwiseOR(two)


def _half(counts: Column, half: int) -> Column:
    return F.shiftrightunsigned(counts, 32 * half).bitwiseAND(F.lit(0xFFFFFFFF))


def _cells_around(cell: Column) -> Column:
    """The cells at Manhattan distance 1: one segment's count, 0 to 2, up or down by one."""
    moved = []
    for k in range(SEGMENTS):
        one = F.lit(1 << (2 * k))
        count = F.shiftright(cell, 2 * k).bitwiseAND(F.lit(3))
        moved += [F.when(count < 2, cell + one), F.when(count > 0, cell - one)]
    return F.array_compact(F.array(cell, *moved))


def _total(cell: Column) -> Column:
    """Bits set in the half of a fingerprint whose counts are given."""
    ones = F.bit_count(cell.bitwiseAND(F.lit(0x55555555)))
    return ones + 2 * F.bit_count(cell.bitwiseAND(F.lit(0xAAAAAAAA)))


def _steps(fps: DataFrame) -> DataFrame:
    """Links that tie all fingerprints at 2 or fewer differing bits, in chains.

    Two of them share a neighbour: a 64-bit word at one bit or none from each.
    Rows that meet at a word differ by 2 bits at most, so each is tied to the
    next only; a dense clump gives 65 rows a member, not its pairs.
    """
    words = F.array(F.col("fp"), *(F.col("fp").bitwiseXOR(F.shiftleft(F.lit(1).cast("long"), k)) for k in range(64)))
    before = F.lag("fp").over(Window.partitionBy("word").orderBy("fp"))
    met = fps.select("fp", F.explode(words).alias("word")).select("fp", before.alias("other"))
    return met.where("other is not null").select(F.col("fp").alias("u"), F.col("other").alias("v"))


def linked_cells(fps: DataFrame, most: int = 3) -> DataFrame:
    """Pairs of fingerprints at ``most`` (3) differing bits or fewer, of different ``root``.

    The bit counts of 32 two-bit segments are a point whose Manhattan distance
    from another is a lower bound of the differing bits.  At 3 or fewer, one of
    the two halves of 16 segments is at distance 1 or less, so the pair meets in
    a cell of that half's grid: the halves with an even number of bits go to all
    cells around theirs as well, since a step of 1 changes evenness.  Each pair
    meets once, is held to the bound over all segments, then to the bits.
    """
    if not 0 <= most <= 3:
        raise ValueError("halves at distance 1 cover up to 3 differing bits")
    counts = fps.withColumn("counts", bit_counts(F.col("fp")))
    home, around = [], []
    for half in (0, 1):
        own = counts.withColumn("half", F.lit(half)).withColumn("cell", _half(F.col("counts"), half))
        home.append(own)
        even = _total(F.col("cell")) % 2 == 0
        cells = F.when(even, _cells_around(F.col("cell"))).otherwise(F.array("cell"))
        around.append(own.withColumn("own", F.col("cell")).withColumn("cell", F.explode(cells)))
    a = around[0].unionByName(around[1]).alias("a")
    b = home[0].unionByName(home[1]).alias("b")

    def apart(half: int) -> Column:
        # Manhattan distance of two halves: segment counts compared two bits at a time.
        x, y = _half(F.col("a.counts"), half), _half(F.col("b.counts"), half)
        out = F.lit(0)
        for k in range(SEGMENTS):
            out = out + F.abs(
                F.shiftright(x, 2 * k).bitwiseAND(F.lit(3)) - F.shiftright(y, 2 * k).bitwiseAND(F.lit(3))
            )
        return out

    differing = F.bit_count(F.col("a.fp").bitwiseXOR(F.col("b.fp")))
    same_cell = F.col("a.own") == F.col("a.cell")
    meets = (
        (F.col("a.half") == F.col("b.half"))
        & (F.col("a.cell") == F.col("b.cell"))
        & (F.col("a.root") != F.col("b.root"))
        & (~same_cell | (F.col("a.fp") < F.col("b.fp")))
        & (differing <= most)
        & (apart(0) + apart(1) <= most)
        & ((F.col("a.half") == 0) | (apart(0) > 1))
    )
    return a.join(b, meets).select(F.col("a.root").alias("u"), F.col("b.root").alias("v"))


def group(docs: DataFrame, *, shingle: int = 3, most: int = 3) -> DataFrame:
    """doc_id, text_hash, fp, class_fp and component_id of every row of ``docs``.

    Rows whose fingerprints differ in ``most`` bits or fewer are linked; a
    component is what links reach.  ``component_id`` is its smallest doc_id and
    NULL if all its ids are NULL; ``class_fp`` names the component even then.
    NULL and empty texts have fingerprint 0 and are linked like others.  Rows
    that repeat an id or a text are linked rows like any.  An empty table gives
    no rows; columns other than doc_id and text are ignored.

    Equal fingerprints are one node, so exact copies give no pairs.  Links of 2
    bits are chained first; only fingerprints still apart then meet in the grid,
    so near copies by the thousand give no pairs either.
    """
    rows = stage(fingerprints(docs, shingle), "fingerprints")
    nodes = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "fp_nodes")
    own = nodes.select("fp", F.col("fp").alias("root"))
    close = stage(components(_steps(own)), "near_roots") if most >= 2 else None
    if close is not None:
        tied = close.select(F.col("node").alias("fp"), F.col("root").alias("tied"))
        own = own.join(tied, "fp", "left").select("fp", F.coalesce("tied", "root").alias("root"))
    own = stage(own, "fp_roots")
    far = stage(components(linked_cells(own, most)), "far_roots")
    classes = (
        own.join(far.withColumnRenamed("root", "class_fp"), own["root"] == far["node"], "left")
        .select("fp", F.coalesce("class_fp", "root").alias("class_fp"))
        .join(nodes, "fp")
    )
    classes = stage(classes, "fp_classes")
    least = classes.groupBy("class_fp").agg(F.min("least").alias("component_id"))
    of_fp = stage(classes.select("fp", "class_fp").join(least, "class_fp"), "fp_components")
    return rows.join(of_fp, "fp").select("doc_id", "text_hash", "fp", "class_fp", "component_id")


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id, then by hash of the text.

    Same columns; rows keep their values.  Only ids and hashes are shuffled, and
    the texts of rows that stay and occur more than once.
    """
    groups = group(docs, **settings)
    pick = F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "text_hash")).alias("k")
    rows = stage(groups, "groups")
    kept = rows.groupBy("class_fp").agg(pick).select("k.doc_id", "k.text_hash")
    # Two components never share a text, so (doc_id, text_hash) names one.
    many = rows.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    kept = stage(kept, "kept")
    k = kept.alias("k")
    own = spare_name(docs, "_text_hash")
    d = docs.withColumn(own, F.xxhash64("text")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("k.doc_id")) & (F.col(f"d.{own}") == F.col("k.text_hash"))
    left = d.join(k, same, "left_semi")
    repeated = stage(many.select("doc_id", F.col("text_hash").alias(own)), "repeated")
    return one_each(left, ["doc_id", own], repeated).select(docs.columns)
