"""Find passages of benchmark items in documents: a set join on each window's rarest word.

Only DataFrame functions: the join, its bounds and the check run inside the JVM.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import lower_ascii, spare_name
from strataflow.session import stage

#: A word is a run of ASCII letters, digits and characters beyond ASCII; this is what parts words.
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(text: str = "text") -> Column:
    """The words in order; no word for NULL.

    Texts are split at what parts words: ``regexp_extract_all`` keeps a match
    object for each word and takes some twenty times as long.
    """
    found = F.array_remove(F.split(lower_ascii(F.col(text)), APART), "")
    return F.coalesce(found, F.array().cast("array<string>"))


def item_windows(items: DataFrame, size: int) -> DataFrame:
    """item_id, window and its tokens: ``size`` words in a row, or a shorter item's words."""
    split = items.select("item_id", _words().alias("w")).where(F.size("w") > 0)
    k = F.least(F.size("w"), F.lit(size))
    started = split.select("item_id", "w", k.alias("k"), F.explode(F.sequence(F.lit(1), F.size("w") - k + 1)).alias("s"))
    tokens = started.select("item_id", F.slice("w", F.col("s"), F.col("k")).alias("tokens"))
    return tokens.withColumn("window", F.md5(F.concat_ws(" ", "tokens")))


def in_blocks(df: DataFrame, size: Column, key: str, block_bytes: int) -> list[DataFrame]:
    """``df`` in parts of about ``block_bytes`` by ``size``; each part fits a broadcast."""
    total = df.agg(F.sum(size)).first()[0] or 0
    n = max(1, -(-int(total) // block_bytes))
    if n == 1:
        return [df]
    return [df.where(F.pmod(F.xxhash64(key), F.lit(n)) == k) for k in range(n)]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def anchors(docs: DataFrame, windows: DataFrame, block_bytes: int) -> DataFrame:
    """window, tokens, k, and the rarest token with its place in the window.

    All k tokens of a window must occur, so the necessary prefix, in order of
    rarity, is one token.  Rarity is counted over all documents, for the words
    of the items only.
    """
    vocabulary = stage(windows.select(F.explode("tokens").alias("word")).distinct(), "item_words")
    each_word = docs.select(F.explode(_words()).alias("word"))
    counted = _union(
        [
            each_word.join(F.broadcast(v), "word", "left_semi").groupBy("word").count()
            for v in in_blocks(vocabulary, F.octet_length("word") + 64, "word", block_bytes)
        ]
    )
    counted = stage(counted, "item_word_counts")
    shape = windows.select("window", "tokens").dropDuplicates(["window"])
    spelled = shape.select("window", F.posexplode("tokens").alias("off", "word"))
    rarest = (
        spelled.join(counted, "word", "left")
        .groupBy("window")
        .agg(F.min(F.struct(F.coalesce("count", F.lit(0)).alias("count"), "word", "off")).alias("r"))
        .where("r.count > 0")  # a word that no document has: the window occurs nowhere
        .select("window", F.col("r.word").alias("anchor"), F.col("r.off").alias("off"))
    )
    return shape.join(rarest, "window").select("window", "tokens", F.size("tokens").alias("k"), "anchor", "off")


def scan(docs: DataFrame, items: DataFrame, *, size: int = 10, block_bytes: int = 16 << 20) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit and item_ids of every row of ``docs``.

    A document word is hit if it lies in an occurrence of a window, and an item
    is listed if one of its windows occurs.  Each word of a document looks up
    the windows anchored at it; their place must fit the document's length, and
    then all tokens must agree in order.  The lookups are broadcast in blocks of
    ``block_bytes``, with a scan of the documents for each block, so a benchmark
    of any size is joined whole; documents are never shuffled by word.

    NULL texts have no words.  Items without words have no windows.  Rows that
    repeat a document or an item count as documents of their own and as one
    item.  An item without id makes hits but is not listed.  Empty tables give
    no rows, or no hits; other columns are ignored.
    """
    windows = stage(item_windows(items, size), "item_windows")
    anchored = stage(anchors(docs, windows, block_bytes), "anchors")
    blank = F.array(F.lit(None).cast("string"))
    split = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _words().alias("w"))
    # Place 0 stands for the document itself, its words follow from 1.
    placed = split.select("doc_id", "text_hash", "w", F.posexplode(F.concat(blank, "w")).alias("pos", "word"))
    begin, k = F.col("pos") - F.col("off"), F.col("k")
    fits = (
        (F.col("word") == F.col("anchor"))
        & (begin >= 1)
        & (begin + k - 1 <= F.size("w"))
        & (F.slice("w", F.greatest(begin, F.lit(1)), k) == F.col("tokens"))
    )
    found = []
    bytes_of = F.octet_length(F.concat_ws(" ", "tokens")) + 16 * F.size("tokens") + 128
    for n, block in enumerate(in_blocks(anchored, bytes_of, "window", block_bytes)):
        hit = F.col("window").isNotNull()
        met = placed.join(F.broadcast(block), fits, "left").where(hit | (F.col("pos") == 0) if n == 0 else hit)
        found.append(met.select("doc_id", "text_hash", F.size("w").alias("n_words"), begin.alias("begin"), "k", "window"))
    key = ["doc_id", "text_hash"]
    found = stage(_union(found), "window_hits")
    rows = found.groupBy(key).agg(F.count_if(F.col("window").isNull()).alias("n"), F.max("n_words").alias("n_words"))
    hits = found.where("window is not null")
    covered = (
        hits.select(*key, F.explode(F.sequence("begin", F.col("begin") + k - 1)).alias("p"))
        .groupBy(key)
        .agg(F.count_distinct("p").alias("n_hit"))
    )
    listed = (
        hits.select(*key, "window").distinct()
        .join(windows.select("window", "item_id").distinct(), "window")
        .groupBy(key)
        .agg(F.collect_set(F.col("item_id").cast("string")).alias("item_ids"))
    )
    hit_docs = stage(covered.alias("c").join(listed.alias("l"), _same("c", "l"), "left").select(
        "c.doc_id", "c.text_hash", "n_hit", "item_ids"), "hit_documents")
    return (
        rows.alias("r").join(hit_docs.alias("h"), _same("r", "h"), "left")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
        .select(
            "r.doc_id",
            "r.text_hash",
            F.col("n_words").cast("long").alias("n_words"),
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.sort_array(F.coalesce("item_ids", F.array().cast("array<string>"))).alias("item_ids"),
        )
    )


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_hash") == F.col(f"{b}.text_hash"))


def drop_hit(docs: DataFrame, items: DataFrame, **settings) -> DataFrame:
    """``docs`` without the rows in which an item's window occurs; same columns."""
    hit = stage(scan(docs, items, **settings).where("n_hit > 0").select("doc_id", "text_hash").distinct(), "contaminated")
    own = spare_name(docs, "text_hash")
    hashed = docs.withColumn(own, F.xxhash64("text")).alias("d")
    same = F.col("d.doc_id").eqNullSafe(F.col("h.doc_id")) & (F.col(f"d.{own}") == F.col("h.text_hash"))
    return hashed.join(hit.alias("h"), same, "left_anti").select(docs.columns)
