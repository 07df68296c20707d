"""Phrases that occur more often than their parts suggest, counted by word indexes.

Documents are cut into shards.  Each shard keeps the Burrows-Wheeler transforms
of its word numbers and of their reverse.  A phrase is an interval of both; a
word to its right is read from the reverse transform, a word to its left from
the forward one, and both intervals follow (bidirectional extension).  Counts of
a phrase are summed over the shards.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import map_pandas
from strataflow.session import stage

#: Longest phrase; suffixes are sorted by as many words.
DEEPEST = 5
#: A-Z lower-cased; marks that end a piece become a byte that UTF-8 never has.
_TABLE = bytearray(range(256))
_TABLE[0x41:0x5B] = range(0x61, 0x7B)
for _b in b".,;:!?\n\x0b\x0c\r":
    _TABLE[_b] = 0xFF
TABLE = bytes(_TABLE)


def tokens(text: str | None) -> list[bytes]:
    """Words in order, with the byte FF where a piece ends."""
    return (text or "").encode("utf-8", "replace").translate(TABLE).replace(b"\xff", b" \xff ").split()


def _pack(numbers, kind: str = "<i4") -> bytes:
    """Numbers compressed with bytes of one rank side by side: the high ones take no room."""
    import numpy as np
    import zstandard

    own = np.ascontiguousarray(numbers, dtype=kind)
    planes = np.ascontiguousarray(own.view(np.uint8).reshape(-1, own.itemsize).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpack(raw: bytes, kind: str = "<i4"):
    import numpy as np
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def _merged(rows: DataFrame) -> DataFrame:
    """``rows`` for a sort-merge join, whatever their size is taken for.

    The planner knows a staged table by its files, which for alike ids are a
    small part of its rows, and does not count what an explosion adds: it would
    broadcast through the driver a table that grows with the texts.
    """
    return rows.hint("merge")


def read_shards(docs: DataFrame, shard_words: int, n_buckets: int) -> DataFrame:
    """The documents' words as numbers, in shards of about ``shard_words``; staged.

    Rows by ``kind``: ``s`` is the sequence of a shard, 0 where a piece ends;
    ``w`` holds the words of a shard that fall into one bucket by a hash of the
    word and its language, with their numbers there and their occurrences.  A
    text stands in one shard whole.
    """
    schema = "kind string, shard long, bucket int, numbers binary, words binary, n binary"
    names = [c.split()[0] for c in schema.split(", ")]

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zlib

        import numpy as np
        import zstandard
        from pyspark import TaskContext

        part, n_shard = TaskContext.get().partitionId(), 0
        known: dict[str, dict[bytes, int]] = {}
        listed: list[bytes] = [b""]  # a language, a space, and a word of it
        pieces: list = []
        held = 0
        press = zstandard.ZstdCompressor(level=1)

        def close() -> Iterator[pd.DataFrame]:
            shard = (part << 24) + n_shard
            sequence = np.concatenate(pieces)
            n = np.bincount(sequence, minlength=len(listed))
            yield pd.DataFrame({"kind": "s", "shard": [shard], "bucket": 0, "words": [_pack(sequence)]}).reindex(columns=names)
            bucket = np.fromiter((zlib.crc32(w) % n_buckets for w in listed), dtype=np.int64, count=len(listed))
            bucket[0] = -1
            order = np.argsort(bucket, kind="stable")[1:]
            ends = np.flatnonzero(np.append(np.diff(bucket[order]) != 0, True)) + 1 if len(order) else []
            out, begin = [], 0
            for end in ends:
                own = order[begin:end]
                words = press.compress(b"\n".join([listed[k] for k in own.tolist()]))
                out.append(("w", shard, int(bucket[own[0]]), _pack(own), words, _pack(n[own])))
                begin = end
            yield pd.DataFrame(out, columns=names)

        for b in batches:
            for lang, text in zip(b["lang"], b["text"]):
                own = known.setdefault(lang, {b"\xff": 0})
                found = tokens(text)
                if not found:
                    continue
                # A language may hold any character but the line feed, which no word holds.
                front = lang.encode("utf-8", "replace").replace(b"%", b"%25").replace(b"\n", b"%0A").replace(b" ", b"%20") + b" "
                for w in set(found).difference(own):
                    own[w] = len(listed)
                    listed.append(front + w)
                ids = np.fromiter(map(own.__getitem__, found), dtype=np.int32, count=len(found))
                pieces += [ids, np.zeros(1, dtype=np.int32)]
                held += len(ids) + 1
                if held >= shard_words:
                    yield from close()
                    n_shard, held, pieces, known, listed = n_shard + 1, 0, [], {}, [b""]
        if pieces:
            yield from close()

    columns = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return stage(map_pandas(columns, step, schema), "word_shards")


def sum_words(read: DataFrame, least: int, n_buckets: int) -> DataFrame:
    """Occurrences over all shards; staged.

    Rows by ``kind``: ``f`` is a word of at least ``least`` occurrences with its
    id, ``s`` are those words of a shard and a bucket, with numbers and ids, and
    ``t`` is a bucket's number of occurrences of all words of a language.
    """
    schema = "kind string, shard long, lang string, word string, id long, a long, numbers binary, ids binary"
    blank = {"kind": "", "shard": 0, "lang": "", "word": "", "id": 0, "a": 0, "numbers": None, "ids": None}

    def sums(block: pd.DataFrame) -> pd.DataFrame:
        from collections import Counter

        import numpy as np
        import zstandard

        bucket, unpress = int(block["bucket"].iloc[0]), zstandard.ZstdDecompressor()
        total: Counter = Counter()
        totals: Counter = Counter()
        each = []
        for shard, numbers, words, n in zip(block["shard"], block["numbers"], block["words"], block["n"]):
            own, times = unpress.decompress(words).split(b"\n"), _unpack(n).tolist()
            for w, x in zip(own, times):
                total[w] += x
            each.append((shard, _unpack(numbers), own))
        for w, x in total.items():
            totals[w.partition(b" ")[0]] += x
        often = {w: (bucket << 32) + k for k, w in enumerate(sorted(w for w, x in total.items() if x >= least))}

        def spelt(front: bytes) -> str:
            return front.replace(b"%20", b" ").replace(b"%0A", b"\n").replace(b"%25", b"%").decode()

        out = [blank | {"kind": "t", "lang": spelt(x), "a": n} for x, n in totals.items()]
        for w, i in often.items():
            front, _, word = w.partition(b" ")
            out.append(blank | {"kind": "f", "lang": spelt(front), "word": word.decode(), "id": i, "a": total[w]})
        for shard, numbers, own in each:
            held = [k for k, w in enumerate(own) if w in often]
            if held:
                ids = _pack([often[own[k]] for k in held], "<i8")
                out.append(blank | {"kind": "s", "shard": shard, "numbers": _pack(numbers[held]), "ids": ids})
        return pd.DataFrame(out, columns=list(blank))

    blocks = read.where("kind = 'w'").drop("kind").repartition(2 * n_buckets, "bucket")
    return stage(blocks.groupBy("bucket").applyInPandas(sums, schema), "summed_words")


def _blocks(shard: int, words: list, n, n_buckets: int) -> list[tuple]:
    """Phrases, a column of word ids for each place, by bucket of a hash: bucket, shard, packed columns and counts."""
    import numpy as np

    mixed = np.zeros(len(n), dtype=np.uint64)
    for column in words:
        mixed = (mixed ^ column.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(29)
    bucket = (mixed % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")  # what was in order stays so inside a bucket
    ends = np.flatnonzero(np.append(np.diff(bucket[order]) != 0, True)) + 1 if len(order) else []
    out, begin = [], 0
    for end in ends:
        own = order[begin:end]
        columns = [_pack(np.diff(words[0][own], prepend=0), "<i8"), *(_pack(c[own], "<i8") for c in words[1:])]
        out.append((int(bucket[own[0]]), shard, columns, _pack(n[own])))
        begin = end
    return out


BLOCKS = "bucket int, shard long, words array<binary>, n binary"


def _summed(block: pd.DataFrame, least: int):
    """The phrases of a bucket that occur often enough, in order: shard, columns of word ids, sum, and whether a phrase's first row."""
    import numpy as np

    columns = [[np.cumsum(_unpack(w[0], "<i8")), *(_unpack(c, "<i8") for c in w[1:])] for w in block["words"]]
    shard = np.repeat(block["shard"].to_numpy(), [len(c[0]) for c in columns])
    words = [np.concatenate(c) for c in zip(*columns)]
    n = np.concatenate([_unpack(raw) for raw in block["n"]])
    order = np.lexsort(words[::-1])
    words, n, shard = [w[order] for w in words], n[order], shard[order]
    new = np.append(True, np.any([np.diff(w) != 0 for w in words], axis=0))
    group = np.cumsum(new) - 1
    a = np.bincount(group, weights=n).astype(np.int64)[group]
    kept = a >= least
    return shard[kept], [w[kept] for w in words], a[kept], new[kept]


class Side:
    """The Burrows-Wheeler transform of a sequence, its suffixes sorted by ``DEEPEST`` words.

    Suffixes that agree so far stand in any order, which leaves the intervals of
    all phrases of at most so many words as in the full order.
    """

    def __init__(self, sequence):
        import numpy as np

        n = len(sequence)
        width = max(n, int(sequence.max())) + 1  # not every number needs to occur
        ranks = {1: sequence.astype(np.int64)}

        def joined(a: int, b: int):
            key = ranks[a] * width
            key[: n - a] += ranks[b][a:]
            at = np.argsort(key)
            new = np.append(True, np.diff(key[at]) != 0)[:n]
            key[at] = np.cumsum(new)
            return key, at

        ranks[2], _ = joined(1, 1)
        ranks[4], _ = joined(2, 2)
        _, order = joined(4, 1)
        del ranks
        self.open(sequence[order - 1])  # before the first word stands the last, which ends a piece

    def open(self, bwt) -> None:
        import numpy as np

        self.bwt, self.places = bwt, None
        self.counts = np.bincount(bwt, minlength=1)
        self.first = np.cumsum(self.counts) - self.counts  # where the suffixes that start with a word begin

    def before(self, words, upto):
        """How often each word stands in the transform before a place."""
        import numpy as np

        n = len(self.bwt)
        if self.places is None:
            self.places = np.sort(self.bwt.astype(np.int64) * (n + 1) + np.arange(n))
        return np.searchsorted(self.places, words.astype(np.int64) * (n + 1) + upto) - self.first[words]


class Index:
    """Both transforms of a sequence whose words are numbered from 1; 0 parts pieces."""

    def __init__(self, forward: Side, reverse: Side):
        self.forward, self.reverse = forward, reverse

    @classmethod
    def build(cls, sequence) -> Index:
        return cls(Side(sequence), Side(sequence[::-1]))

    def single(self):
        """All words: their numbers, and their intervals (forward, reverse, size)."""
        import numpy as np

        words = np.flatnonzero(self.forward.counts)
        words = words[words > 0]
        return words, self.forward.first[words], self.reverse.first[words], self.forward.counts[words]

    def extend(self, low, low_reverse, size, *, right: bool = True, keep=None):
        """All extensions of all phrases by one word: phrase, word, and the new intervals.

        ``low`` and ``low_reverse`` are where the phrases' intervals begin.  Only
        extensions for which ``keep(phrase, word)`` holds are followed.
        """
        import numpy as np

        side, own, other = (self.reverse, low_reverse, low) if right else (self.forward, low, low_reverse)
        phrase = np.repeat(np.arange(len(size)), size)
        offset = np.arange(len(phrase)) - np.repeat(np.cumsum(size) - size, size)
        offset += np.repeat(own, size)
        width = len(side.counts)
        key, n = np.unique(phrase * width + side.bwt[offset], return_counts=True)
        del offset
        phrase, word = key // width, key % width
        # Words that sort before the new one take the first places of the other interval.
        upto = np.cumsum(n) - n
        starts = np.append(True, np.diff(phrase) != 0)[: len(phrase)]
        smaller = upto - np.maximum.accumulate(np.where(starts, upto, 0))
        kept = word > 0
        if keep is not None:
            kept &= keep(phrase, word)
        phrase, word, n, smaller = phrase[kept], word[kept], n[kept], smaller[kept]
        new_other = other[phrase] + smaller
        new_own = side.first[word] + side.before(word, own[phrase])
        return phrase, word, *((new_other, new_own) if right else (new_own, new_other)), n

    def pairs(self):
        """First word, second word and occurrences of all pairs: the right extensions of single words."""
        import numpy as np

        bwt, width = self.reverse.bwt, len(self.reverse.counts)
        first = np.repeat(np.arange(width), self.reverse.counts)  # the word whose interval a place is in
        key, n = np.unique(first * width + bwt, return_counts=True)
        first, second = key // width, key % width
        kept = (first > 0) & (second > 0)
        return first[kept], second[kept], n[kept]


def along(sequence, joined, shortest: int):
    """What is left of a sequence if pieces also end between words that are not ``joined`` and shorter ones go."""
    import numpy as np

    run = np.append(0, np.cumsum(~joined))
    kept = np.bincount(run)[run] >= shortest
    sequence, run = sequence[kept], run[kept]
    return np.insert(sequence, np.flatnonzero(np.append(np.diff(run) != 0, True)[: len(run)]) + 1, 0)


def count_phrases(
    docs: DataFrame, *, least: int = 100, shard_words: int = 2_000_000, bucket_rows: int = 1_000_000
) -> tuple[DataFrame, DataFrame]:
    """Words and phrases of 1 to 5 words that occur at least ``least`` times.

    The first frame holds lang, id and word of those words; the second lang, ids,
    a, the number of occurrences, and n, that of all words of the language.  A
    phrase cannot be more frequent than the words and word pairs in it, so shards
    index frequent words only (others part pieces), and longer phrases come from
    an index of what is left if infrequent pairs part pieces too; every phrase that could be frequent is counted in every
    shard.  Counts meet in buckets by hash, packed by shard.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_buckets = max(1, -(-size // (16 * bucket_rows)))
    read = read_shards(docs, shard_words, n_buckets)
    summed = sum_words(read, least, n_buckets)
    words = summed.where("kind = 'f'").select("lang", "id", "word", "a")

    def build(sequences: pd.DataFrame, numbers: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        if not len(sequences) or not len(numbers):
            return pd.DataFrame(columns=["shard", "ids", "sequence"])
        sequence = _unpack(sequences["words"].iloc[0])
        number = np.concatenate([_unpack(raw) for raw in numbers["numbers"]])
        ids = np.concatenate([_unpack(raw, "<i8") for raw in numbers["ids"]])
        order = np.argsort(number)  # as they came, so that common words have low numbers
        own = np.zeros(int(max(sequence.max(), number.max())) + 1, dtype=np.int32)
        own[number[order]] = np.arange(1, len(number) + 1)
        sequence = own[sequence]
        # One mark parts pieces as well as many, and the last one ends the text.
        kept = (sequence > 0) | (np.append(0, sequence[:-1]) > 0)
        sequence = np.append(sequence[kept], np.int32(0))
        return pd.DataFrame(
            {"shard": sequences["shard"].iloc[:1], "ids": [_pack(ids[order], "<i8")], "sequence": [_pack(sequence)]}
        )

    sequences = read.where("kind = 's'").select("shard", "words")
    numbers = summed.where("kind = 's'").select("shard", "numbers", "ids")
    n_shards = 2 * (sequences.count() or 1)

    def by_shard(rows: DataFrame):  # as many tasks as shards, whatever the session's setting
        return rows.repartition(n_shards, "shard").groupBy("shard")

    # One sequence is kept and moved, not its two transforms: each step makes those it needs.
    frequent = stage(
        by_shard(sequences).cogroup(by_shard(numbers)).applyInPandas(build, "shard long, ids binary, sequence binary"),
        "frequent_sequences",
    )

    def opened(row) -> tuple:
        """The ids in order and the sequence of their places, from 1."""
        import numpy as np

        ids = _unpack(row.ids, "<i8")
        order = np.argsort(ids)
        own = np.zeros(len(ids) + 1, dtype=np.int32)
        own[order + 1] = np.arange(1, len(ids) + 1)
        return ids[order], own[_unpack(row.sequence)]

    def pairs_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in b.itertuples():
                ids, sequence = opened(row)
                first, second, n = Index(None, Side(sequence[::-1])).pairs()
                out = _blocks(row.shard, [ids[first - 1], ids[second - 1]], n, n_buckets)
                yield pd.DataFrame(out, columns=["bucket", "shard", "words", "n"], dtype=object)

    def sum_pairs(block: pd.DataFrame) -> pd.DataFrame:
        """The frequent pairs once, as shard -1, and those of each shard."""
        import numpy as np

        shard, (first, second), a, once = _summed(block, least)
        rows = [(-1, _pack(first[once], "<i8"), _pack(second[once], "<i8"), _pack(a[once], "<i8"))]
        for own in np.unique(shard).tolist():
            held = shard == own
            rows.append((own, _pack(first[held], "<i8"), _pack(second[held], "<i8"), None))
        return pd.DataFrame(rows, columns=["shard", "first", "second", "a"])

    def dealt(blocks: DataFrame):
        return blocks.repartition(2 * n_buckets, "bucket").groupBy("bucket")

    pairs = stage(
        dealt(map_pandas(frequent, pairs_of, BLOCKS)).applyInPandas(sum_pairs, "shard long, first binary, second binary, a binary"),
        "frequent_pairs",
    )

    def rows_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in b.itertuples():
                w1, w2, a = (_unpack(raw, "<i8") for raw in (row.first, row.second, row.a))
                ids = pd.Series(list(map(list, zip(w1.tolist(), w2.tolist()))), dtype=object)
                yield pd.DataFrame({"ids": ids, "a": a})

    def longer(own: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        columns = ["bucket", "shard", "words", "n"]
        if not len(own) or not len(pairs):
            return pd.DataFrame(columns=columns)
        row = own.iloc[0]
        ids, sequence = opened(row)
        width = len(ids) + 1
        first = np.searchsorted(ids, np.concatenate([_unpack(raw, "<i8") for raw in pairs["first"]])) + 1
        second = np.searchsorted(ids, np.concatenate([_unpack(raw, "<i8") for raw in pairs["second"]])) + 1
        known = np.sort(first * width + second)

        def is_known(a, b):
            key = a * width + b
            at = np.minimum(np.searchsorted(known, key), len(known) - 1)
            return known[at] == key

        sequence = along(sequence, is_known(sequence[:-1].astype(np.int64), sequence[1:]), 3)
        if not len(sequence):
            return pd.DataFrame(columns=columns)
        index = Index.build(sequence)
        words, low, low_reverse, size = index.single()
        held, found = words[None, :], []
        # A second and third word to the right, a fourth to the left, a fifth to the right.
        for right in (True, True, False, True):
            last, foremost = held[-1], held[0]
            follows = (lambda p, w: is_known(last[p], w)) if right else (lambda p, w: is_known(w, foremost[p]))
            phrase, word, low, low_reverse, size = index.extend(low, low_reverse, size, right=right, keep=follows)
            held = np.vstack([held[:, phrase], word] if right else [word, held[:, phrase]])
            if len(held) > 2:
                spelt = [ids[w - 1] for w in held] + [np.full(len(size), -1)] * (DEEPEST - len(held))
                found += _blocks(row.shard, spelt, size, n_buckets)
        return pd.DataFrame(found, columns=columns, dtype=object)

    def sum_longer(block: pd.DataFrame) -> pd.DataFrame:
        _, words, a, once = _summed(block, least)
        spelt = [[w for w in ids if w >= 0] for ids in zip(*(w[once].tolist() for w in words))]
        return pd.DataFrame({"ids": pd.Series(spelt, dtype=object), "a": a[once]})

    own_pairs = pairs.where("shard >= 0").select("shard", "first", "second")
    blocks = by_shard(frequent).cogroup(by_shard(own_pairs)).applyInPandas(longer, BLOCKS)
    phrases = (
        words.select(F.array("id").alias("ids"), "a")
        .unionByName(map_pandas(pairs.where("shard = -1").drop("shard"), rows_of, "ids array<long>, a long"))
        .unionByName(dealt(blocks).applyInPandas(sum_longer, "ids array<long>, a long"))
    )
    with_lang = phrases.join(_merged(words.select(F.col("id").alias("_first"), "lang")), F.col("ids")[0] == F.col("_first"))
    totals = stage(summed.where("kind = 't'").groupBy("lang").agg(F.sum("a").alias("n")), "words_a_lang")
    return (
        words.select("lang", "id", "word"),
        stage(with_lang.select("lang", "ids", "a"), "frequent_phrases").join(totals, "lang"),
    )


def mine(docs: DataFrame, *, least: int = 100, percent: int = 100, top: int = 2000, **settings) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score: each language's ``top`` phrases.

    Phrases of 2 to 5 words that occur ``a >= least`` times, scored by the cut
    whose parts (``l`` and ``r`` occurrences) make it least surprising,
    ``1000 a n / (l r)`` rounded down; ties to the shortest first part.  A phrase
    inside a longer one with ``100 f(longer) >= percent a`` is dropped.
    A NULL lang is ``und``; NULL and empty texts have no words; texts of any
    length count whole; repeated rows count each time.  Equal scores go by ``a``,
    then the phrase's bytes.  An empty table gives no rows; columns other than
    lang and text are ignored.
    """
    words, phrases = count_phrases(docs, least=least, **settings)
    counts = phrases.select("ids", "a")
    longer = phrases.where(F.size("ids") > 1)
    length = F.size("ids")
    # A longer phrase is never more frequent than those it holds, so one word more tells all.
    around = (
        phrases.where(length > 2)
        .select(F.explode(F.array(F.slice("ids", 1, length - 1), F.slice("ids", F.lit(2), length - 1))).alias("ids"), "a")
        .groupBy("ids").agg(F.max("a").alias("around"))
    )
    left = longer.join(_merged(around), "ids", "left").where(
        F.col("around").isNull() | (F.lit(100) * F.col("around") < F.lit(percent) * F.col("a"))
    )
    cuts = left.drop("around").withColumn("k", F.explode(F.sequence(F.lit(1), length - 1)))
    of_left = counts.select(F.col("ids").alias("_left"), F.col("a").alias("l"))
    of_right = counts.select(F.col("ids").alias("_right"), F.col("a").alias("r"))
    exact = "cast(a as decimal(17, 0)) * 1000 * cast(n as decimal(17, 0)) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))"
    scored = (
        cuts.withColumns({"_left": F.slice("ids", F.lit(1), F.col("k")), "_right": F.slice("ids", F.col("k") + 1, length - F.col("k"))})
        .join(_merged(of_left), "_left").join(_merged(of_right), "_right")
        .withColumn("score", F.expr(exact))
        .groupBy("lang", "ids", "a", "n")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("c"))
        .select("lang", "ids", "a", "n", "c.score", "c.l", "c.r")
    )
    scored = stage(scored, "scored_phrases")
    spelt = (
        scored.select("ids", F.posexplode("ids").alias("at", "id"))
        .join(_merged(words.select("id", "word")), "id")
        .groupBy("ids").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))  # 5 words at most
        .select("ids", F.array_join(F.transform("w", lambda x: x["word"]), " ").alias("phrase"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.join(_merged(spelt), "ids").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return best.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
