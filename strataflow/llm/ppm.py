"""Log probability of texts by prediction by partial matching, and by a word model as base."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from strataflow.llm.common import map_pandas, on_path, release_memory, releasing
from strataflow.session import stage

#: Bytes that UTF-8 never uses: what stands before a text, and its end.
BEFORE, END = 0xFE, 0xFF


def _lowered(texts: list[str | None]) -> list[bytes]:
    return [(t or "").encode("utf-8", "replace").lower() for t in texts]


def padded(texts: list[str | None], order: int) -> tuple:
    """The lower-cased texts' bytes in a row, each after ``order`` marks and before its end, and the starts."""
    return _laid(_lowered(texts), order)


def _laid(texts: list[bytes], order: int) -> tuple:
    import numpy as np

    lead, end = bytes([BEFORE]) * order, bytes([END])
    parts = [lead + t + end for t in texts]
    lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    return np.frombuffer(b"".join(parts), dtype=np.uint8), np.cumsum(lengths) - lengths, lengths


def grams(codes, order: int):
    """For each place from ``order`` on, the context of ``order`` bytes and the byte there, in one number."""
    import numpy as np

    n = len(codes) - order
    out = np.zeros(n, dtype=np.uint64)
    for k in range(order + 1):
        out = (out << np.uint64(8)) | codes[k : k + n]
    return out


def _places(codes, starts, lengths, order: int):
    """The grams of all coded bytes, those of each text in a row."""
    import numpy as np

    every = grams(codes, order)
    keep = np.ones(len(every), dtype=bool)
    for k in range(order):  # places whose byte is a mark before the next text
        at = starts[1:] - order + k
        keep[at] = False
    return every[keep], lengths - order


class Trie:
    """Counts of contexts of all lengths up to ``order``, as the log probabilities they give.

    Level k holds the bytes seen after each context of k bytes.  A byte not seen
    after a context is left to the next shorter one, at the price of an escape
    (half a chance for each different byte seen, which gives up the other half:
    method D); there the bytes already ruled out are taken from the total.
    Below the longest contexts a byte counts once for each longer context it was
    seen in.  Contexts that were never seen cost nothing.  Last come the bytes
    never seen at all, equally likely.

    ``pairs``, 65536 numbers, tells after how many different bytes each pair of
    bytes was seen, if ``keys`` holds only part of the contexts: it gives levels
    0 and 1, and contexts that end in the same two bytes stay together at all
    other levels, so such a part scores the bytes that follow its contexts.
    """

    def __init__(self, keys, counts, order: int, pairs=None):
        import numpy as np

        self.order, self.levels = order, []
        keys, counts = np.asarray(keys, dtype=np.uint64), np.asarray(counts, dtype=np.float64)
        at = np.argsort(keys)
        keys, counts = keys[at], counts[at]
        del at
        upper = None
        for k in range(order, -1, -1):
            if k < order:
                mask = np.uint64((1 << (8 * (k + 1))) - 1)
                keys, counts = np.unique(keys & mask, return_counts=True)
                counts = counts.astype(np.float64)
            if k == 1 < order and pairs is not None:
                keys = np.flatnonzero(pairs).astype(np.uint64)
                counts = np.asarray(pairs, dtype=np.float64)[np.flatnonzero(pairs)]
            if k == 0 and pairs is not None:
                keys, counts = np.unique(np.flatnonzero(pairs).astype(np.uint64) & np.uint64(255), return_counts=True)
                counts = counts.astype(np.float64)
            chances = 2 * counts - 1
            # Keys are sorted, so those of a context stand together.
            own = keys >> np.uint64(8)
            starts = np.append(True, own[1:] != own[:-1])[: len(own)]
            contexts, of = own[starts], np.cumsum(starts, dtype=np.int32) - 1
            del own, starts
            total = np.bincount(of, weights=chances, minlength=len(contexts))
            kinds = np.bincount(of, minlength=len(contexts)).astype(np.float64)
            level = {
                "keys": Lookup(keys), "log_count": np.log(chances) if k < order else None, "contexts": Lookup(contexts),
                "log_total": np.log(total + kinds), "log_escape": np.log(kinds),
                "log_p": np.log(chances) - np.log(total + kinds)[of],
            }
            if upper is not None:
                # What is left here after all bytes seen in the longer context are ruled out.
                mask = np.uint64((1 << (8 * (k + 1))) - 1)
                ruled = np.bincount(
                    upper["of"], weights=chances[np.searchsorted(keys, upper["keys"] & mask)], minlength=len(upper["kinds"])
                )
                short = np.searchsorted(contexts, upper["contexts"] & np.uint64((1 << (8 * k)) - 1))
                rest, rest_kinds = total[short] - ruled, kinds[short] - upper["kinds"]
                with np.errstate(divide="ignore"):
                    upper["level"]["log_rest"] = np.log(rest + rest_kinds)
                    # Nothing left here: the level is passed at no price.
                    upper["level"]["log_rest_escape"] = np.where(
                        rest_kinds > 0, np.log(rest_kinds) - np.log(np.maximum(rest + rest_kinds, 1e-300)), 0.0
                    )
            self.levels.append(level)
            upper = {"keys": keys, "of": of, "contexts": contexts, "kinds": kinds, "level": level}
        self.unseen = 256 - len(keys)

    def log_probabilities(self, found):
        """Natural log probability of the byte of each gram after its context."""
        import numpy as np

        out = np.zeros(len(found))
        left = np.arange(len(found))
        after = np.full(len(found), -1)  # the longer context whose bytes are ruled out
        upper = None
        for n, level in enumerate(self.levels):
            k = self.order - n
            own = found[left] & np.uint64((1 << (8 * (k + 1))) - 1)
            seen, at = level["keys"].find(own)
            if upper is None:
                out[left[seen]] = level["log_p"][at[seen]]
            else:
                with_rule, free = seen & (after >= 0), seen & (after < 0)
                out[left[with_rule]] += level["log_count"][at[with_rule]] - upper["log_rest"][after[with_rule]]
                out[left[free]] += level["log_p"][at[free]]
            rest = np.flatnonzero(~seen)
            left, own, after = left[rest], own[rest], after[rest]
            known, context = level["contexts"].find(own >> np.uint64(8))
            if upper is not None:
                ruled = known & (after >= 0)
                out[left[ruled]] += upper["log_rest_escape"][after[ruled]]
                known_free = known & (after < 0)
            else:
                known_free = known
            free_at = context[known_free]
            out[left[known_free]] += level["log_escape"][free_at] - level["log_total"][free_at]
            after = np.where(known, context, -1)
            upper = level
            if not len(left):
                return out
        out[left] -= np.log(max(self.unseen, 1))
        return out

    def log10_of(self, texts: list[str | None], chunk: int = 200_000):
        """log10 probability of each whole text, its end included."""
        import numpy as np

        sums, at = [], 0
        while at < len(texts):
            upto, size = at, 0
            while upto < len(texts) and size < chunk:
                size += len(texts[upto] or "")
                upto += 1
            codes, starts, lengths = padded(texts[at:upto], self.order)
            found, counts = _places(codes, starts, lengths, self.order)
            logs = np.zeros(len(found))
            for k in range(0, len(found), chunk):  # a very long text goes through in pieces
                logs[k : k + chunk] = self.log_probabilities(found[k : k + chunk])
            sums.append(np.add.reduceat(logs, np.cumsum(counts) - counts) / np.log(10))
            at = upto
        return np.concatenate(sums) if sums else np.empty(0)


class Lookup:
    """Places of distinct keys: a table with open addressing that looks up many at once."""

    FACTOR = 0x9E3779B97F4A7C15

    def __init__(self, keys):
        import numpy as np

        self.keys = keys
        bits = max(4, int(2 * max(len(keys), 1) - 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.table = np.full(1 << bits, -1, dtype=np.int32)
        left, slot = np.arange(len(keys), dtype=np.int32), self._slots(keys)
        while len(left):
            free = self.table[slot] < 0
            self.table[slot[free]] = left[free]
            lost = self.table[slot] != left
            left, slot = left[lost], (slot[lost] + 1) & self.mask

    def _slots(self, keys):
        import numpy as np

        return ((keys * np.uint64(self.FACTOR)) >> self.shift).astype(np.int64)

    def find(self, wanted):
        """Whether each wanted key is there, and its place if so."""
        import numpy as np

        if not len(self.keys):
            return np.zeros(len(wanted), dtype=bool), np.zeros(len(wanted), dtype=np.int32)
        slot = self._slots(wanted)
        at = self.table[slot]
        seen = (self.keys[at] == wanted) & (at >= 0)
        left = np.flatnonzero(~seen & (at >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) & self.mask
            at[left] = self.table[slot[left]]
            seen[left] = (self.keys[at[left]] == wanted[left]) & (at[left] >= 0)
            left = left[~seen[left] & (at[left] >= 0)]
        return seen, at


def _packed(numbers) -> bytes:
    import zstandard

    return zstandard.ZstdCompressor(level=3).compress(numbers.tobytes())


def _unpacked(raw: bytes, kind: str):
    import numpy as np
    import zstandard

    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=kind)


def _merged(parts: list) -> tuple:
    """Sorted distinct keys of several (keys, counts), with their sums."""
    import numpy as np

    keys = np.concatenate([k for k, _ in parts])
    order = np.argsort(keys)
    keys = keys[order]
    counts = np.concatenate([c for _, c in parts])[order]
    del order
    starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[starts], np.add.reduceat(counts, starts).astype(np.int64) if len(starts) else counts


#: Buckets of contexts that end in the same two bytes, or in similar ones.
BUCKETS = 256 * 32


def _bucket(keys):
    """The last byte of the context, and a few bits of the byte before it."""
    import numpy as np

    last, before = (keys >> np.uint64(8)) & np.uint64(255), (keys >> np.uint64(16)) & np.uint64(31)
    return (last * np.uint64(32) + before).astype(np.int64)


def _cut(of, keys) -> tuple:
    """Sorted keys in the order of the sorted ``of``, with where each of its values begins and ends."""
    import numpy as np

    by = np.argsort(of, kind="stable")
    of = of[by]
    ends = np.append(np.flatnonzero(np.diff(of)) + 1, len(of))
    begins = np.append(0, ends[:-1])
    return of[begins], by, keys[by], begins, ends


def _packed_keys(keys) -> bytes:
    import numpy as np

    return _packed(np.diff(keys, prepend=np.uint64(0)))


def _unpacked_keys(raw: bytes):
    import numpy as np

    return np.cumsum(_unpacked(raw, "<u8"), dtype=np.uint64)


def gather(
    docs: DataFrame,
    held_out: Column,
    *,
    order: int,
    block_bytes: int = 16 << 20,
    run_grams: int = 1_000_000,
    learn_chars: int = 500_000,
    piece_rows: int = 20_000,
    piece_docs: int = 1_000,
) -> DataFrame:
    """One pass over all texts: what both models learn, and what the base has to look up.

    Rows by ``kind``: ``d`` is a document of a block, with the numbers and counts
    of its tokens; ``t`` is a token of a block, with its number there and its
    count in training documents; ``g`` is a bucket of a run of a task's grams,
    with their counts; a run ends at ``run_grams`` different grams.  Texts that
    are held out give no counts.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"kind string, block long, doc_id {id_type}, text_hash long, held_out boolean, n_tokens long, "
        "number int, token binary, n long, first binary, second binary"
    )
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def step(batches: Iterator) -> Iterator:
        from collections import Counter

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        n_block = held = 0
        vocabulary: dict[bytes, int] = {b"": 0}  # the end of a text
        counts = np.zeros(1 << 16, dtype=np.int64)
        rows: list = []
        learnt: list = []
        waiting: list[str] = []
        n_waiting = 0

        def frame(kind: str, block, **values):
            n = len(next(iter(values.values())))
            values |= {"kind": [kind] * n, "block": np.broadcast_to(block, n)}
            own = [pa.array(values[f.name], f.type) if f.name in values else pa.nulls(n, f.type) for f in fields]
            return pa.RecordBatch.from_arrays(own, schema=fields)

        def learn() -> None:
            codes, starts, lengths = padded(waiting, order)
            found, _ = _places(codes, starts, lengths, order)
            keys, times = np.unique(found, return_counts=True)
            learnt.append((keys, times))
            waiting.clear()
            if sum(len(k) for k, _ in learnt[1:]) >= run_grams // 2:
                learnt[:] = [_merged(learnt)]

        def run():
            keys, times = _merged(learnt)
            learnt.clear()
            bucket, by, keys, begins, ends = _cut(_bucket(keys), keys)
            times = times[by]
            return frame(
                "g", bucket,
                n=ends - begins,
                first=[_packed_keys(keys[a:z]) for a, z in zip(begins, ends)],
                second=[_packed(times[a:z].astype("<i8")) for a, z in zip(begins, ends)],
            )

        def close() -> Iterator:
            block = (part << 24) + n_block
            columns = ["doc_id", "text_hash", "held_out", "n_tokens", "first", "second"]
            for k in range(0, len(rows), piece_docs):
                yield frame("d", block, **dict(zip(columns, zip(*rows[k : k + piece_docs]))))
            listed = list(vocabulary)
            for k in range(0, len(listed), piece_rows):
                some = listed[k : k + piece_rows]
                yield frame(
                    "t", block, number=np.arange(k, k + len(some), dtype=np.int32), token=some, n=counts[k : k + len(some)]
                )

        # Arrow batches, so that the texts of one are not all strings at once.
        for b in batches:
            for at in range(0, b.num_rows, 256):
                some = [c.to_pylist() for c in b.slice(at, 256).columns]
                for doc_id, text_hash, out, text in zip(*some):
                    text = text or ""
                    times = Counter(text.encode("utf-8", "replace").lower().split())
                    for w in times:
                        if w not in vocabulary:
                            vocabulary[w] = len(vocabulary)
                    ids = np.fromiter(map(vocabulary.__getitem__, times), dtype=np.int32, count=len(times))
                    n = np.fromiter(times.values(), dtype=np.int32, count=len(times))
                    ids, n = np.append(ids, np.int32(0)), np.append(n, np.int32(1))
                    if len(vocabulary) > len(counts):
                        counts = np.concatenate([counts, np.zeros(len(vocabulary), dtype=np.int64)])
                    if out is False:
                        counts[ids] += n
                        waiting.append(text)
                        n_waiting += len(text)
                        if n_waiting > learn_chars:
                            learn()
                            n_waiting = 0
                            if sum(len(k) for k, _ in learnt) >= run_grams:
                                yield run()
                    rows.append((doc_id, text_hash, out, int(n.sum()), ids.tobytes(), n.tobytes()))
                    held += len(text)
                    if held >= block_bytes:
                        yield from close()
                        n_block, held, rows = n_block + 1, 0, []
                        vocabulary, counts = {b"": 0}, np.zeros(1 << 16, dtype=np.int64)
        if rows:
            yield from close()
        if waiting:
            learn()
        if learnt:
            yield run()

    columns = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), held_out.alias("held_out"), "text")
    on_path(docs.sparkSession)
    return stage(columns.mapInArrow(releasing(step), schema), "language_model_counts")


def gram_buckets(gathered: DataFrame) -> DataFrame:
    """block (bucket), n, first (keys) and second (counts), one row per bucket, summed over all tasks."""

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: list = []
        now = None

        def close() -> pd.DataFrame:
            keys, counts = _merged(parts)
            packed = _packed_keys(keys), _packed(counts.astype("<i8"))
            return pd.DataFrame({"block": [now], "n": [len(keys)], "first": [packed[0]], "second": [packed[1]]})

        for b in batches:
            for bucket, first, second in zip(b["block"], b["first"], b["second"]):
                if now is not None and bucket != now:
                    yield close()
                    parts = []
                now = bucket
                parts.append((_unpacked_keys(first), _unpacked(second, "<i8")))
                if len(parts) >= 64:
                    parts = [_merged(parts)]
        if parts:
            yield close()

    rows = gathered.where("kind = 'g'").select("block", "first", "second")
    dealt = rows.repartition("block").sortWithinPartitions("block")
    return stage(map_pandas(dealt, releasing(step), "block long, n long, first binary, second binary"), "grams")


def base_scores(gathered: DataFrame) -> DataFrame:
    """doc_id, text_hash, held_out, n_tokens, n_known, train_tokens and base_score of each document.

    Tokens meet by name once for each block of documents, not for each document,
    so the most common token is a row a block; the counts go back to the blocks.
    """
    tokens = gathered.where("kind = 't'").select("block", "number", "token", "n")
    every = Window.partitionBy("token")
    counted = stage(
        tokens.select(
            "block", "number", F.sum("n").over(every).alias("c"),
            (F.row_number().over(every.orderBy("block")) == 1).alias("once"),
        ),
        "token_counts",
    )
    total = tokens.agg(F.sum("n")).first()[0] or 0
    distinct = counted.agg(F.count_if(F.col("once") & (F.col("c") > 0))).first()[0] or 0
    id_type = gathered.schema["doc_id"].dataType.simpleString()

    def score(docs, counts):
        import numpy as np
        import pyarrow as pa

        release_memory()  # of the block before
        number = counts.column("number").to_numpy()
        c = np.zeros(int(number.max()) + 1 if len(number) else 1, dtype=np.float64)
        c[number] = counts.column("c").to_numpy()
        logs = np.log10((c + 0.1) / (total + 0.1 * (distinct + 1)))
        known, base = [], []
        for ids, n in zip(docs.column("first"), docs.column("second")):
            ids, n = (np.frombuffer(x.as_buffer(), dtype=np.int32) for x in (ids, n))
            known.append(int(n[c[ids] > 0].sum()))
            base.append(float((logs[ids] * n).sum()))
        out = docs.select(["doc_id", "text_hash", "held_out", "n_tokens"])
        out = out.append_column("n_known", pa.array(known, pa.int64()))
        out = out.append_column("train_tokens", pa.array([total] * len(known), pa.int64()))
        return out.append_column("base_score", pa.array(base, pa.float64()))

    docs = gathered.where("kind = 'd'").select("block", "doc_id", "text_hash", "held_out", "n_tokens", "first", "second")
    return (
        docs.groupBy("block")
        .cogroup(counted.select("block", "number", "c").groupBy("block"))
        .applyInArrow(
            score,
            f"doc_id {id_type}, text_hash long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double",
        )
    )


def _class(counts):
    """Counts in classes, eight for each doubling."""
    import numpy as np

    return np.floor(8 * np.log2(counts)).astype(np.int64)


def _summary(buckets: DataFrame) -> tuple:
    """After how many different bytes each pair of bytes was seen, and the number of grams of each class of counts."""

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import numpy as np

        pairs, classes = np.zeros(1 << 16, dtype=np.int64), np.zeros(512, dtype=np.int64)
        for b in batches:
            for first, second in zip(b["first"], b["second"]):
                # All grams with the same last three bytes are in one bucket.
                three = np.unique(_unpacked_keys(first) & np.uint64(0xFFFFFF))
                pairs += np.bincount((three & np.uint64(0xFFFF)).astype(np.int64), minlength=1 << 16)
                classes += np.bincount(_class(_unpacked(second, "<i8")), minlength=512)
        n = np.concatenate([pairs, classes])
        seen = np.flatnonzero(n)
        yield pd.DataFrame({"place": seen, "n": n[seen]})

    import numpy as np

    every = np.zeros((1 << 16) + 512, dtype=np.int64)
    added = map_pandas(buckets.select("first", "second"), step, "place int, n long").groupBy("place").agg(F.sum("n").alias("n"))
    for r in added.collect():  # at most one row a place
        every[r.place] = r.n
    return every[: 1 << 16], every[1 << 16 :]


def _answers(rows: DataFrame, order: int, pairs) -> DataFrame:
    """block, part, first (grams) and second (their log probabilities) for each row of ``rows`` with a block.

    The rows of a part without a block hold the part's grams and counts.
    """
    schema = "block long, part int, first binary, second binary"
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def step(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        now, trie, held = None, None, 0
        learnt: list = []
        waiting: list = []

        def answer():
            nonlocal trie
            if trie is None:
                keys, counts = zip(*learnt) if learnt else ([np.empty(0, dtype=np.uint64)], [np.empty(0, dtype=np.int64)])
                learnt.clear()
                trie = Trie(np.concatenate(keys), np.concatenate(counts), order, pairs)
            wanted = [_unpacked_keys(first) for _, first in waiting]
            logs = trie.log_probabilities(np.concatenate(wanted))
            ends = np.cumsum([len(w) for w in wanted])
            own = [[block for block, _ in waiting], [now] * len(waiting), [first for _, first in waiting]]
            own.append([_packed(logs[z - len(w) : z]) for w, z in zip(wanted, ends)])
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(own, fields)], schema=fields)

        for b in batches:
            for part, block, first, second in zip(*(c.to_pylist() for c in b.columns)):
                if part != now:
                    if waiting:
                        yield answer()
                    now, trie, held = part, None, 0
                    learnt.clear()
                if block is None:
                    learnt.append((_unpacked_keys(first), _unpacked(second, "<i8")))
                    continue
                waiting.append((block, first))
                held += len(first)
                if held >= 500_000:
                    yield answer()
                    held = 0
        if waiting:
            yield answer()

    on_path(rows.sparkSession)
    dealt = rows.select("part", "block", "first", "second").repartition("part")
    return dealt.sortWithinPartitions("part", F.asc_nulls_first("block")).mapInArrow(releasing(step), schema)


def _frequent(trie: DataFrame, from_class: int) -> DataFrame:
    """part, block (-1), first and second (NULL): the trie's grams whose counts are of ``from_class`` or above."""

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for part, first, second in zip(b["part"], b["first"], b["second"]):
                keys = _unpacked_keys(first)[_class(_unpacked(second, "<i8")) >= from_class]
                if len(keys):
                    out.append((part, -1, _packed_keys(keys), None))
            yield pd.DataFrame(out, columns=["part", "block", "first", "second"])

    return map_pandas(trie.select("part", "first", "second"), step, "part int, block long, first binary, second binary")


def _blocks(docs: DataFrame, frequent, part_of: list[int], *, order: int, block_bytes: int, block_rare: int) -> DataFrame:
    """Blocks of texts: what the frequent grams give each, and the places of the others among the block's.

    A row with doc_id is a piece of a block: ids, hashes and sums (natural logs)
    of its texts, with the numbers of their other grams and how many each has.
    The other rows hold the block's different other grams, numbered through its
    parts of the trie in order.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"block long, part int, doc_id array<{id_type}>, text_hash array<long>, score array<double>, "
        "first binary, second binary"
    )
    fields = to_arrow_schema(StructType.fromDDL(schema))

    def step(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        task, parts = TaskContext.get().partitionId(), np.array(part_of)
        own = frequent.value
        table = Lookup(np.concatenate([np.empty(0, dtype=np.uint64), *(_unpacked_keys(f) for f, _ in own)]))
        logs = np.concatenate([*(_unpacked(s, "<f8") for _, s in own), [0.0]])
        n_block = held = n_rare = 0
        pieces: list = []

        def frame(**values):
            n = len(next(iter(values.values())))
            values["block"] = [(task << 24) + n_block] * n
            columns = [pa.array(values[f.name], f.type) if f.name in values else pa.nulls(n, f.type) for f in fields]
            return pa.RecordBatch.from_arrays(columns, schema=fields)

        def close() -> Iterator:
            keys, numbers = np.unique(np.concatenate([rare for *_, rare, _ in pieces]), return_inverse=True)
            if len(keys):
                part = parts[_bucket(keys)]
                by = np.argsort(part, kind="stable")
                place = np.empty(len(by), dtype=np.uint32)
                place[by] = np.arange(len(by), dtype=np.uint32)
                numbers = place[numbers]
                part, _, keys, begins, ends = _cut(part, keys)
                yield frame(part=part, first=[_packed_keys(keys[a:z]) for a, z in zip(begins, ends)])
            at = 0
            for ids, hashes, sums, rare, times in pieces:
                some = numbers[at : at + len(rare)].astype("<u4")
                at += len(rare)
                yield frame(
                    doc_id=[ids], text_hash=[hashes], score=[sums], first=[_packed(some)], second=[_packed(times.astype("<i8"))]
                )

        for b in batches:
            ids, hashes, texts = b.columns
            sizes, at = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False)), 0
            while at < b.num_rows:
                before = sizes[at - 1] if at else 0
                n = max(int(np.searchsorted(sizes, before + 500_000)) - at, 1)
                sums, rare, times = _frequent_sums(_lowered(texts.slice(at, n).to_pylist()), table, logs, order)
                pieces.append((ids.slice(at, n).to_pylist(), hashes.slice(at, n).to_pylist(), sums, rare, times))
                held, n_rare = held + sizes[at + n - 1] - before, n_rare + len(rare)
                at += n
                if held >= block_bytes or n_rare >= block_rare:
                    yield from close()
                    n_block, held, n_rare, pieces = n_block + 1, 0, 0, []
        if pieces:
            yield from close()

    on_path(docs.sparkSession)
    columns = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return stage(columns.mapInArrow(releasing(step), schema), "language_model_blocks")


def _frequent_sums(texts: list[bytes], table: Lookup, logs, order: int, chunk: int = 200_000) -> tuple:
    """What the table's grams add to each text; the other grams in their order, and how many each text has."""
    import numpy as np

    codes, starts, _ = _laid(texts, order)
    sums, times, rare = np.zeros(len(texts)), np.zeros(len(texts), dtype=np.int64), []
    for k in range(0, len(codes) - order, chunk):  # a very long text goes through in pieces
        found = grams(codes[k : k + chunk + order], order)
        seen, at = table.find(found)
        a, z = np.searchsorted(starts, k, "right") - 1, np.searchsorted(starts, k + len(found))
        begins = np.maximum(starts[a:z] - k, 0)
        sums[a:z] += np.add.reduceat(np.where(seen, logs[at], 0.0), begins)
        # Not the places whose byte is a mark before the next text.
        left = ~seen & ((found & np.uint64(255)) != BEFORE)
        times[a:z] += np.add.reduceat(left, begins, dtype=np.int64)
        rare.append(found[left])
    return sums, np.concatenate(rare), times


def trie_scores(
    docs: DataFrame,
    buckets: DataFrame,
    *,
    order: int,
    max_grams: int = 250_000,
    frequent_grams: int = 1 << 19,
    block_bytes: int = 16 << 20,
    block_rare: int = 2_000_000,
) -> DataFrame:
    """doc_id, text_hash and score of every row: log10 probability of its whole text.

    At most ``frequent_grams`` grams, the most frequent, are broadcast with their
    log probabilities, and added up as the texts pass.  For all others a block of
    texts asks once each: they meet the trie by the end of the context, in parts
    of at most ``max_grams`` grams of the trie (or one bucket), and the answers
    go back to the block, so the whole trie is used and no task holds it.
    """
    spark = docs.sparkSession
    sizes = {r.block: r.n for r in buckets.select("block", "n").collect()}  # at most BUCKETS rows
    part_of, held = [0], sizes.get(0, 0)
    for bucket in range(1, BUCKETS):
        held += sizes.get(bucket, 0)
        over = held > max_grams and bucket in sizes
        part_of.append(part_of[-1] + over)
        held = sizes[bucket] if over else held
    pairs, classes = _summary(buckets)
    from_class = len(classes)
    while from_class and classes[from_class - 1 :].sum() <= frequent_grams:
        from_class -= 1

    part_rows = spark.createDataFrame(list(enumerate(part_of)), "block long, part int")
    trie = buckets.join(F.broadcast(part_rows), "block").select("part", F.lit(None).cast("long").alias("block"), "first", "second")
    frequent = _answers(trie.unionByName(_frequent(trie, from_class)), order, pairs).toArrow()
    sent = spark.sparkContext.broadcast(list(zip(frequent["first"].to_pylist(), frequent["second"].to_pylist())))

    rows = _blocks(docs, sent, part_of, order=order, block_bytes=block_bytes, block_rare=block_rare)
    asked = rows.where("doc_id IS NULL").select("part", "block", "first", F.lit(None).cast("binary").alias("second"))
    answers = _answers(trie.unionByName(asked), order, pairs).select("block", "part", "second")
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def add_up(own, answers):
        import numpy as np
        import pyarrow as pa

        release_memory()  # of the block before
        by_part = sorted(zip(answers["part"].to_pylist(), answers["second"].to_pylist()))
        logs = np.concatenate([_unpacked(second, "<f8") for _, second in by_part]) if by_part else np.empty(0)
        scores = []
        for sums, first, second in zip(own["score"], own["first"], own["second"]):
            sums, times = sums.values.to_numpy(), _unpacked(second.as_py(), "<i8")
            rare = np.bincount(np.repeat(np.arange(len(sums)), times), logs[_unpacked(first.as_py(), "<u4")], len(sums))
            scores.append((sums + rare) / np.log(10))
        ids, hashes = (pa.concat_arrays([x.values for x in own[c]]) for c in ("doc_id", "text_hash"))
        return pa.table({"doc_id": ids, "text_hash": hashes, "score": np.concatenate(scores)})

    texts = rows.where("doc_id IS NOT NULL").select("block", "doc_id", "text_hash", "score", "first", "second")
    return (
        texts.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInArrow(add_up, f"doc_id {id_type}, text_hash long, score double")
    )


def score(docs: DataFrame, held_out: Column, *, order: int = 5) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Both models learn from the rows for which ``held_out`` is false, and score
    all.  A text is its lower-cased (A-Z) UTF-8 bytes and its end.  NULL and
    empty texts are that end alone.  Repeated rows are learnt from each time and
    get equal scores; a row whose ``held_out`` is NULL is scored, not learnt
    from, and reported as not held out.  With nothing to learn from, every byte
    is equally likely.  An empty table gives no rows; other columns are ignored.
    """
    gathered = gather(docs, held_out, order=order)
    base = base_scores(gathered).dropDuplicates(["doc_id", "text_hash"]).alias("b")
    scored = trie_scores(docs, gram_buckets(gathered), order=order).alias("s")
    same = F.col("s.doc_id").eqNullSafe(F.col("b.doc_id")) & F.col("s.text_hash").eqNullSafe(F.col("b.text_hash"))
    return scored.join(base, same).select(
        "s.doc_id", F.coalesce("held_out", F.lit(False)).alias("held_out"),
        "n_tokens", "n_known", "train_tokens", "base_score", "score",
    )
