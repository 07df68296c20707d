"""Exact removal of repeated byte strings by sorting suffixes in sampled ranges.

A string of ``length`` bytes may repeat only where its least seed (``seed``
bytes, least by a hash, leftmost) repeats.  So of all suffixes only those at
such seeds are sorted, one for each run of neighbouring strings with one seed.

1. Suffixes are dealt into ranges by their leading bytes, then by fingerprints
   of the seed and of the whole run, then by where they start; the limits are
   sampled suffixes.  A range sorts its suffixes and compares neighbours, and
   the limits on both sides stand for the ranges next to it.  A run equal to an
   earlier one repeats whole; a run whose seed occurs in unlike runs is open.
2. Open runs are compared string by string: runs that share a seed with few
   others meet as bytes, whose suffixes a multikey quicksort orders; those of a
   frequent seed, or of one that limits cut, go by fingerprint through ranges
   like those above.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataflow.llm.common import map_pandas, ranked_within
from strataflow.session import stage

ODD = 0x9E3779B97F4A7C15
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
#: Rows without an id come after all others; their tags tell them from a row with the largest id.
NO_ID, NO_ID_TAG = (1 << 63) - 1, 1 << 30
#: A row of a range: key columns in order, then where it starts, how many strings it stands for, and a mark.
FIELDS = {"lead": "<u8", "k1": "<u4", "k2": "<u8", "doc": "<i8", "tag": "<i4", "pos": "<i8", "n": "<i8", "tied": "<i1"}


class Rolling:
    """Fingerprints of any stretch of a row of bytes, from sums of powers modulo 2^64."""

    def __init__(self, data, salt: int = 0):
        import numpy as np

        n = len(data)
        rng = np.random.default_rng(2 + salt)  # fixed: the same for every task
        digits = rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
        base = (ODD + 2 * salt) | 1
        powers = np.full(n + 1, base, dtype=np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers)
        self.back = np.full(n + 1, pow(base, -1, 1 << 64), dtype=np.uint64)
        self.back[0] = 1
        self.back = np.cumprod(self.back)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(digits[data] * powers[:n], out=self.sums[1:])

    def of(self, start, end):
        import numpy as np

        x = (self.sums[end] - self.sums[start]) * self.back[start]
        x = (x ^ (x >> np.uint64(32))) * np.uint64(MIX[0])
        x = (x ^ (x >> np.uint64(29))) * np.uint64(MIX[1])
        return x ^ (x >> np.uint64(32))


def leading(data, at):
    """The eight bytes from each place on, as one number that sorts like them."""
    import numpy as np

    padded = np.append(data, np.zeros(8, dtype=np.uint8))
    out = np.zeros(len(at), dtype=np.uint64)
    for k in range(8):
        out = (out << np.uint64(8)) | padded[at + k]
    return out


def runs(texts: list[bytes], length: int, seed: int) -> dict:
    """All runs of strings with one seed: text, pos, n, lead, k1, k2, tied.

    Every start of a string of ``length`` bytes is in exactly one run.  ``tied``
    marks runs in which the seed stands more than once, so that strings of one
    run may be equal.
    """
    import numpy as np

    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    n, w = len(data), length - seed + 1
    none = {c: np.empty(0, dtype=k) for c, k in FIELDS.items()} | {"text": np.empty(0, dtype=np.int64)}
    if n < length:
        return none
    hashed = Rolling(data)
    at = np.arange(n - seed + 1)
    h = hashed.of(at, at + seed)
    least, k = h, 1
    while k * 2 <= w:
        least = np.minimum(least[: len(least) - k], least[k:])
        k *= 2
    if w > k:
        least = np.minimum(least[: len(least) - (w - k)], least[w - k :])
    inside = np.zeros(n + 1, dtype=np.int64)
    long = sizes >= length
    np.add.at(inside, begins[long], 1)
    np.add.at(inside, ends[long] - length + 1, -1)
    starts = np.flatnonzero(np.cumsum(inside)[: len(least)] > 0)
    if not len(starts):
        return none
    value = least[starts]
    new = np.append(True, (value[1:] != value[:-1]) | (starts[1:] != starts[:-1] + 1))
    # Two texts may follow each other without a gap: a run ends with its text.
    text = np.searchsorted(ends, starts, side="right")
    new |= np.append(True, text[1:] != text[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    s0, s1, value = starts[first], starts[last], value[first]
    place, tied = np.empty(len(s0), dtype=np.int64), np.zeros(len(s0), dtype=bool)
    for a in range(0, len(s0), 50_000):
        cut = slice(a, a + 50_000)
        same = h[s1[cut, None] + np.arange(w)] == value[cut, None]
        place[cut] = s1[cut] + same.argmax(axis=1)
        # The seed stands once if the first of the first window is the last of the last one.
        leftmost = s0[cut] + (h[s0[cut, None] + np.arange(w)] == value[cut, None]).argmax(axis=1)
        tied[cut] = leftmost != s1[cut] + w - 1 - same[:, ::-1].argmax(axis=1)
    own = text[first]
    return {
        "text": own, "pos": s0 - begins[own], "n": s1 - s0 + 1, "lead": leading(data, place),
        "k1": (value >> np.uint64(32)).astype("<u4"), "k2": hashed.of(s0, s1 + length), "tied": tied.astype("<i1"),
    }


def _packed(rows: dict, order) -> dict:
    import numpy as np
    import zstandard

    press = zstandard.ZstdCompressor(level=1)
    out = {}
    for c, kind in FIELDS.items():
        own = np.ascontiguousarray(rows[c][order], dtype=kind)
        if c == "lead":  # sorted: differences are short
            own = np.diff(own, prepend=np.uint64(0))
        # Bytes of one rank stand together, so that those which hardly change take no room.
        planes = own.view(np.uint8).reshape(-1, own.itemsize).T
        out[c] = press.compress(np.ascontiguousarray(planes).tobytes())
    return out


def _unpacked(raw: bytes, c: str):
    import numpy as np
    import zstandard

    kind = np.dtype(FIELDS[c])
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), dtype=np.uint8).reshape(kind.itemsize, -1)
    own = np.ascontiguousarray(planes.T).view(kind).reshape(-1)
    return np.cumsum(own, dtype=np.uint64) if c == "lead" else own


BLOCK = "bucket int, " + ", ".join(f"{c} binary" for c in FIELDS)
KEYS = ("lead", "k1", "k2", "doc", "tag", "pos")


def limits(sample: list[tuple], n_buckets: int) -> list[tuple]:
    """At most ``n_buckets - 1`` limits between ranges, from sampled suffixes.

    The first limit with some leading bytes and fingerprints is moved to the
    start of all suffixes with these; a later one is a suffix itself, so that all
    from it on with these have an equal one in the range before.
    """
    rows = sorted(sample)
    picked = sorted({rows[k * len(rows) // n_buckets] for k in range(1, n_buckets)}) if rows else []
    out: list[tuple] = []
    for row in picked:
        again = out and out[-1][:3] == row[:3]
        out.append(row if again else (*row[:3], -(1 << 63), -(1 << 31), -1))
    return out


def bucket_of(rows: dict, cuts: list[tuple]):
    """The range of each row."""
    import numpy as np

    n = len(rows["lead"])
    out = np.zeros(n, dtype=np.int64)
    if not cuts or not n:
        return out
    # Rows that a limit's leading bytes do not settle are compared with it column by column.
    leads = np.array([c[0] for c in cuts], dtype=np.uint64)
    low = np.searchsorted(leads, rows["lead"], side="left")
    high = np.searchsorted(leads, rows["lead"], side="right")
    out[:] = low
    for k in np.flatnonzero(high > low):
        own = tuple(int(rows[c][k]) for c in KEYS)
        a, b = int(low[k]), int(high[k])
        while a < b:
            m = (a + b) // 2
            a, b = (m + 1, b) if cuts[m] <= own else (a, m)
        out[k] = a
    return out


def blocks_of(rows: dict, cuts: list[tuple]) -> pd.DataFrame:
    """One packed row per range."""
    import numpy as np

    bucket = bucket_of(rows, cuts)
    order = np.lexsort((rows["lead"], bucket))
    bucket = bucket[order]
    ends = np.append(np.flatnonzero(np.diff(bucket)) + 1, len(bucket)) if len(bucket) else []
    out, begin = [], 0
    for end in ends:
        out.append({"bucket": int(bucket[begin])} | _packed(rows, order[begin:end]))
        begin = end
    return pd.DataFrame(out, columns=["bucket", *FIELDS])


def sorted_bucket(block: pd.DataFrame) -> dict:
    """The rows of a range in order of all keys."""
    import numpy as np

    rows = {c: np.concatenate([_unpacked(raw, c) for raw in block[c]]) for c in FIELDS}
    order = np.lexsort([rows[c] for c in reversed(KEYS)])
    return {c: v[order] for c, v in rows.items()}


def neighbours(rows: dict, before: tuple | None, after: tuple | None, few: int):
    """What comparing neighbours tells: 0 alone, 1 repeats an earlier row whole, 2 open among few, 3 open.

    ``before`` and ``after`` are the limits of the range.
    """
    import numpy as np

    n = len(rows["lead"])
    seed = np.append(True, (np.diff(rows["lead"]) != 0) | (np.diff(rows["k1"].astype(np.int64)) != 0))
    whole = seed | np.append(True, np.diff(rows["k2"]) != 0)
    first = np.maximum.accumulate(np.where(whole, np.arange(n), 0))
    repeats = np.zeros(n, dtype=bool)
    for c in ("doc", "tag", "pos"):
        repeats |= rows[c] != rows[c][first]

    def touches(limit, columns) -> object:
        same = np.ones(n, dtype=bool)
        for c, v in zip(columns, limit):
            same &= rows[c] == np.array(v, dtype=np.uint64).astype(rows[c].dtype)
        return same

    if before is not None and before[5] >= 0:
        repeats |= touches(before, ("lead", "k1", "k2"))
    group = np.cumsum(seed) - 1
    kinds = np.bincount(group, weights=whole, minlength=group[-1] + 1 if n else 0)[group] if n else np.empty(0)
    cut = np.zeros(n, dtype=bool)
    for limit in (before, after):
        if limit is not None:
            cut |= touches(limit, ("lead", "k1"))
    is_open = (kinds > 1) | (rows["tied"] > 0) | cut
    # Rows of one place, of repeated documents, are one.
    again = np.zeros(n, dtype=bool)
    if n:
        again[1:] = ~whole[1:] & ~repeats[1:]
    # All open runs of a seed go the same way, or some would never meet.
    long = np.bincount(group, weights=rows["n"] > 1000)[group] > 0 if n else np.zeros(0, dtype=bool)
    crowded = cut | (kinds > few) | long
    status = np.where(repeats, 1, np.where(is_open & ~again, np.where(crowded, 3, 2), 0))
    return status.astype(np.int32)


def equal_strings(data, at, length: int):
    """Numbers of groups of equal strings; 0 for a string that has no equal.

    A multikey quicksort with eight bytes as a character: each step orders the
    strings still tied by their next character and drops those that stand alone.
    """
    import numpy as np

    word = leading(data, np.arange(len(data)))
    group = np.zeros(len(at), dtype=np.int64)
    tied = np.arange(len(at))
    for depth in range(0, length, 8):
        own = word[at[tied] + depth]
        if depth + 8 > length:
            own = own >> np.uint64(8 * (depth + 8 - length))
        order = np.lexsort((own, group[tied]))
        tied, own = tied[order], own[order]
        before = group[tied]
        new = np.append(True, (before[1:] != before[:-1]) | (own[1:] != own[:-1]))[: len(tied)]
        number = np.cumsum(new)
        many = np.bincount(number, minlength=1)[number] > 1
        group[tied] = np.where(many, number, 0)
        tied = tied[many]
        if not len(tied):
            break
    return group


def later_of(group, doc, tag, pos):
    """Whether a row starts after the first of its group; groups are numbered from 1, 0 is none."""
    import numpy as np

    order = np.lexsort((pos, tag, doc, group))
    g = group[order]
    new = np.append(True, g[1:] != g[:-1])[: len(g)]
    first = np.maximum.accumulate(np.where(new, np.arange(len(g)), 0))
    later = np.zeros(len(g), dtype=bool)
    for c in (doc, tag, pos):
        later |= c[order] != c[order][first]
    out = np.zeros(len(g), dtype=bool)
    out[order] = later & (g > 0)
    return out


def merged(starts, ends):
    """Stretches that overlap or touch, as one."""
    import numpy as np

    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.append(True, starts[1:] > ends[:-1])
    return starts[new], ends[np.append(new[1:], True)]


def digest(raw: bytes, starts, ends) -> tuple:
    """n_bytes, n_removed, n_spans, kept_sha256 and the removed stretches of a text."""
    starts, ends = merged(starts, ends)
    sha, at, gone = hashlib.sha256(), 0, 0
    for a, z in zip(starts.tolist(), ends.tolist()):
        sha.update(raw[at:a])
        gone += z - a
        at = z
    sha.update(raw[at:])
    spans = [{"start": a, "end": z} for a, z in zip(starts.tolist(), ends.tolist())]
    return len(raw), gone, len(spans), sha.hexdigest(), spans


def named(docs: DataFrame) -> DataFrame:
    """doc and tag, which order and name the documents, and text."""
    own = docs.select("doc_id", "text")
    plain = own.select(F.col("doc_id").cast("long").alias("doc"), F.lit(0).alias("tag"), "text")
    often = own.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1 or doc_id is null")
    often = stage(often.select("doc_id"), "repeated_ids")
    if often.isEmpty():
        return plain
    keyed = own.withColumn("_hash", F.xxhash64("text"))
    same = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id"))
    each = keyed.select("doc_id", "_hash").alias("d").join(often.alias("r"), same, "left_semi").distinct()
    tags = stage(ranked_within(each, ["doc_id"], ["_hash"], "tags_of_ids"), "numbered_ids")
    same = same & (F.col("d._hash") == F.col("r._hash"))
    tag = F.coalesce("r._nth", F.lit(0)).cast("int") + F.when(F.col("d.doc_id").isNull(), NO_ID_TAG).otherwise(0)
    doc = F.coalesce(F.col("d.doc_id").cast("long"), F.lit(NO_ID)).alias("doc")
    return keyed.alias("d").join(tags.alias("r"), same, "left").select(doc, tag.cast("int").alias("tag"), "d.text")


def _raw(text) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def _seed_rows(batches: Iterator[pd.DataFrame], length: int, seed: int, piece: int = 1_000_000) -> Iterator[dict]:
    """The runs of the texts of some megabytes at a time."""
    import numpy as np

    for b in batches:
        docs, tags, texts = b["doc"].to_numpy(), b["tag"].to_numpy(), b["text"].tolist()
        at = 0
        while at < len(texts):
            some, held, begin = [], 0, at
            while at < len(texts) and held < piece:
                some.append(_raw(texts[at]))
                held += len(some[-1])
                at += 1
            rows = runs(some, length, seed)
            own = rows.pop("text") + begin
            yield rows | {"doc": docs[own].astype(np.int64), "tag": tags[own].astype(np.int32)}


def _joined(parts: list[dict]) -> dict:
    import numpy as np

    return {c: np.concatenate([p[c] for p in parts]) for c in FIELDS}


def deal(own: DataFrame, cuts: list[tuple], length: int, seed: int) -> DataFrame:
    """Runs of all documents, packed by range."""

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts, held = [], 0
        for rows in _seed_rows(batches, length, seed):
            parts.append(rows)
            held += len(rows["lead"])
            if held >= 750_000:
                yield blocks_of(_joined(parts), cuts)
                parts, held = [], 0
        if held:
            yield blocks_of(_joined(parts), cuts)

    return map_pandas(own.select("doc", "tag", "text"), step, BLOCK)


def _sampled(own: DataFrame, share: float, length: int, seed: int) -> list[tuple]:
    """Suffixes of documents picked by hash."""

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in _seed_rows(batches, length, seed):
            out = pd.DataFrame({c: rows[c] for c in KEYS})
            yield out.assign(lead=rows["lead"].view("<i8"), k1=rows["k1"].astype("<i8"), k2=rows["k2"].view("<i8"))

    picked = own.where(F.pmod(F.xxhash64("doc", "tag", F.lit(5)), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
    found = map_pandas(picked.select("doc", "tag", "text"), step, ", ".join(f"{c} long" for c in KEYS)).toPandas()
    unsigned = [found[c].to_numpy().astype("int64").view("uint64").tolist() for c in ("lead", "k1", "k2")]
    return list(zip(*unsigned, found["doc"].tolist(), found["tag"].tolist(), found["pos"].tolist()))


def remove(
    docs: DataFrame,
    *,
    length: int = 100,
    seed: int = 32,
    bucket_rows: int = 500_000,
    part_bytes: int = 8 << 20,
    sample_bytes: int = 8 << 20,
    few: int = 256,
) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and spans (start, end) of every row.

    A byte goes if a string of ``length`` bytes that covers it also starts
    earlier: in a document of smaller doc_id (a whole number, NULL after all
    others), or in the same one before it.  Rows that share a doc_id are ordered
    by a hash of their text; rows equal in both are one document, and each of
    them gets its result.  NULL and empty texts have no bytes; texts shorter than
    ``length`` stay whole, longer ones of any size are searched whole.  An empty
    table gives no rows; columns other than doc_id and text are ignored.

    Limits of ranges come from about ``sample_bytes`` of text picked by hash;
    they decide where a suffix is compared, not whether.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    own = named(docs)
    n_parts = max(1, -(-size // part_bytes))
    n_buckets = max(1, -(-2 * size // ((length - seed + 2) * bucket_rows)))
    share = min(1.0, sample_bytes / max(size, 1))
    cuts = limits(_sampled(own, share, length, seed), n_buckets) if n_buckets > 1 else []

    def verdicts(block: pd.DataFrame) -> pd.DataFrame:
        b, rows = int(block["bucket"].iloc[0]), sorted_bucket(block)
        status = neighbours(rows, cuts[b - 1] if b else None, cuts[b] if b < len(cuts) else None, few)
        kept = status > 0
        mixed = rows["k1"].astype("int64") * 0x9E3779B1 + (rows["lead"] % 0x7FFFFFFF).astype("int64")
        out = {"doc": rows["doc"], "tag": rows["tag"], "pos": rows["pos"], "n": rows["n"], "status": status, "seed": mixed}
        return pd.DataFrame({c: v[kept] for c, v in out.items()})

    dealt = deal(own, cuts, length, seed).repartition(2 * n_buckets, "bucket")
    found = dealt.groupBy("bucket").applyInPandas(
        verdicts, "doc long, tag int, pos long, n long, status int, seed long"
    )
    part = F.pmod(F.xxhash64("doc", "tag"), F.lit(n_parts)).cast("int").alias("part")

    def by_part(rows: DataFrame):  # as many tasks as the texts need, whatever the session's setting
        return rows.repartition(n_parts, "part").groupBy("part")

    def press(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        own_press = zstandard.ZstdCompressor(level=3)
        for b in batches:
            raw = [own_press.compress(_raw(t)) for t in b.pop("text")]
            yield b.assign(raw=raw)

    texts = map_pandas(own.select("doc", "tag", part, "text"), press, "doc long, tag int, part int, raw binary")
    result = "n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: long, end: long>>"
    names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
    blank = {
        "kind": "", "doc": 0, "tag": 0, "raw": None, "starts": None, "ends": None, "times": 0, "seed": 0, "pos": 0, "n": 0,
        "n_bytes": 0, "n_removed": 0, "n_spans": 0, "kept_sha256": None, "spans": None,
    }

    def join_texts(texts: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        import numpy as np
        import zstandard

        unpress, out = zstandard.ZstdDecompressor(), []
        of_doc = found.groupby(["doc", "tag"], sort=False).indices
        pos, n, status, seeds = (found[c].to_numpy() for c in ("pos", "n", "status", "seed"))
        times = texts.groupby(["doc", "tag"]).size().to_dict()
        for row in texts.drop_duplicates(["doc", "tag"]).itertuples():
            key = (row.doc, row.tag)
            base = blank | {"doc": row.doc, "tag": row.tag, "times": times[key]}
            at = of_doc.get(key, np.empty(0, dtype=np.int64))
            gone, left = at[status[at] == 1], at[status[at] > 1]
            starts, ends = merged(pos[gone], pos[gone] + n[gone] - 1 + length)
            raw = unpress.decompress(row.raw)
            if not len(left):
                out += [base | {"kind": "done"} | dict(zip(names, digest(raw, starts, ends)))] * times[key]
                continue
            out.append(base | {"kind": "left", "raw": row.raw, "starts": starts.tobytes(), "ends": ends.tobytes()})
            for k in left.tolist():
                for begin in range(0, int(n[k]), 20_000):  # a run without end goes in pieces
                    some, start = min(20_000, int(n[k]) - begin), int(pos[k]) + begin
                    kind = "few" if status[k] == 2 else "many"
                    piece = {"kind": kind, "raw": raw[start : start + some - 1 + length], "seed": seeds[k], "pos": start, "n": some}
                    out.append(base | piece)
        return pd.DataFrame(out, columns=list(blank))

    seen = stage(
        by_part(texts).cogroup(by_part(found.select("*", part))).applyInPandas(
            join_texts,
            "kind string, doc long, tag int, raw binary, starts binary, ends binary, times int, seed long, pos long, n long, "
            + result,
        ),
        "joined_texts",
    )

    # Open runs: few to a seed by their bytes, others by fingerprints.
    def few_strings(block: pd.DataFrame) -> pd.DataFrame:
        import numpy as np

        data = np.frombuffer(b"".join(block["raw"]), dtype=np.uint8)
        sizes = block["raw"].str.len().to_numpy()
        n = block["n"].to_numpy()
        of = np.repeat(np.arange(len(block)), n)
        offset = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        at = (np.cumsum(sizes) - sizes)[of] + offset
        doc, tag, pos = (block[c].to_numpy()[of] for c in ("doc", "tag", "pos"))
        later = later_of(equal_strings(data, at, length), doc, tag, pos + offset)
        return stretches(doc[later], tag[later], (pos + offset)[later])

    def stretches(doc, tag, pos) -> pd.DataFrame:
        """Starts in a row as one stretch."""
        import numpy as np

        order = np.lexsort((pos, tag, doc))
        doc, tag, pos = doc[order], tag[order], pos[order]
        new = np.append(True, (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1]) | (pos[1:] > pos[:-1] + 1))[: len(doc)]
        last = np.append(new[1:], True)[: len(doc)]
        return pd.DataFrame({"doc": doc[new], "tag": tag[new], "start": pos[new], "end": pos[last] + length})

    spread = "doc long, tag int, start long, end long"
    open_runs = seen.where("kind in ('few', 'many')")
    sums = {r.kind: r.n for r in open_runs.groupBy("kind").agg(F.sum("n").alias("n")).collect()}
    n_few = max(1, -(-4 * sums.get("few", 0) // bucket_rows))
    dealt = open_runs.where("kind = 'few'").select(
        "doc", "tag", "pos", "n", "raw", F.pmod(F.xxhash64("seed"), F.lit(n_few)).cast("int").alias("bucket")
    )
    gone = dealt.repartition(2 * n_few, "bucket").groupBy("bucket").applyInPandas(few_strings, spread)
    if sums.get("many"):
        gone = gone.unionByName(_many_strings(open_runs.where("kind = 'many'"), sums["many"], length, bucket_rows, stretches, spread))

    def finish(texts: pd.DataFrame, gone: pd.DataFrame) -> pd.DataFrame:
        import numpy as np
        import zstandard

        unpress, out = zstandard.ZstdDecompressor(), []
        of_doc = gone.groupby(["doc", "tag"], sort=False).indices
        start, end = gone["start"].to_numpy(), gone["end"].to_numpy()
        for row in texts.itertuples():
            at = of_doc.get((row.doc, row.tag), np.empty(0, dtype=np.int64))
            starts = np.append(np.frombuffer(row.starts, dtype=np.int64), start[at]).astype(np.int64)
            ends = np.append(np.frombuffer(row.ends, dtype=np.int64), end[at]).astype(np.int64)
            done = digest(unpress.decompress(row.raw), starts, ends)
            out += [(row.doc, row.tag, *done)] * int(row.times)
        return pd.DataFrame(out, columns=["doc", "tag", *names])

    waiting = seen.where("kind = 'left'").select("doc", "tag", "raw", "starts", "ends", "times", part)
    rest = by_part(waiting).cogroup(by_part(gone.select("*", part))).applyInPandas(
        finish, f"doc long, tag int, {result}"
    )
    doc_id = F.when(F.col("tag") < NO_ID_TAG, F.col("doc")).cast(docs.schema["doc_id"].dataType).alias("doc_id")
    return seen.where("kind = 'done'").select("doc", "tag", *names).unionByName(rest).select(doc_id, *names)


def _many_strings(open_runs: DataFrame, n_strings: int, length: int, bucket_rows: int, stretches, spread: str) -> DataFrame:
    """Strings that start later than an equal one, by fingerprint, through sampled ranges."""

    def strings(block: pd.DataFrame) -> dict:
        import numpy as np

        data = np.frombuffer(b"".join(block["raw"]), dtype=np.uint8)
        sizes, n = block["raw"].str.len().to_numpy(), block["n"].to_numpy()
        of = np.repeat(np.arange(len(block)), n)
        offset = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        at = (np.cumsum(sizes) - sizes)[of] + offset
        doc, tag, pos = (block[c].to_numpy()[of] for c in ("doc", "tag", "pos"))
        return {
            "lead": leading(data, at), "k1": (Rolling(data, 1).of(at, at + length) >> np.uint64(32)).astype("<u4"),
            "k2": Rolling(data).of(at, at + length), "doc": doc, "tag": tag.astype(np.int32), "pos": pos + offset,
            "n": np.ones(len(of), dtype=np.int64), "tied": np.zeros(len(of), dtype=np.int8),
        }

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[dict]:
        for b in batches:
            begin, held = 0, 0
            for k, n in enumerate(b["n"].tolist()):
                held += n
                if held >= 500_000 or k == len(b) - 1:
                    yield strings(b.iloc[begin : k + 1])
                    begin, held = k + 1, 0

    n_buckets = max(1, -(-n_strings // bucket_rows))
    columns = open_runs.select("doc", "tag", "pos", "n", "raw")

    def sample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in pieces(batches):
            out = pd.DataFrame({c: rows[c] for c in KEYS})
            yield out.assign(lead=rows["lead"].view("<i8"), k1=rows["k1"].astype("<i8"), k2=rows["k2"].view("<i8"))

    cuts: list[tuple] = []
    if n_buckets > 1:  # about 200,000 strings
        share = min(1.0, 200_000 / n_strings)
        picked = columns.where(F.pmod(F.xxhash64("doc", "tag", "pos"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))
        found = map_pandas(picked, sample, ", ".join(f"{c} long" for c in KEYS)).toPandas()
        unsigned = [found[c].to_numpy().astype("int64").view("uint64").tolist() for c in ("lead", "k1", "k2")]
        cuts = limits(list(zip(*unsigned, found["doc"].tolist(), found["tag"].tolist(), found["pos"].tolist())), n_buckets)

    def step(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in pieces(batches):
            yield blocks_of(rows, cuts)

    def later(block: pd.DataFrame) -> pd.DataFrame:
        b, rows = int(block["bucket"].iloc[0]), sorted_bucket(block)
        status = neighbours(rows, cuts[b - 1] if b else None, cuts[b] if b < len(cuts) else None, 0)
        gone = status == 1
        return stretches(rows["doc"][gone], rows["tag"][gone], rows["pos"][gone])

    dealt = map_pandas(columns, step, BLOCK).repartition(2 * n_buckets, "bucket")
    return dealt.groupBy("bucket").applyInPandas(later, spread)
