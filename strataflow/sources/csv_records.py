"""Records of CSV files whose quoted fields may hold line feeds, read by many tasks per file.

A file is read as lines, split among tasks by bytes.  Whether a block of it starts inside a
quoted field is not known to its task.  So a first pass takes each block as a function of that:
how it ends if it starts outside, and if it starts inside.  The functions, one small row a block,
are composed along each file; a second pass reads the lines again, knowing where it is.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from strataflow.session import stage

# A record of more bytes than this is refused instead of put together.
MAX_RECORD = 256 << 20
# Rows of blocks that are broadcast, at some 300 bytes each; more meet the lines in a sorted join.
MAX_BROADCAST = 200_000

_OUTSIDE, _QUOTED, _CLOSED, _PLAIN = 0, 1, 2, 3


def ends_quoted(line: bytes, start: int) -> int:
    """Whether a line that starts outside (0) or inside (1) a quoted field ends inside one, as 0 or 1.

    A quote opens a field only where the field starts; elsewhere in a plain field it
    is text.  Inside, it closes the field unless a second quote follows.
    """
    parts = line.split(b'"')
    state = start
    for before in parts[:-1]:
        if state == _QUOTED:
            state = _CLOSED
        elif before.endswith(b",") or (not before and state != _PLAIN):
            state = _QUOTED
        else:
            state = _PLAIN
    return int(state == _QUOTED)


def _quoted_lines(values: pa.Array) -> list[tuple[int, bytes]]:
    """Place and bytes of the lines with a quote; all others leave the state as it is."""
    at = np.flatnonzero(pc.match_substring(values, '"').to_numpy(zero_copy_only=False))
    return list(zip(at.tolist(), values.take(pa.array(at)).to_pylist()))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.RecordBatch]]:
    """Pieces of a batch that belong to one block each."""
    keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("fid", "block")]
    cuts = np.flatnonzero((keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])) + 1
    limits = [0, *cuts.tolist(), len(keys[0])]
    for a, b in zip(limits, limits[1:]):
        if b > a:
            yield (int(keys[0][a]), int(keys[1][a])), batch.slice(a, b - a)


def _bare(values: pa.Array, block: int, line: int) -> pa.Array:
    """Lines without the mark a file may begin with."""
    if block or line or not len(values) or not values[0].as_py().startswith(b"\xef\xbb\xbf"):
        return values
    return pa.concat_arrays([pa.array([values[0].as_py()[3:]], values.type), values.slice(1)])


BLOCK = "file string, block bigint, f0 int, f1 int, start0 bigint, start1 bigint"


def _functions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: the state it ends in and the line its last record starts at, for both first states."""
    names = ["file", "block", "f0", "f1", "start0", "start1"]
    types = [pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
    done: list[list] = [[] for _ in names]
    current, file, line, state, start = None, None, 0, [0, 1], [None, None]

    def close() -> None:
        if current is not None:
            for column, v in zip(done, (file, current[1], *state, *start)):
                column.append(v)

    for batch in batches:
        for key, run in _runs(batch):
            if key != current:
                close()
                current, line, state, start = key, 0, [0, 1], [None, None]
                file = run.column("file")[0].as_py()
            values = _bare(run.column("value"), key[1], line)
            for at, text in _quoted_lines(values):
                for s in (0, 1):
                    if state[s] == 0:
                        start[s] = line + at
                state = [ends_quoted(text, state[0]), ends_quoted(text, state[1])]
                for s in (0, 1):
                    if state[s] == 0 and at + 1 < len(values):
                        start[s] = line + at + 1
            for s in (0, 1):
                if state[s] == 0:
                    start[s] = line + len(values) - 1
            line += len(values)
    close()
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(done, types)], names=names)


PLACED = "file string, first boolean, record binary, size bigint, block bigint, line bigint, owner_block bigint, owner_line bigint"


def _placed(pieces: bool, max_record: int):
    """Step of the second pass: the records that lie in one block whole, or the pieces of all others."""
    names = ["file", "first", "record", "size", "block", "line", "owner_block", "owner_line"]
    types = [pa.string(), pa.bool_(), pa.binary(), pa.int64(), *[pa.int64()] * 4]

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, line, state, open_at, parts, size = None, 0, 0, None, [], 0
        out: list[list] = [[] for _ in names]
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal out, held
            full = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names=names)
            out, held = [[] for _ in names], 0
            return full

        def put(*row) -> None:
            nonlocal held
            held += len(row[2] or b"") + 100
            for column, v in zip(out, row):
                column.append(v)

        def leave() -> None:
            """What a block leaves open goes to the record's first block."""
            if pieces and parts:
                owner = (current[1], open_at) if open_at is not None else carried
                put(file, owner == (0, 0), b"\n".join(parts) if size <= max_record else None, size, current[1], open_at or 0, *owner)

        file, carried = None, (None, None)
        for batch in batches:
            for key, run in _runs(batch):
                if key != current:
                    leave()
                    current, line, open_at, parts, size = key, 0, None, [], 0
                    file = run.column("file")[0].as_py()
                    state = run.column("start")[0].as_py()
                    carried = (run.column("carried_block")[0].as_py(), run.column("carried_line")[0].as_py())
                values = _bare(run.column("value"), key[1], line)
                alone = np.zeros(len(values), dtype=bool)
                at = 0

                def take(upto: int) -> None:
                    """Lines that leave the state as it is: whole records outside, more of one inside."""
                    nonlocal size
                    if state == 0:
                        alone[at:upto] = True
                    elif upto > at:
                        some = values.slice(at, upto - at).to_pylist()
                        size += sum(map(len, some)) + len(some)
                        if size <= max_record:
                            parts.extend(some)
                        else:
                            parts[:] = [b""]

                for here, text in _quoted_lines(values):
                    take(here)
                    at = here + 1
                    after = ends_quoted(text, state)
                    if state == 0 and after == 0:
                        alone[here] = True
                        continue
                    if state == 0:
                        open_at, parts, size = line + here, [], 0
                    size += len(text) + 1
                    if size <= max_record:
                        parts.append(text)
                    else:
                        parts[:] = [b""]
                    if after == 0:
                        if open_at is None:
                            leave()
                        elif not pieces:
                            put(file, key[1] == 0 and open_at == 0, b"\n".join(parts) if size <= max_record else None, size, key[1], open_at, None, None)
                        open_at, parts, size = None, [], 0
                    state = after
                    if held > 8 << 20:
                        yield flush()
                take(len(values))
                if not pieces and alone.any():
                    whole = values.filter(pa.array(alone))
                    n = len(whole)
                    firsts = np.zeros(n, dtype=bool)
                    firsts[0] = key[1] == 0 and line == 0 and bool(alone[0])
                    none = pa.nulls(n, pa.int64())
                    sizes = pc.cast(pc.binary_length(whole), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(pa.scalar(file), n), pa.array(firsts), whole, sizes, none, none, none, none], names=names
                    )
                line += len(values)
        leave()
        if out[0]:
            yield flush()

    return step


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines in the order of their block, with its place and a short name of the file."""
    file = F.col("_metadata.file_path")
    rows = spark.read.option("lineSep", "\n").text(path)
    return rows.select(F.col("value").cast("binary").alias("value"), file.alias("file"), F.xxhash64(file).alias("fid"), F.col("_metadata.file_block_start").alias("block"))


def _blocks(lines: DataFrame) -> DataFrame:
    """One row per block: the state it starts and ends in, the record open there, and the file's open end."""
    own = stage(lines.mapInArrow(_functions, BLOCK), "csv-functions")
    order = Window.partitionBy("file").orderBy("block")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    fixed = F.col("f0") == F.col("f1")

    def state(constant: Column, turns: Column) -> Column:
        return F.pmod(F.coalesce(constant, F.lit(0)) + turns, F.lit(2)).cast("int")

    # The last block that fixes the state, and how often it has been turned round since.
    ran = (
        own.withColumn("turned", F.sum((F.col("f0") > F.col("f1")).cast("int")).over(upto))
        .withColumn("constant", F.last(F.when(fixed, F.col("f0")), ignorenulls=True).over(upto))
        .withColumn("since", F.coalesce(F.last(F.when(fixed, F.col("turned")), ignorenulls=True).over(upto), F.lit(0)))
        .withColumn("end", state(F.col("constant"), F.col("turned") - F.col("since")))
        .withColumn("start", F.coalesce(F.lag("end").over(order), F.lit(0)))
    )
    record = F.when(F.col("start") == 0, F.col("start0")).otherwise(F.col("start1"))
    owner = F.when(record.isNotNull(), F.struct("block", record.alias("line")))
    return (
        ran.withColumn("upto", F.last(owner, ignorenulls=True).over(order))
        .withColumn("carried", F.lag("upto").over(order))
        .withColumn("open", F.when(F.last("end").over(every) == 1, F.last("upto").over(every)))
        .select(
            "file", "block", "start", "end",
            F.col("carried.block").alias("carried_block"), F.col("carried.line").alias("carried_line"),
            F.col("open.block").alias("open_block"), F.col("open.line").alias("open_line"),
        )
    )


def _with_starts(lines: DataFrame, blocks: DataFrame, few: bool) -> DataFrame:
    """Lines with where their block stands, still in the order of the block."""
    starts = blocks.select("file", "block", "start", "carried_block", "carried_line")
    if few:
        return lines.join(F.broadcast(starts), ["file", "block"])
    numbered = lines.withColumn("n", F.monotonically_increasing_id())
    return numbered.join(starts.hint("merge"), ["file", "block"]).sortWithinPartitions("file", "block", "n").drop("n")


def records(
    spark: SparkSession, path: str | Sequence[str], max_record: int = MAX_RECORD, max_broadcast: int = MAX_BROADCAST
) -> DataFrame:
    """Records of CSV files as text: ``name`` (file), ``first`` (the file's first), ``record``, ``error``.

    Files are split among tasks and read twice.  Records within a block, nearly all, are not
    shuffled; those that cross blocks are put together from one piece a block.
    A record ends at a line feed, with or without a carriage return, outside of quoted
    fields; within them both are a line feed.  Empty lines between records are no
    records.  A quoted field that is never closed, or a record of more than
    ``max_record`` bytes, gives ``error`` and no text.
    """
    lines = _lines(spark, path)
    blocks = stage(_blocks(lines), "csv-blocks")
    few = blocks.count() <= max_broadcast
    inside = _with_starts(lines, blocks, few).mapInArrow(_placed(False, max_record), PLACED).select("file", "first", "record", "size", F.lit(False).alias("lost"))
    crossing = blocks.where((F.col("start") == 1) | (F.col("end") == 1))
    pieces = _with_starts(lines, crossing, few).mapInArrow(_placed(True, max_record), PLACED)
    ends = blocks.where(F.col("block") == F.col("open_block")).select("file", F.col("open_block").alias("owner_block"), F.col("open_line").alias("owner_line"), F.lit(True).alias("lost"))
    size = F.sum(F.col("size")).over(Window.partitionBy("file", "owner_block", "owner_line"))
    marked = pieces.withColumn("size", size).join(ends, ["file", "owner_block", "owner_line"], "left")
    text = F.when(F.col("lost").isNull() & (F.col("size") <= max_record), F.struct("block", F.col("record").cast("string").alias("text")))
    across = marked.groupBy("file", "owner_block", "owner_line").agg(
        F.max("first").alias("first"), F.max("size").alias("size"), F.coalesce(F.max("lost"), F.lit(False)).alias("lost"), F.sort_array(F.collect_list(text)).alias("texts")
    )
    joined = F.when(F.size("texts") > 0, F.array_join(F.col("texts.text"), "\n")).cast("binary")
    found = inside.unionByName(across.select("file", "first", joined.alias("record"), "size", "lost"))
    record = F.col("record").cast("string")
    record = F.when(record.contains("\r"), F.regexp_replace(F.regexp_replace(record, "\r\n", "\n"), "\r$", "")).otherwise(record)
    error = F.when(F.col("lost"), F.lit("quoted field never closed")).when(
        F.col("size") > max_record, F.format_string("record of %d bytes, above %d", "size", F.lit(max_record))
    )
    return found.select(
        F.element_at(F.split("file", "/"), -1).alias("name"), "first", record.alias("record"), error.alias("error")
    ).where(F.col("record").isNull() | (F.col("record") != ""))
