"""Raw files: archives, CSV and Parquet."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.functions.time import TIMESTAMP_LAYOUTS, parse_mixed_ts
from strataflow.operators.filters import both_present
from strataflow.session import stage
from strataflow.sources.csv_records import MAX_RECORD, records

ARCHIVE = "_archive"
ERROR = "_error"
# The largest value Spark's reader of whole files gives.
MAX_ARCHIVE = 2**31 - 1


def _text_schema(schema: T.StructType, *extra: str) -> T.StructType:
    return T.StructType(
        [T.StructField(name, T.StringType()) for name in [*schema.fieldNames(), *extra]]
    )


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in schema.fields)


def unpack_archives(
    archives: DataFrame, schema: T.StructType, chunk_rows: int = 50_000
) -> DataFrame:
    """Rows of the first CSV member of each zip archive, as text columns.

    ``archives`` has ``path`` and ``content``.  An archive is read in chunks, so
    that a task holds the compressed bytes and one chunk.  Columns are matched by name; those a file
    lacks are NULL.  ``_source_file`` is the member's base name, ``_archive``
    the archive's.  An archive without CSV, or one that cannot be read, yields
    a row with only ``_archive`` and ``_error``; ``typed`` turns such rows into
    the list of refused archives.
    """
    names = schema.fieldNames()

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                yield from _member_rows(path, lambda: io.BytesIO(content), names, chunk_rows)

    out = _text_schema(schema, "_source_file", ARCHIVE, ERROR)
    return archives.select("path", "content").mapInPandas(unpack, out)


def _member_rows(path: str, opened: Callable, names: Sequence[str], chunk_rows: int) -> Iterator[pd.DataFrame]:
    """Rows of an archive's first CSV member by chunks, or one row that says why there are none."""
    import posixpath
    import zipfile

    archive = posixpath.basename(path)
    columns = [*names, "_source_file", ARCHIVE, ERROR]

    def failure(message: str) -> pd.DataFrame:
        row = dict.fromkeys(columns) | {ARCHIVE: archive, ERROR: message}
        return pd.DataFrame([row], columns=columns, dtype="object")

    try:
        with opened() as handle, zipfile.ZipFile(handle) as z:
            members = [m for m in z.namelist() if m.endswith(".csv") and not m.startswith("__MACOSX")]
            if not members:
                yield failure("no CSV in archive")
                return
            with z.open(members[0]) as member:
                for chunk in pd.read_csv(member, dtype="object", keep_default_na=False, na_values=[""], chunksize=chunk_rows):
                    out = chunk.reindex(columns=names)
                    out["_source_file"] = posixpath.basename(members[0])
                    out[ARCHIVE] = archive
                    out[ERROR] = None
                    yield out[columns].astype("object")
    except Exception as problem:  # one bad archive must not stop the others
        yield failure(f"{type(problem).__name__}: {problem}")


def _open_by_path(path: str):
    """A file that can be read from any place on, by its path in a store that executors reach."""
    from urllib.parse import quote, urlsplit

    scheme, _, rest = path.partition(":")
    if path.startswith("/") or scheme == "file":
        return open("/" + (path if path.startswith("/") else rest).lstrip("/"), "rb")
    from pyarrow import fs

    scheme = "s3" if scheme in ("s3a", "s3n") else scheme
    place = urlsplit(f"{scheme}:{quote(rest)}")
    store, inner = fs.FileSystem.from_uri(place.geturl())
    return store.open_input_file(inner)


def stream_archives(archives: DataFrame, schema: T.StructType, chunk_rows: int = 50_000) -> DataFrame:
    """``unpack_archives`` for archives of any size, of which only ``path`` is given.

    A task reads the list of members at the archive's end and then the one member it wants,
    piece by piece, so it holds one chunk of rows and no more.  The store is reached
    by the executors' own client for its scheme, not by Spark's.
    """
    names = schema.fieldNames()

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                yield from _member_rows(path, lambda: _open_by_path(path), names, chunk_rows)

    return archives.select("path").mapInPandas(unpack, _text_schema(schema, "_source_file", ARCHIVE, ERROR))


def read_archives(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, max_bytes: int = MAX_ARCHIVE
) -> DataFrame:
    """Rows of the zip archives at a path; see ``unpack_archives``.

    An archive above ``max_bytes``, what one value can hold, is streamed by its path
    instead; see ``stream_archives``.  One that cannot be read is refused alone.
    """
    found = spark.read.format("binaryFile").load(path)
    rows = unpack_archives(found.where(F.col("length") <= max_bytes), schema)
    return rows.unionByName(stream_archives(found.where(F.col("length") > max_bytes), schema))


def read_csv_raw(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    multi_line: bool = True,
    max_record: int = MAX_RECORD,
) -> DataFrame:
    """Rows of CSV files that share a header, as text columns matched by name.

    Only an empty field is NULL; look-alikes such as NA or NULL stay text and
    nothing is trimmed.  Columns the files lack are NULL.  A quoted field may
    hold line feeds, and large files are split among tasks all the same; see
    ``csv_records``.  ``multi_line=False`` saves the shuffle that this takes
    where no field holds one.  ``_error`` is set for a row with more or fewer
    fields than the header, for a file with another header than the first one,
    a quoted field never closed, and a record above ``max_record`` bytes.
    """
    broken = "_broken_line"
    options = {"escape": '"', "columnPruning": False, "columnNameOfCorruptRecord": broken}
    header = spark.read.options(**options, header=True, multiLine=multi_line).csv(path).schema
    names = header.fieldNames()
    whole = T.StructType([T.StructField(n, T.StringType()) for n in names]).add(broken, "string")
    if multi_line:
        fields = F.from_csv("record", _ddl(whole), {k: str(v).lower() for k, v in options.items()})
        found = records(spark, path, max_record).withColumn("fields", fields)
        same = F.lit(True)
        for n, name in enumerate(names):
            own = F.col("fields")[name]
            same &= F.coalesce(own == name, F.lit(name == f"_c{n}")) | F.coalesce(F.concat(own, F.lit(str(n))) == name, F.lit(False))
        other = F.when(F.col("first") & F.col("record").isNotNull() & ~same, F.lit("another header than the first file"))
        raw = (
            found.withColumn("error", F.coalesce("error", other))
            .where(~F.col("first") | F.col("error").isNotNull())
            .select("fields.*", F.col("name").alias("_file"), "error")
        )
    else:
        reader = spark.read.options(**options, header=True, enforceSchema=False)
        raw = reader.schema(whole).csv(path).withColumn("_file", F.col("_metadata.file_name")).withColumn("error", F.lit(None).cast("string"))
    wrong = F.when(F.col(broken).isNotNull(), F.concat(F.lit("wrong number of fields: "), F.substring(broken, 1, 100)))
    return raw.select(
        *[
            (F.col(f"`{n}`") if n in names else F.lit(None)).cast("string").alias(n)
            for n in schema.fieldNames()
        ],
        F.col("_file").alias("_source_file"),
        F.col("_file").alias(ARCHIVE),
        F.coalesce("error", wrong).alias(ERROR),
    )


def _typed_value(field: T.StructField, layouts: Sequence[str]) -> Column:
    if isinstance(field.dataType, T.TimestampType):
        return parse_mixed_ts(field.name, layouts)
    if isinstance(field.dataType, T.StringType):
        return F.col(field.name)
    return F.col(field.name).try_cast(field.dataType)


def typed(
    raw: DataFrame, schema: T.StructType, layouts: Sequence[str] = TIMESTAMP_LAYOUTS
) -> DataFrame:
    """Text columns cast to the schema, with ``_error`` set where a value does not fit."""
    problems = [
        F.when(
            F.col(f.name).isNotNull() & _typed_value(f, layouts).isNull(),
            F.concat(F.lit(f"unreadable {f.name}: "), F.col(f.name)),
        )
        for f in schema.fields
        if not isinstance(f.dataType, T.StringType)
    ]
    return raw.select(
        *[_typed_value(f, layouts).alias(f.name) for f in schema.fields],
        "_source_file",
        ARCHIVE,
        F.coalesce(F.col(ERROR), *problems).alias(ERROR),
    )


def refused_files(rows: DataFrame) -> DataFrame:
    """Files with an unreadable value: name, number of bad rows and one message."""
    return (
        rows.where(F.col(ERROR).isNotNull())
        .groupBy(ARCHIVE)
        .agg(F.count(F.lit(1)).alias("bad_rows"), F.min(ERROR).alias("message"))
    )


def split_refused(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of the files read without any error, and the list of the other files.

    The rows are written once, since both results need them.  So is the list,
    one row per refused file: the planner then sees its size, and the rows are
    not shuffled by file.
    """
    rows = stage(rows, "file-rows")
    refused = stage(refused_files(rows), "refused")
    return rows.join(refused.select(ARCHIVE), ARCHIVE, "left_anti").drop(ERROR), refused


def stamp_lineage(
    df: DataFrame, ingested_at: datetime | str, source: Column | None = None
) -> DataFrame:
    """Add ``_ingested_at``, and ``_source_file`` if a source column is given.

    The time is passed in, so that a retried task stamps the same value.
    """
    out = df if source is None else df.withColumn("_source_file", source)
    return out.withColumn("_ingested_at", F.lit(str(ingested_at)).cast("timestamp"))


def drop_null_keys(df: DataFrame, *cols: str) -> DataFrame:
    """Rows whose key columns are all present."""
    return both_present(df, *cols)


def read_parquet(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType | None = None,
    skip_corrupt: bool = False,
) -> DataFrame:
    """Parquet rows; files without rows add nothing, unreadable ones may be skipped."""
    reader = spark.read.option("ignoreCorruptFiles", skip_corrupt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(*([path] if isinstance(path, str) else path))
