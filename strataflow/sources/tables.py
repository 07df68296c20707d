"""Parquet tables: landing, append, full refresh and merge.

A table is a folder of numbered versions.  A version counts once Spark's
``_SUCCESS`` marker is in it, so readers see the old one until the new one is
complete, and a failed or repeated job leaves no half-written table.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.operators.incremental import merge_upsert, new_keys, touched_partitions
from strataflow.operators.key_summaries import may_hold, summarise
from strataflow.session import stage

MARKER = "_SUCCESS"
DESCRIPTION = "_description.txt"
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def _files(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def _children(spark: SparkSession, path: str) -> list[str]:
    fs, target = _files(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _files(spark, path)
    return fs.exists(target)


def with_docs(df: DataFrame, docs: Mapping[str, str]) -> DataFrame:
    """Column descriptions, kept with the data by Parquet."""
    return df.select(
        *[
            F.col(c).alias(c, metadata={"comment": docs[c]}) if c in docs else F.col(c)
            for c in df.columns
        ]
    )


def sorted_by(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Range partitions on the keys, sorted inside, so that files and row groups
    cover narrow key ranges and filters on the keys skip the others.

    A last range column, hashed from the row and where it came from, lets the
    ranges split a key that holds very many rows.
    """
    spread = F.xxhash64(F.spark_partition_id(), *df.columns)
    return (
        df.withColumn("_spread", spread)
        .repartitionByRange(*keys, "_spread")
        .sortWithinPartitions(*keys)
        .drop("_spread")
    )


def _folder(spark: SparkSession, column: str, value) -> str:
    """Name of a partition's folder, escaped as Spark's writer does."""
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return f"{escape(column)}={NULL_PARTITION if value is None else escape(str(value))}"


def _among(df: DataFrame, column: str, values: Sequence[str | None]) -> Column:
    """Whether a row's partition is one of ``values``, given as text."""
    kind = df.schema[column].dataType
    named = sorted({v for v in values if v is not None})
    scope = F.col(column).isNull() if None in values else F.lit(False)
    return scope | F.col(column).isin([F.lit(v).cast(kind) for v in named]) if named else scope


def _dealt(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows brought together by partition before a write: small partitions share a
    task and one file each, large ones are split, whatever the number of tasks."""
    return df.hint("rebalance", *partition_by) if partition_by else df


class TableStore:
    """Named tables under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _versions(self, name: str) -> list[int]:
        folder = f"{self.root}/{name}"
        found = []
        for child in _children(self.spark, folder):
            if child.startswith("v") and child[1:].isdigit():
                if path_exists(self.spark, f"{folder}/{child}/{MARKER}"):
                    found.append(int(child[1:]))
        return sorted(found)

    def names(self) -> list[str]:
        """Tables with a complete version."""
        return [c for c in _children(self.spark, self.root) if c[0] not in "._" and self.exists(c)]

    def exists(self, name: str) -> bool:
        return bool(self._versions(name))

    def path(self, name: str) -> str:
        """Folder of the current version."""
        versions = self._versions(name)
        if not versions:
            raise FileNotFoundError(f"table {name} under {self.root}")
        return f"{self.root}/{name}/v{versions[-1]}"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def read_or_none(self, name: str) -> DataFrame | None:
        return self.read(name) if self.exists(name) else None

    def write(
        self,
        name: str,
        df: DataFrame,
        *,
        sort: Sequence[str] = (),
        partition_by: Sequence[str] = (),
        docs: Mapping[str, str] | None = None,
        description: str | None = None,
    ) -> DataFrame:
        """Full refresh: write a new version and return it as read back.

        ``docs`` describes columns, ``description`` the table; both stay with the version.
        """
        if sort:
            df = sorted_by(df, sort)
        if docs:
            df = with_docs(df, docs)
        taken = [c for c in _children(self.spark, f"{self.root}/{name}") if c.startswith("v")]
        number = max((int(c[1:]) for c in taken if c[1:].isdigit()), default=0) + 1
        path = f"{self.root}/{name}/v{number}"
        _dealt(df, partition_by).write.partitionBy(*partition_by).parquet(path)
        if description:
            fs, target = _files(self.spark, f"{path}/{DESCRIPTION}")
            out = fs.create(target, True)
            out.write(bytearray(description.encode()))
            out.close()
        return self.spark.read.parquet(path)

    def description(self, name: str) -> str:
        """What the current version says of the table; empty if nothing."""
        fs, target = _files(self.spark, f"{self.path(name)}/{DESCRIPTION}")
        if not fs.exists(target):
            return ""
        stream = fs.open(target)
        try:
            return self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def append(self, name: str, df: DataFrame, *, partition_by: Sequence[str] = ()) -> DataFrame:
        """Add rows to the current version; the first rows make the table."""
        if not self.exists(name):
            return self.write(name, df, partition_by=partition_by)
        self._delete(self._summary_root(name))
        self._delete(self._views_root(name))
        _dealt(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(self.path(name))
        return self.read(name)

    def drop_old(self, name: str, keep: int = 2) -> None:
        """Delete all but the newest complete versions, and what failed before them."""
        kept = self._versions(name)[-keep:]
        for child in _children(self.spark, f"{self.root}/{name}"):
            if child[1:].isdigit() and kept and int(child[1:]) < kept[0]:
                self._delete(f"{self.root}/{name}/{child}")
                for beside in ("_keys", "_views", "_deltas"):
                    self._delete(f"{self.root}/{beside}/{name}/{child}")

    def register(self, name: str, view: str | None = None) -> DataFrame:
        """The table as a temporary view."""
        df = self.read(name)
        df.createOrReplaceTempView(view or name)
        return df

    def merge(
        self,
        name: str,
        updates: DataFrame,
        keys: Sequence[str],
        *,
        partition_by: str | None = None,
        newest: Sequence[str] = (),
    ) -> DataFrame:
        """Upsert by key; with ``newest``, a target row that is later by it stays.

        Without ``partition_by`` a new version of the whole table is written.
        With it, only the partitions that hold a matching key or receive a row
        are rewritten, in place, so a month's batch does not rewrite years.
        Their new rows are written beside the table first; should the run die
        while it replaces the partitions, the next merge, or ``recover``, does
        the rest.

        Filters of each partition's keys are kept beside the table; only
        partitions that may hold a key of the batch, or have no filter, are
        opened to look for it.
        """
        self.recover(name)
        target = self.read_or_none(name)
        if target is None:
            out = self.write(name, updates, partition_by=[partition_by] if partition_by else [])
            if partition_by:
                self._summarise(name, out, keys, partition_by)
            return out
        updates = updates.select(target.columns)
        if partition_by is None:
            return self.write(name, merge_upsert(target, updates, keys, newest))
        updates = stage(updates, f"{name}-updates")
        touched = self.touched(name, target, updates, keys, partition_by)
        touched.write.mode("overwrite").parquet(f"{self._pending(name)}/touched")
        self.spark.createDataFrame([(list(keys),)], "keys array<string>").write.mode("overwrite").parquet(
            f"{self._pending(name)}/keys"
        )
        values = [r[0] for r in self.spark.read.parquet(f"{self._pending(name)}/touched").collect()]
        scope = F.col(partition_by).isin(values) | F.col(partition_by).isNull()
        merged = merge_upsert(target.where(scope), updates, keys, newest)
        merged.write.mode("overwrite").parquet(f"{self._pending(name)}/rows")
        self.recover(name)
        return self.read(name)

    def touched(
        self, name: str, target: DataFrame, updates: DataFrame, keys: Sequence[str], partition_by: str
    ) -> DataFrame:
        """The partitions a merge must rewrite, found without opening those that filters rule out."""
        folders = self._parts(self.path(name))
        root = self._summary_root(name)
        known = folders & self._parts(root)
        open_ = [None if f == NULL_PARTITION else unquote(f) for f in folders - known]
        if known:
            filters = self.spark.read.parquet(*[f"{root}/_part={f}" for f in sorted(known)])
            open_ += may_hold(filters, updates, keys)
        if not open_:
            return updates.select(partition_by).distinct()
        return touched_partitions(target.where(_among(target, partition_by, open_)), updates, keys, partition_by)

    def _parts(self, path: str) -> set[str]:
        """The partitions in a folder, as its folders name them."""
        return {c.partition("=")[2] for c in _children(self.spark, path) if "=" in c}

    def partition_view(
        self, name: str, view: str, partition_by: str, build: Callable[[DataFrame], DataFrame]
    ) -> DataFrame:
        """What ``build`` makes of each partition of the table, kept beside it.

        Only partitions without a stored part are read: new ones, and those that
        a merge has replaced, whose parts went before their rows did.  What a
        replaced row added is so taken back with it.  ``build`` gets the rows
        with ``_part``, the partition as text, and returns rows that keep it, at
        least one for each; a partition it gives no row is read every time.
        """
        root = f"{self._views_root(name)}/{view}"
        missing = self._parts(self.path(name)) - self._parts(root)
        if missing:
            table = self.read(name)
            values = [None if f == NULL_PARTITION else unquote(f) for f in missing]
            rows = table.where(_among(table, partition_by, values))
            (
                _dealt(build(rows.withColumn("_part", F.col(partition_by).cast("string"))), ["_part"])
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("_part")
                .parquet(root)
            )
        return self.spark.read.parquet(root)

    def _views_root(self, name: str) -> str:
        version = self.path(name).rsplit("/", 1)[-1]
        return f"{self.root}/_views/{name}/{version}"

    def _summary_root(self, name: str) -> str:
        version = self.path(name).rsplit("/", 1)[-1]
        return f"{self.root}/_keys/{name}/{version}"

    def _summarise(self, name: str, rows: DataFrame, keys: Sequence[str], partition_by: str) -> None:
        """Write the filters of all partitions in ``rows``, one folder each."""
        found = summarise(rows, keys, partition_by).withColumn("_part", F.col("_value")).drop(partition_by)
        (
            _dealt(found, ["_part"])
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("_part")
            .parquet(self._summary_root(name))
        )

    def _pending(self, name: str) -> str:
        return f"{self.root}/_pending/{name}"

    def recover(self, name: str) -> None:
        """Finish a partition merge whose new rows are complete; safe to repeat."""
        pending = self._pending(name)
        if path_exists(self.spark, f"{pending}/rows/{MARKER}"):
            touched = self.spark.read.parquet(f"{pending}/touched")
            rows = self.spark.read.parquet(f"{pending}/rows")
            (partition_by,) = touched.columns
            path = self.path(name)
            # Filters and views go before what they describe is replaced: none is better than an old one.
            views = self._views_root(name)
            beside = [self._summary_root(name), *[f"{views}/{v}" for v in _children(self.spark, views)]]
            for (value,) in touched.collect():
                for folder in beside:
                    self._delete(f"{folder}/{_folder(self.spark, '_part', value)}")
            (
                _dealt(rows, [partition_by])
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(partition_by)
                .parquet(path)
            )
            filled = {r[0] for r in rows.select(partition_by).distinct().collect()}
            for (value,) in touched.collect():
                if value not in filled:
                    self._delete(f"{path}/{_folder(self.spark, partition_by, value)}")
            if path_exists(self.spark, f"{pending}/keys/{MARKER}"):
                keys = self.spark.read.parquet(f"{pending}/keys").first().keys
                self._summarise(name, rows, keys, partition_by)
        # The marker goes first: without it the rest counts for nothing.
        self._delete(f"{pending}/rows/{MARKER}")
        self._delete(pending)

    def _delete(self, path: str) -> None:
        fs, target = _files(self.spark, path)
        fs.delete(target, True)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df


def land_parquet(df: DataFrame, root: str, source: str = "_source_file") -> None:
    """Write landing files, one folder per source file.

    Only the folders of the sources in ``df`` are replaced, so landing a file
    twice leaves one copy.
    """
    (
        _dealt(df, [source])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(source)
        .parquet(root)
    )


def land_empty(df: DataFrame, root: str, names: Sequence[str], source: str = "_source_file") -> None:
    """Folders for sources without rows, so that they count as landed."""
    for name in names:
        folder = f"{root}/{_folder(df.sparkSession, source, name)}"
        df.drop(source).limit(0).coalesce(1).write.mode("overwrite").parquet(folder)


def landed_sources(spark: SparkSession, root: str, source: str = "_source_file") -> DataFrame:
    """Source files that have landed, read from the folder names alone."""
    prefix = f"{source}="
    names = [c[len(prefix) :] for c in _children(spark, root) if c.startswith(prefix)]
    return spark.createDataFrame([(unquote(n),) for n in names], f"{source} string")


def read_landed(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    source: str = "_source_file",
    names: Sequence[str] | None = None,
    skip_corrupt: bool = False,
) -> DataFrame:
    """Rows under ``root``; the source's name is text, even if it looks like a number.

    With ``names`` only the folders of those sources are listed and read.
    """
    fields = [f for f in schema.fields if f.name != source]
    reader = spark.read.schema(T.StructType([*fields, T.StructField(source, T.StringType())]))
    reader = reader.option("ignoreCorruptFiles", skip_corrupt).option("basePath", root)
    paths = [root] if names is None else [f"{root}/{_folder(spark, source, n)}" for n in names]
    return reader.parquet(*paths)


def bronze_append(
    spark: SparkSession,
    landing: str,
    bronze: str,
    source: str = "_source_file",
    schema: T.StructType | None = None,
) -> DataFrame:
    """Append the landing files that bronze lacks; return one row per new file.

    ``(source, row_count, loaded)``: a file without rows is loaded.  A source of
    which one part cannot be read to its end is not: nothing of it is written,
    it does not stop the others, and the next run tries it again.  The new files
    are found from folder names, so the landing files already loaded are not
    read, and a repeated run replaces what an interrupted one wrote.
    """
    landed = landed_sources(spark, landing, source)
    done = landed_sources(spark, bronze, source) if path_exists(spark, bronze) else None
    new = [row[0] for row in new_keys(done, landed, source).collect()]
    report = f"{source} string, row_count bigint, loaded boolean"
    if schema is None and new:
        schema = _first_schema(spark, [f"{landing}/{_folder(spark, source, n)}" for n in new])
    if not new or schema is None:
        return spark.createDataFrame([(n, 0, False) for n in new], report)
    broken = _broken_sources(spark, landing, new, source, schema)
    good = [n for n in new if n not in broken]
    counts: dict[str, int] = {}
    if good:
        land_parquet(read_landed(spark, landing, schema, source, good), bronze, source)
        empty = read_landed(spark, landing, schema, source, good).limit(0)
        written = {r[0] for r in landed_sources(spark, bronze, source).collect()}
        land_empty(empty, bronze, [n for n in good if n not in written], source)
        held = read_landed(spark, bronze, schema, source, good).groupBy(source).count()
        counts = {r[0]: r[1] for r in held.collect()}
    return spark.createDataFrame([(n, counts.get(n, 0), n not in broken) for n in new], report)


def _broken_sources(
    spark: SparkSession, landing: str, names: Sequence[str], source: str, schema: T.StructType
) -> set[str]:
    """Sources with a file that has no readable footer, or fewer rows than its footer says.

    Both counts are taken by Spark: one from footers alone, one with every value
    decoded.  Only files that neither count saw are opened one by one.
    """
    rows = read_landed(spark, landing, schema, source, names, skip_corrupt=True)
    file = F.col("_metadata.file_path").alias("file")
    values = [F.col(f.name) for f in schema.fields if f.name != source]
    promised = rows.select(source, file).groupBy(source, "file").agg(F.count(F.lit(1)).alias("promised"))
    decoded = rows.select(source, file, F.xxhash64(*values).alias("h")).groupBy(source, "file").agg(
        # The hash must be used, or the values would not be read.
        F.when(F.bit_xor("h").isNotNull(), F.count(F.lit(1))).alias("decoded")
    )
    both = promised.join(decoded, [source, "file"], "full").select(
        source, "file", (F.coalesce("promised", F.lit(0)) == F.coalesce("decoded", F.lit(0))).alias("whole")
    )
    seen = {(r[0], r.file.rsplit("/", 1)[-1]): r.whole for r in both.collect()}
    out = {name for (name, _), whole in seen.items() if not whole}
    for name in names:
        folder = f"{landing}/{_folder(spark, source, name)}"
        for child in _children(spark, folder):
            if child[0] not in "._" and (name, child) not in seen and not _opens(spark, f"{folder}/{child}"):
                out.add(name)
    return out


def _first_schema(spark: SparkSession, folders: Sequence[str]) -> T.StructType | None:
    """The schema of the first file whose footer can be read."""
    for folder in folders:
        for child in _children(spark, folder):
            if child[0] not in "._" and _opens(spark, f"{folder}/{child}"):
                return spark.read.parquet(f"{folder}/{child}").schema
    return None


def _opens(spark: SparkSession, path: str) -> bool:
    """Whether a file has a readable footer."""
    try:
        return spark.read.parquet(path).schema is not None
    except Exception:  # whatever the reason, the file cannot be loaded
        return False
