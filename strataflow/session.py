"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_scope: ContextVar[str | None] = ContextVar("staging_scope", default=None)


def build_session(app: str = "strataflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every layer relies on.

    Timestamps are instants read and written in UTC; local wall clocks are
    TIMESTAMP_NTZ.  Adaptive execution stays on, so shuffle partitions are
    coalesced, skewed join partitions split, and small sides broadcast from
    their measured size.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": "false",
        # Recording the call site of every Column costs more than small queries.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the one runtime setting the results depend on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A temporary folder is made only for a local master with the setting unset;
    on a cluster a missing setting is an error, since executors could not see
    the driver's disk.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="strataflow-"))
    return context.getCheckpointDir()


def _folder(spark: SparkSession) -> str:
    return f"{staging_root(spark)}/strataflow/{_scope.get() or spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    """A path under the staging folder that nothing else uses."""
    return f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what is staged inside; frames read from it are void then."""
    token = _scope.set(f"scope-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_folder(spark))
        _scope.reset(token)
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        folder.getFileSystem(conf).delete(folder, True)


def stage(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` once and read it back.

    This cuts the lineage with a file that outlives lost executors, lets a
    result that feeds several branches be computed once, and gives the planner
    its true size, so small tables are broadcast by Spark's own threshold and
    large ones are not.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path).select(df.columns)
