"""New landing files as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from strataflow.operators.windows import keep_latest
from strataflow.sources.tables import TableStore


def stream_bronze(
    spark: SparkSession,
    landing: str,
    store: TableStore,
    table: str,
    schema: T.StructType,
    keys: Sequence[str],
    newest: Sequence[str],
    checkpoint: str,
    *,
    partition_by: str | None = None,
) -> StreamingQuery:
    """Merge the landing files not seen yet into a table, then stop.

    The checkpoint remembers the files, so each is taken in once across runs.
    A batch that is repeated after a failure merges to the same table, and a row
    that is older than the table's by ``newest`` does not replace it.  Of the
    table's versions the newest two stay.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        latest = keep_latest(batch, keys, newest)
        store.merge(table, latest, keys, partition_by=partition_by, newest=newest)
        store.drop_old(table)

    return (
        spark.readStream.schema(schema)
        .parquet(landing)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
