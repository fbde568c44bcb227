"""Deltas put into a versioned table as their files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from worktally.sources.versioned import VersionedTable


def stream_upserts(spark: SparkSession, folder: str, schema: StructType, table: VersionedTable, keys: list[str], order: list[str], checkpoint: str) -> StreamingQuery:
    """Start a query that upserts new JSON files of ``folder`` and ends when all that is there is done.

    A batch that is run again after a failure gives the same table, since an upsert is idempotent.
    """
    stream = spark.readStream.schema(schema).json(folder)

    def put(batch: DataFrame, _: int) -> None:
        table.upsert(batch, keys, order)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
