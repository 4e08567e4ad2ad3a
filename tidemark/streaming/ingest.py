"""Structured Streaming in front of the batch operators: files become micro-batches, each applied once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.changefeed import BucketedTable
from tidemark.storage.table import VersionedTable


def parquet_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def append_stream(stream: DataFrame, table: VersionedTable, checkpoint: str) -> StreamingQuery:
    """Appends what has arrived, then stops. A batch that was committed before a crash is known by its stream (the checkpoint) and number and not appended again;
    other streams into the same table have their own numbers."""

    def write(batch: DataFrame, number: int) -> None:
        table.append(batch, merge_schema=True, batch=(checkpoint, number))

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def apply_stream(stream: DataFrame, table: BucketedTable, checkpoint: str) -> StreamingQuery:
    """Applies a stream of normalised changes; applying a batch twice changes nothing, as repeats count once."""
    return stream.writeStream.foreachBatch(lambda batch, _: table.apply(batch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
