"""Incremental append of daily prices from a landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerwave.sources.lake import merge_new_rows

FILES_PER_BATCH = 256


def landing_stream(
    spark: SparkSession, path: str, schema: StructType, files: int = FILES_PER_BATCH
) -> DataFrame:
    """Files of a landing folder, each read once per checkpoint, at most
    ``files`` in one batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files)
    return reader.parquet(path)


def append_prices(
    stream: DataFrame, target: str, checkpoint: str, keys: list[str], day: str
) -> None:
    """Drain what has arrived into the day-partitioned target, then stop."""
    schema = stream.schema

    def merge(batch: DataFrame, _: int) -> None:
        merge_new_rows(batch, target, keys, day, schema)

    (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def dedupe_within(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """Streaming de-duplication with bounded state, for sinks that cannot be
    read back. Copies further apart than ``delay`` are not recognised, and rows
    older than the watermark are dropped: use ``append_prices`` where every row
    must survive."""
    return stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(
        event_time, delay
    ).dropDuplicatesWithinWatermark(keys)


def append_new_events(
    stream: DataFrame, target: str, checkpoint: str, keys: list[str], event_time: str, delay: str
) -> None:
    """Drain what has arrived into a parquet sink that is never read back.

    What was seen lives in the state store, for ``delay`` of event time. A restart
    from the checkpoint goes on with the same state and watermark; rows behind the
    watermark are late and dropped.
    """
    fresh = dedupe_within(stream, keys, event_time, delay)
    writer = fresh.writeStream.format("parquet").option("path", target)
    (
        writer.option("checkpointLocation", checkpoint).outputMode("append")
        .trigger(availableNow=True).start().awaitTermination()
    )
