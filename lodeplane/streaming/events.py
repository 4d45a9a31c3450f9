"""Event streams: windowed counts with a watermark, and newest rows by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def event_stream(spark: SparkSession, folder: str, names: str, schema: T.StructType, files_each: int = 4) -> DataFrame:
    """Parquet files of a folder whose names fit a glob pattern, as they land."""
    return spark.readStream.schema(schema).option("pathGlobFilter", names).option("maxFilesPerTrigger", files_each).parquet(folder)


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums by window and type; rows later than the watermark are left out of a stream. The same in batch and stream."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    rows = rows.withWatermark("ts", late) if events.isStreaming else rows
    counts = rows.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum(F.col("value").cast("decimal(18,2)")).cast("double").alias("total"))
    return counts.select(F.col("window.start").cast("timestamp_ntz").alias("start"), "event_type", "n", "total")


def drain(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """All that has landed, batch by batch, into an idempotent sink; then stop."""
    stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(sink).trigger(availableNow=True).start().awaitTermination()
