"""Incremental forms of the batch operators, for Structured Streaming or batch frames alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tumbling(events: DataFrame, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Counts by window and event type. ts must be a timestamp."""
    return _late(events, late).groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def sliding(events: DataFrame, width: str = "2 hours", step: str = "1 hour", late: str = "1 hour") -> DataFrame:
    return _late(events, late).groupBy(F.window("ts", width, step).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Per user, runs of events with gaps under `gap`."""
    return _late(events, late).groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def dedupe(events: DataFrame, keys: list[str], late: str = "1 hour") -> DataFrame:
    """First row of each key; on a stream within the watermark."""
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys) if events.isStreaming else events.dropDuplicates(keys)


def _late(events: DataFrame, late: str) -> DataFrame:
    return events.withWatermark("ts", late) if events.isStreaming else events


def read(spark, path: str, schema, files: int | None = 1) -> DataFrame:
    """Parquet files of a folder as a stream, so many a micro-batch (None: all that came since the last)."""
    stream = spark.readStream.schema(schema)
    return (stream.option("maxFilesPerTrigger", files) if files else stream).parquet(path)


def drain(stream: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Run the stream over what there is and stop; parquet sink, exactly once by its checkpoint."""
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
