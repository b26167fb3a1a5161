"""Page views as a stream: an append sink, and counts by window (an extension: nothing else here streams)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def window_counts(events: DataFrame, width: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Tumbling counts by type; rows later than the watermark are left out by a stream (a batch has no watermark)."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
