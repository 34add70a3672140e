"""Streaming extensions: observations that arrive over time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def counts_per_window(events: DataFrame, time: str, key: str, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Events per window and key; batch and stream alike."""
    source = events.withWatermark(time, late) if events.isStreaming else events
    return source.groupBy(F.window(time, window).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), key, "n")


def first_arrivals(events: DataFrame, key: str, time: str, late: str = "1 day") -> DataFrame:
    """Repeats of a key within the watermark dropped."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark([key]) if events.isStreaming else events.dropDuplicates([key])
