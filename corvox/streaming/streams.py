"""Streaming forms: cleaning line by line, gap sessions by event time, running statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import cleaning


def manifest_stream(spark: SparkSession, folder: str, schema: str, files_at_once: int = 100) -> DataFrame:
    """New JSON-lines files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).json(folder)


def cleaned_stream(rows: DataFrame, steps: list[cleaning.Step], text: str = "text") -> DataFrame:
    """The cleaning pipeline over a stream: every filter looks at one row, so no state is held."""
    return cleaning.cleaned(rows, steps, text)


def sessions(events: DataFrame, time: str, keys: list[str], gap: str, late: str) -> DataFrame:
    """(keys, start, end, n): runs of events with pauses under gap; events later than `late` are left out."""
    w = F.session_window(F.col(time), gap)
    out = events.withWatermark(time, late).groupBy(*keys, w.alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return out.select(*keys, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def windowed_counts(events: DataFrame, time: str, keys: list[str], width: str, late: str) -> DataFrame:
    """(keys, start, n): counts of tumbling windows."""
    out = events.withWatermark(time, late).groupBy(*keys, F.window(F.col(time), width).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return out.select(*keys, F.col("w.start").alias("start"), "n")
