"""Structured Streaming forms of the series operators: sessions between gaps, first results only, appended batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def gap_sessions(points: DataFrame, key: str, ts: str, value: str, gap: str = "6 hours", late: str = "1 day") -> DataFrame:
    """(key, start, stop, n, mean) of stretches between gaps; with a stream, late points are waited for so long."""
    source = points.withWatermark(ts, late) if points.isStreaming else points
    got = source.groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"))
    return got.select(key, F.col("w.start").alias("start"), F.col("w.end").alias("stop"), "n", "mean")


def first_results(rows: DataFrame, keys: list[str], ts: str, late: str = "1 day") -> DataFrame:
    """One row a key: repeats within the watermark are dropped."""
    return rows.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys) if rows.isStreaming else rows.dropDuplicates(keys)


def run_to_table(rows: DataFrame, path: str, checkpoint: str, mode: str = "append"):
    """Process what is there and stop; a restart goes on from the checkpoint."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
