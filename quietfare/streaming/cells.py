"""Windowed, suppressed cell counts over a stream: the batch aggregate's analogue with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_cells(stream: DataFrame, ts: str, dimensions: list[str], minutes: int = 60, late: str = "2 hours", k: int = 5) -> DataFrame:
    """Counts per window and dimension, emitted once the watermark has passed; cells below ``k`` are left out.

    Rows later than ``late`` are ignored, so the state stays bounded.
    """
    timed = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    counted = timed.groupBy(F.window("_ts", f"{minutes} minutes").alias("w"), *dimensions).agg(F.count(F.lit(1)).alias("trip_count"))
    return counted.where(F.col("trip_count") >= k).select(F.col("w.start").alias("bucket"), *dimensions, "trip_count")
