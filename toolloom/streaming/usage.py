"""Counts of tool mentions over a stream of records (an addition of ours)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def usage_by_window(mentions: DataFrame, time: str = "ts", size: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """Counts by window and name; rows later than `late` behind the newest are left out."""
    mentions = mentions.withColumn(time, F.col(time).cast("timestamp"))
    return mentions.withWatermark(time, late).groupBy(F.window(time, size).alias("w"), "function_name").agg(F.count(F.lit(1)).alias("count")).select(F.col("w.start").alias("window_start"), "function_name", "count")
