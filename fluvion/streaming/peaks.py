"""An extension: running peaks of landed forecast files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def windowed_peaks(stream: DataFrame, late: str = "1 hour", every: str = "6 hours") -> DataFrame:
    """Peak flow for each river in each issue window; rows later than the watermark are dropped by Spark."""
    return stream.withWatermark("time", late).groupBy(F.window("time", every), "rivid").agg(F.max("qout").alias("peak")).select("rivid", F.col("window.start").alias("start"), "peak")
