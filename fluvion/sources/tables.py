"""Scans and sinks: bounding boxes, projections, flow files, retention of forecasts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import forecast_date

# Land-cover class and Manning's n.
MANNING = {10: 0.12, 20: 0.05, 30: 0.03, 40: 0.035, 50: 0.075, 60: 0.03, 70: 0.03, 80: 0.03, 90: 0.1, 95: 0.1, 100: 0.1}


def scan_in_box(spark: SparkSession, path: str, columns: list[str], xmin: float, ymin: float, xmax: float, ymax: float) -> DataFrame:
    """Rows whose bbox struct meets a box; the four comparisons reach the Parquet scan and skip row groups."""
    df = spark.read.parquet(path)
    return df.where((F.col("bbox.xmax") > xmin) & (F.col("bbox.xmin") < xmax) & (F.col("bbox.ymax") > ymin) & (F.col("bbox.ymin") < ymax)).select(*columns, "bbox", "geom")


def write_sorted(df: DataFrame, path: str) -> None:
    """Rows in bbox order, so that later scans skip."""
    df.sortWithinPartitions("bbox.xmin", "bbox.ymin").write.mode("overwrite").option("compression", "zstd").parquet(path)


def bounds(df: DataFrame) -> DataFrame:
    return df.agg(F.min("bbox.xmin").alias("xmin"), F.min("bbox.ymin").alias("ymin"), F.max("bbox.xmax").alias("xmax"), F.max("bbox.ymax").alias("ymax"))


def write_flow_table(table: DataFrame, path: str) -> None:
    """Parquet or CSV by the path's suffix."""
    writer = table.write.mode("overwrite")
    writer.option("compression", "zstd").parquet(path) if path.endswith(".parquet") else writer.option("header", True).csv(path)


def read_flow_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path) if path.endswith(".parquet") else spark.read.option("header", True).option("inferSchema", True).csv(path)


def one_flow(table: DataFrame, flow: str) -> DataFrame:
    """The key and one of the flows."""
    return table.select("COMID", flow)


def write_periods(wide: DataFrame, path: str, periods: list[int]) -> None:
    """One folder for each return period, by one partitioned write."""
    long = wide.select("COMID", F.explode(F.map_from_arrays(F.array(*map(F.lit, periods)), F.array(*[F.col(f"rp{p}") for p in periods]))).alias("rp", "flow"))
    long.write.mode("overwrite").partitionBy("rp").parquet(path)


def expired(names: DataFrame, today: str, days: int, dem: str, current: str | None = None) -> DataFrame:
    """Forecast files of a DEM that were issued so many days ago or more, but for the current forecast (yyyymmdd). A file is a DEM's
    if its name is the DEM's, the forecast's date and hour, and then a dot or an underscore. The caller unlinks them."""
    issued = forecast_date(F.col("name"))
    own = F.col("name").rlike(f"^{re.escape(dem)}_Forecast_[0-9]{{8}}(_[0-9]{{2}})?[._]")
    old = own & (F.datediff(F.lit(today).cast("date"), issued) >= days)
    return names.where(old & (F.date_format(issued, "yyyyMMdd") != current) if current else old)


def manning(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(MANNING.items()), "lc_id int, n double")


def forecast_files(spark: SparkSession, members: int, first: int, end: int, every: int) -> DataFrame:
    """Member and lead hour of each file of a product; the end is exclusive."""
    return spark.range(1, members + 1).select(F.col("id").cast("int").alias("member"), F.explode(F.sequence(F.lit(first), F.lit(end - 1), F.lit(every))).alias("hour"))
