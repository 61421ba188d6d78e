"""Views of the driver's tables that have the shape of the engine's inputs; SQL twins for the oracles stand beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensemble(spark, d):
    return table(spark, d, "events").select(F.col("user_id").alias("rivid"), F.col("event_type").alias("ensemble"), F.col("ts").alias("time"), F.col("value").alias("qout"))


ENSEMBLE = "ensemble AS (SELECT user_id AS rivid, event_type AS ensemble, ts AS time, value AS qout FROM events)"

PERIODS = {1: 2, 2: 5, 3: 10, 4: 25, 5: 50}


def return_periods(spark, d):
    """Long flows by river and return period; the period comes from the priority's digit, flows are whole cents."""
    digit = F.substring("o_orderpriority", 1, 1).cast("int")
    rp = F.element_at(F.create_map(*[F.lit(x) for kv in PERIODS.items() for x in kv]), digit)
    return table(spark, d, "orders").select(F.col("o_custkey").alias("river_id"), rp.alias("rp"), F.round(F.col("o_totalprice") * 100).cast("long").alias("flow"))


RP = "rp AS (SELECT o_custkey AS river_id, CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 2 WHEN '2' THEN 5 WHEN '3' THEN 10 WHEN '4' THEN 25 ELSE 50 END AS rp, CAST(round(o_totalprice * 100) AS BIGINT) AS flow FROM orders)"


def network(spark, d):
    """A binary forest of reaches: id, downstream id (-1 at the outlet), order, area."""
    area = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("_c")).agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("cents"))
    c = table(spark, d, "customer").select((F.col("c_custkey") + 1).alias("reach"), "c_nationkey", "c_mktsegment")
    n = c.join(area, F.col("reach") - 1 == F.col("_c"), "left")
    return n.select("reach", F.when(F.col("reach") == 1, -1).otherwise(F.expr("reach div 2")).cast("long").alias("ds"), (F.col("c_nationkey") % 7 + 1).cast("int").alias("ord"), F.coalesce("cents", F.lit(0)).alias("area"), F.col("c_mktsegment").alias("segment"))


NETWORK = """areas AS (SELECT o_custkey AS k, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM orders GROUP BY 1),
network AS (SELECT c_custkey + 1 AS reach, CASE WHEN c_custkey = 0 THEN -1 ELSE (c_custkey + 1) // 2 END AS ds, CAST(c_nationkey % 7 + 1 AS INTEGER) AS ord, coalesce(cents, 0) AS area, c_mktsegment AS segment FROM customer LEFT JOIN areas ON k = c_custkey)"""


def _cells(spark, d, z):
    """Grids of 16 by 16 cells, one for each supplier, so that there are more of them as the table grows; some cells are no data."""
    return table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("dem_id"), (F.col("l_orderkey") % 16).cast("int").alias("r"), (F.col("l_partkey") % 16).cast("int").alias("c")).agg(z.alias("z"))


_CELLS = "SELECT l_suppkey AS dem_id, CAST(l_orderkey % 16 AS INTEGER) AS r, CAST(l_partkey % 16 AS INTEGER) AS c"


def grid(spark, d):
    """Grids of whole cents."""
    return _cells(spark, d, F.min(F.round(F.col("l_extendedprice") * 100).cast("long")))


GRID = f"grid AS ({_CELLS}, min(CAST(round(l_extendedprice * 100) AS BIGINT)) AS z FROM lineitem GROUP BY 1, 2, 3)"


def small_grid(spark, d):
    """Grids of few levels."""
    return _cells(spark, d, (F.min(F.floor("l_extendedprice")) % 10).cast("long"))


SMALL = f"small AS ({_CELLS}, CAST(min(floor(l_extendedprice)) AS BIGINT) % 10 AS z FROM lineitem GROUP BY 1, 2, 3)"


def grids(spark, d):
    """What is known of each grid: every other one is in degrees."""
    return table(spark, d, "supplier").selectExpr("s_suppkey dem_id", "20.0D + s_suppkey % 40 y0", "if(s_suppkey % 2 = 0, 0.001D, 30.0D) cell_x", "if(s_suppkey % 2 = 0, 0.002D, 20.0D) cell_y", "16 nrows", "s_suppkey % 2 = 0 degrees")


SPACE = """rows16 AS (SELECT unnest(range(0, 16)) AS r),
space AS (SELECT s_suppkey AS dem_id, CAST(r AS INTEGER) AS r,
 CASE WHEN s_suppkey % 2 = 0 THEN 0.001::DOUBLE * (111412.84::DOUBLE * cos(radians(20 + s_suppkey % 40 - (r + 0.5::DOUBLE) * 0.002::DOUBLE)) - 93.5::DOUBLE * cos(3 * radians(20 + s_suppkey % 40 - (r + 0.5::DOUBLE) * 0.002::DOUBLE))) ELSE 30.0::DOUBLE END AS dx,
 CASE WHEN s_suppkey % 2 = 0 THEN 0.002::DOUBLE * (111132.92::DOUBLE - 559.82::DOUBLE * cos(2 * radians(20 + s_suppkey % 40 - 8.5::DOUBLE * 0.002::DOUBLE)) + 1.175::DOUBLE * cos(4 * radians(20 + s_suppkey % 40 - 8.5::DOUBLE * 0.002::DOUBLE))) ELSE 20.0::DOUBLE END AS dy
 FROM supplier, rows16)"""
