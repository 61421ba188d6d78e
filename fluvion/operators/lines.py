"""Polylines as vertex tables (line, pos, x, y): lengths, even points, running levels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import segment_length


def segments(vertices: DataFrame) -> DataFrame:
    """Each vertex but the first with the one before it (x0, y0), the length of the segment, and that of the line before it."""
    w = Window.partitionBy("line").orderBy("pos")
    s = vertices.withColumns({"x0": F.lag("x").over(w), "y0": F.lag("y").over(w)})
    s = s.withColumn("length", F.coalesce(segment_length(F.col("x0"), F.col("y0"), F.col("x"), F.col("y")), F.lit(0.0)))
    before = F.sum("length").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    return s.withColumn("before", before).where("x0 is not null")


def resample(vertices: DataFrame, spacing: float) -> DataFrame:
    """(line, along, x, y): points every `spacing` along each line, both ends included; an end nearer than 1e-9 to the last point is
    that point. A line without length is its one point twice."""
    s = segments(vertices)
    k = lambda c: F.floor((c - 1e-9) / spacing).cast("long")
    inner = s.withColumn("k", F.explode(F.sequence(F.greatest(k(F.col("before")), F.lit(0)) + 1, F.greatest(k(F.col("before") + F.col("length")), F.lit(0)) + 1)))
    inner = inner.where((F.col("k") * spacing <= F.col("before") + F.col("length") - 1e-9) & (F.col("length") > 0))
    t = (F.col("k") * spacing - F.col("before")) / F.col("length")
    inner = inner.select("line", (F.col("k") * spacing).alias("along"), (F.col("x0") + t * (F.col("x") - F.col("x0"))).alias("x"), (F.col("y0") + t * (F.col("y") - F.col("y0"))).alias("y"))
    ends = s.groupBy("line").agg(F.min_by("x0", "pos").alias("x0"), F.min_by("y0", "pos").alias("y0"), F.max_by("x", "pos").alias("x"), F.max_by("y", "pos").alias("y"), F.sum("length").alias("total"))
    first = ends.select("line", F.lit(0.0).alias("along"), F.col("x0").alias("x"), F.col("y0").alias("y"))
    last = ends.join(inner.groupBy("line").agg(F.max("along").alias("far")), "line", "left").where(F.col("far").isNull() | (F.col("total") > F.col("far") + 1e-9))
    return first.unionAll(inner.select("line", "along", "x", "y")).unionAll(last.select("line", F.col("total").alias("along"), "x", "y"))


def never_rising(path: DataFrame, line: str, pos: str, z: str) -> DataFrame:
    """path with level, the lowest z so far on the way down; and step, the rise from the cell before."""
    w = Window.partitionBy(line).orderBy(pos)
    return path.withColumns({"level": F.min(z).over(w.rowsBetween(Window.unboundedPreceding, 0)), "step": F.col(z) - F.lag(z).over(w)})


def distance_along(path: DataFrame, line: str, pos: str, length: str) -> DataFrame:
    """path with dist, the summed lengths up to each row."""
    return path.withColumn("dist", F.sum(length).over(Window.partitionBy(line).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)))
