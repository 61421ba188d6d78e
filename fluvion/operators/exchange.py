"""Water levels between neighbouring tiles: crossing reaches, boundary water, gathering."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def boxes_meet(a: str, b: str) -> Column:
    """Strict: boxes that touch don't meet."""
    g = lambda t, k: F.col(f"{t}.{k}")
    return (g(a, "xmin") < g(b, "xmax")) & (g(b, "xmin") < g(a, "xmax")) & (g(a, "ymin") < g(b, "ymax")) & (g(b, "ymin") < g(a, "ymax"))


def neighbour_tiles(tiles: DataFrame) -> DataFrame:
    """Pairs of tiles of one CRS whose boxes meet, over the cells of a coarse grid that each box covers; itself excluded."""
    size = 4
    cells = tiles.select("tile", "crs", F.struct("xmin", "ymin", "xmax", "ymax").alias("box"), F.explode(F.sequence(F.floor(F.col("xmin") / size), F.floor(F.col("xmax") / size))).alias("gx"), F.col("ymin"), F.col("ymax"))
    cells = cells.select("tile", "crs", "box", "gx", F.explode(F.sequence(F.floor(F.col("ymin") / size), F.floor(F.col("ymax") / size))).alias("gy"))
    a = cells.select("crs", "gx", "gy", F.col("tile"), F.col("box").alias("a"))
    b = cells.select("crs", "gx", "gy", F.col("tile").alias("other"), F.col("box").alias("b"))
    return a.join(b, ["crs", "gx", "gy"]).where((F.col("tile") != F.col("other")) & boxes_meet("a", "b")).select("tile", "other").distinct()


def crosses(x1: str, y1: str, x2: str, y2: str, at: float, lo: float, hi: float) -> Column:
    """A segment meets the upright line x = at between lo and hi."""
    dx = F.col(x2) - F.col(x1)
    y = F.col(y1) + (at - F.col(x1)) * (F.col(y2) - F.col(y1)) / F.when(dx != 0, dx)
    return (F.least(x1, x2) <= at) & (F.greatest(x1, x2) >= at) & F.coalesce(y.between(lo, hi), (F.least(y1, y2) <= hi) & (F.greatest(y1, y2) >= lo))


def crossing_reaches(segments: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float, distance: float) -> DataFrame:
    """Reaches that meet one of four lines, each inside an edge of a box by a distance and as long as the box."""
    upright = [crosses("x1", "y1", "x2", "y2", x, ymin, ymax) for x in (xmin + distance, xmax - distance)]
    level = [crosses("y1", "x1", "y2", "x2", y, xmin, xmax) for y in (ymin + distance, ymax - distance)]
    return segments.where(upright[0] | upright[1] | level[0] | level[1]).select("reach").distinct()


#: Cells past the lines that still count as the boundary's.
EDGE_CELLS = 3


def near_edge(x: str, y: str, xmin: float, ymin: float, xmax: float, ymax: float, distance: float, cell: float) -> Column:
    """Inside a box and no further in than a distance and a few cells."""
    inward = F.least(F.col(x) - xmin, xmax - F.col(x), F.col(y) - ymin, ymax - F.col(y))
    return (inward >= 0) & (inward <= distance + EDGE_CELLS * cell)


def boundary_water(vdt: DataFrame, crossing: DataFrame, edge: Column | None = None) -> DataFrame:
    """Long rows (reach, flow, wse) of the rating curves of crossing reaches, near the edge if that is given, nulls dropped."""
    vdt = vdt if edge is None else vdt.where(edge)
    rows = vdt.join(crossing, "reach", "left_semi").select("reach", F.explode(F.arrays_zip("q", "wse")).alias("p"))
    return rows.select("reach", F.col("p.q").alias("flow"), F.col("p.wse").alias("wse")).where("flow is not null and wse is not null")


def gather(points: DataFrame, xmin: float, ymin: float, xmax: float, ymax: float, own: str) -> DataFrame:
    """Neighbours' water strictly inside a raster."""
    return points.where((F.col("tile") != own) & (F.col("x") > xmin) & (F.col("x") < xmax) & (F.col("y") > ymin) & (F.col("y") < ymax))
