"""Reaches as cells of a stream grid: the paths that flow directions take through them, and where they start below a lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans import fixpoint as fx
from .grid import CELL, offsets

#: Steps in which a path must be back in its reach: a drawn line strays a little from the directions.
OFF_REACH_STEPS = 2


def reach_links(streams: DataFrame, down: DataFrame, steps: int = OFF_REACH_STEPS) -> DataFrame:
    """(dem_id, r, c, reach, rn, cn, gap): the next cell of its reach that each stream cell (dem_id, r, c, reach) drains into by
    pointers (dem_id, r, c, rd, cd), and in how many steps; null where the path stays out for longer."""
    own = streams.select(F.col("dem_id").alias("_d"), F.col("r").alias("_r"), F.col("c").alias("_c"), F.col("reach").alias("_reach"))
    to = down.select(F.col("dem_id").alias("_d"), F.col("r").alias("_r"), F.col("c").alias("_c"), "rd", "cd")
    at = lambda t, r, c: (F.col("dem_id") == t["_d"]) & (F.col(r) == t["_r"]) & (F.col(c) == t["_c"])
    out = streams.select(*CELL, "reach", F.col("r").alias("ra"), F.col("c").alias("ca"), *[F.lit(None).cast("int").alias(k) for k in ("rn", "cn", "gap")])
    for n in range(1, steps + 1):
        out = out.join(to, at(to, "ra", "ca"), "left").drop("_d", "_r", "_c")
        out = out.join(own, at(own, "rd", "cd") & (F.col("reach") == own["_reach"]), "left")
        here = F.col("gap").isNull() & F.col("_reach").isNotNull()
        new = {"rn": F.when(here, F.col("rd")).otherwise(F.col("rn")), "cn": F.when(here, F.col("cd")).otherwise(F.col("cn")), "gap": F.when(here, n).otherwise(F.col("gap"))}
        out = out.withColumns(new).select(*CELL, "reach", F.col("rd").alias("ra"), F.col("cd").alias("ca"), "rn", "cn", "gap")
    return out.drop("ra", "ca")


def trace_reaches(streams: DataFrame, down: DataFrame, steps: int = OFF_REACH_STEPS) -> DataFrame:
    """(dem_id, reach, r0, c0, r1, c1, length): the path through each reach that covers most of its cells, the longer and then the
    first by row and column of equal ones: where it starts, its last cell, and how many cells it visits.

    Ways down are followed by doubling, so a reach of n cells takes log2(n) joins. Cells on a cycle, which resolved
    directions don't have, lead nowhere.
    """
    links = reach_links(streams, down, steps)
    to = F.when(F.col("gap").isNotNull(), F.struct("dem_id", F.col("rn").alias("r"), F.col("cn").alias("c"), "reach"))
    paths = fx.path_sums(links.select(F.struct(*CELL, "reach").alias("id"), to.alias("down"), F.coalesce("gap", F.lit(0)).alias("w")))
    best = F.max_by(F.struct("id", "root", "total"), F.struct("depth", "total", -F.col("id.r"), -F.col("id.c"))).alias("b")
    head = paths.groupBy("id.dem_id", "id.reach").agg(best)
    return head.select("dem_id", "reach", *[F.col(f"b.{end}.{x}").alias(f"{x}{k}") for k, end in enumerate(("id", "root")) for x in ("r", "c")], (F.col("b.total") + 1).alias("length"))


def stream_info(streams: DataFrame, down: DataFrame, grids: DataFrame, steps: int = OFF_REACH_STEPS) -> DataFrame:
    """(dem_id, start_pixel, end_pixel, length, stream_id) of the reaches above 0 on grids (dem_id, ncols): cells numbered by rows."""
    traced = trace_reaches(streams.where("reach > 0"), down, steps).join(grids.select("dem_id", "ncols"), "dem_id")
    pixel = lambda k: (F.col(f"r{k}").cast("long") * F.col("ncols") + F.col(f"c{k}"))
    return traced.select("dem_id", pixel(0).alias("start_pixel"), pixel(1).alias("end_pixel"), "length", F.col("reach").alias("stream_id"))


def below_outlets(paths: DataFrame, lake: DataFrame, near: int, window: int, tail: int, drop: float, least: int) -> DataFrame:
    """paths (dem_id, reach, pos from 0, r, c, z, joined) without the cells of reaches that leave a lake above the outlet's foot.

    A reach leaves a lake if its first cell is within `near` cells of one. Its foot is below the last step of at least `drop`
    in its first `window` steps, ending where another reach first joins (joined) it. It keeps its cells if another reach joins its
    first one, if it falls so again within `tail` steps of the foot, or if fewer than `least` cells would be left.
    """
    w = Window.partitionBy("dem_id", "reach").orderBy("pos")
    falls = paths.withColumn("_fall", F.coalesce(F.col("z") - F.lead("z").over(w) >= drop, F.lit(False)) & (F.col("pos") < window + tail))
    shore = lake.select(*CELL, F.explode(offsets(near, self_too=True)).alias("o")).select("dem_id", (F.col("r") + F.col("o.dr")).alias("r"), (F.col("c") + F.col("o.dc")).alias("c")).distinct()
    leaving = paths.where("pos = 0 and not joined").join(shore, CELL, "left_semi").select("dem_id", "reach")
    mine = falls.join(leaving, ["dem_id", "reach"])
    ends = mine.groupBy("dem_id", "reach").agg(F.coalesce(F.min(F.when(F.col("joined"), F.col("pos"))), F.lit(2**31 - 1)).alias("_end"), F.count("*").alias("_n"), F.collect_list(F.when(F.col("_fall"), F.col("pos"))).alias("_falls"))  # at most window + tail in a list
    foot = ends.withColumn("_foot", F.array_max(F.filter("_falls", lambda x: x < F.least(F.lit(window), F.col("_end")))) + 1)
    again = F.exists("_falls", lambda x: (x >= F.col("_foot")) & (x < F.col("_foot") + tail))
    foot = foot.where(F.col("_foot").isNotNull() & ~again & (F.col("_n") - F.col("_foot") >= least)).select("dem_id", "reach", "_foot")
    return paths.join(foot, ["dem_id", "reach"], "left").where(F.col("_foot").isNull() | (F.col("pos") >= F.col("_foot"))).drop("_foot")
