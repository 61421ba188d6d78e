"""Depression filling, components, flats, accumulation over cell grids."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans import fixpoint as fx
from . import whole
from .grid import CELL, flow_direction, level_cells, neighbours


def fill(cells: DataFrame) -> DataFrame:
    """The unique spill level of every cell by relation alone: the least over paths off the grid of the highest cell on it.

    Rounds grow with path length; fill_kernel does one grid a task, this is the form that any engine can check.
    """
    cells = fx.settle(cells.where("z is not null").select(*CELL, "z"))
    top = 2**53
    inner = neighbours(cells).groupBy(*CELL).agg(F.count("*").alias("n"))
    start = cells.join(inner, CELL, "left").select(*CELL, "z", F.when(F.coalesce("n", F.lit(0)) < 8, F.col("z")).otherwise(F.lit(top)).alias("w"))

    def step(s: DataFrame) -> DataFrame:
        low = neighbours(s.select(*CELL, F.col("w").alias("z"))).groupBy(*CELL).agg(F.min("zn").alias("low"))
        return s.join(low, CELL, "left").select(*CELL, "z", F.greatest("z", F.least("w", "low")).alias("w"))

    return fx.fixpoint(start, step, F.bit_xor(F.xxhash64(*CELL, "w"))).select(*CELL, "z", F.col("w").alias("filled"))


def fill_array(z: np.ndarray) -> np.ndarray:
    """Priority flood of one grid; NaN is no data, and whatever borders it or the rim is open."""
    out, done, queue = z.copy(), np.isnan(z), []
    rows, cols = z.shape
    for r in range(rows):
        for c in range(cols):
            if not done[r, c] and (r in (0, rows - 1) or c in (0, cols - 1) or np.isnan(z[r - 1 : r + 2, c - 1 : c + 2]).any()):
                heapq.heappush(queue, (z[r, c], r, c))
    for _, r, c in queue:
        done[r, c] = True
    while queue:
        level, r, c = heapq.heappop(queue)
        for i in range(max(0, r - 1), min(rows, r + 2)):
            for j in range(max(0, c - 1), min(cols, c + 2)):
                if not done[i, j]:
                    done[i, j] = True
                    out[i, j] = max(level, z[i, j])
                    heapq.heappush(queue, (out[i, j], i, j))
    return out


def fill_kernel(cells: DataFrame) -> DataFrame:
    """(dem_id, r, c, z) with filled: one grid a task, for grids of tile size."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = pdf.r.min(), pdf.c.min()
        z = np.full((pdf.r.max() - r0 + 1, pdf.c.max() - c0 + 1), np.nan)
        z[pdf.r - r0, pdf.c - c0] = pdf.z
        return pdf.assign(filled=fill_array(z)[pdf.r - r0, pdf.c - c0])

    return cells.where("z is not null").select(*CELL, F.col("z").cast("double").alias("z")).groupBy("dem_id").applyInPandas(run, f"dem_id {cells.schema['dem_id'].dataType.simpleString()}, r int, c int, z double, filled double")


#: Rows and columns of a tile, which is what a task labels at once.
TILE = 256


def label_array(on: np.ndarray, z: np.ndarray) -> np.ndarray:
    """The flat index of the first cell of each cell's patch: 8-connected cells that are on and of one height; -1 off them."""
    rows, cols = on.shape
    free = rows * cols
    lab = np.full((rows + 2, cols + 2), free, np.int64)
    inner = lab[1:-1, 1:-1]
    inner[on] = np.flatnonzero(on.ravel())
    high = np.full((rows + 2, cols + 2), np.nan)
    high[1:-1, 1:-1] = z
    while True:
        best = inner.copy()
        for i in (0, 1, 2):
            for j in (0, 1, 2):
                near = lab[i : i + rows, j : j + cols]
                best = np.where((high[i : i + rows, j : j + cols] == z) & (near < best), near, best)
        best[~on] = free
        best[on] = np.r_[best.ravel(), free][best[on]]  # to the label of the cell that the label names
        if (best == inner).all():
            return np.where(on, best, -1)
        inner[:] = best


def label(cells: DataFrame, value: str | None = None) -> DataFrame:
    """(dem_id, r, c, label): 8-connected patches of a set of cells, with `value` only of equal values; the label is the first cell
    by row and column. Tiles are labelled by themselves, and then patches that meet across tiles are joined."""
    tile = lambda x: F.floor(F.col(x) / TILE)
    cells = cells.select(*CELL, (F.col(value) if value else F.lit(0)).cast("double").alias("z"))
    kind = cells.schema["dem_id"].dataType.simpleString()

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = pdf.r.min(), pdf.c.min()
        z = np.full((pdf.r.max() - r0 + 1, pdf.c.max() - c0 + 1), np.nan)
        z[pdf.r - r0, pdf.c - c0] = pdf.z
        of = label_array(~np.isnan(z), z)[pdf.r - r0, pdf.c - c0]
        return pdf[["dem_id", "r", "c", "z"]].assign(lr=(r0 + of // z.shape[1]).astype("int32"), lc=(c0 + of % z.shape[1]).astype("int32"))

    tiled = cells.groupBy("dem_id", tile("r").alias("tr"), tile("c").alias("tc")).applyInPandas(run, f"dem_id {kind}, r int, c int, z double, lr int, lc int")
    tiled = fx.settle(tiled.select(*CELL, "z", F.struct("dem_id", F.col("lr").alias("r"), F.col("lc").alias("c")).alias("own")))
    at_edge = lambda x: F.pmod(F.col(x), F.lit(TILE)).isin(0, TILE - 1)
    rim = tiled.where(at_edge("r") | at_edge("c"))
    there = rim.select(F.col("dem_id").alias("_d"), F.col("r").alias("rn"), F.col("c").alias("cn"), F.col("z").alias("_z"), F.col("own").alias("b"))
    met = neighbours(rim).withColumnsRenamed({"rn": "_rn", "cn": "_cn"})
    met = met.join(there, (met["dem_id"] == there["_d"]) & (met["_rn"] == there["rn"]) & (met["_cn"] == there["cn"]))
    across = (tile("r") != tile("rn")) | (tile("c") != tile("cn"))
    edges = fx.settle(met.where(across & (F.col("z") == F.col("_z"))).select(F.col("own").alias("a"), "b").distinct())
    if not edges.limit(1).count():
        return tiled.select(*CELL, F.col("own").alias("label"))
    whole = fx.components(edges)
    return tiled.join(whole, F.col("own") == F.col("id"), "left").select(*CELL, F.coalesce("label", "own").alias("label"))


def flat_cells(cells: DataFrame, more_than: int = 6) -> DataFrame:
    """Level cells in patches of more than six."""
    patches = label(level_cells(cells))
    large = patches.groupBy("label").agg(F.count("*").alias("n")).where(F.col("n") > more_than)
    return patches.join(large, "label", "left_semi").select(*CELL)


def patch_sizes(cells: DataFrame) -> DataFrame:
    """(dem_id, r, c, cells): each patch by its first cell."""
    return label(cells).groupBy("label").agg(F.count("*").alias("cells")).select("label.dem_id", "label.r", "label.c", "cells")


def touching(cells: DataFrame, seeds: DataFrame) -> DataFrame:
    """Cells of the patches that have a seed within a step."""
    patches = label(cells)
    good = patches.join(grown(seeds), CELL, "left_semi").select("label").distinct()
    return patches.join(good, "label", "left_semi").select(*CELL)


def one_cell_wide(mask: DataFrame, streams: DataFrame, lakes: DataFrame, narrow: float = 0.5) -> DataFrame:
    """The mask without water patches that touch only narrow reaches and no lake. streams: (dem_id, r, c, reach). A reach is narrow
    if more than a share of its cells has no water but stream cells within a step."""
    water = fx.settle(mask.select(*CELL).join(streams.select(*CELL), CELL, "left_anti"))
    beside = grown(water).join(streams, CELL, "left_semi").withColumn("_b", F.lit(1))
    on = fx.settle(streams.join(beside, CELL, "left").select(*CELL, "reach", F.coalesce("_b", F.lit(0)).alias("b")))
    wide = on.groupBy("dem_id", "reach").agg(F.avg("b").alias("s")).where(F.col("s") >= 1 - narrow)
    wide = on.join(wide, ["dem_id", "reach"], "left_semi").select(*CELL)
    patches = fx.settle(label(water))
    seeds = grown(wide).unionAll(lakes.select(*CELL)).distinct()
    good = patches.join(seeds, CELL, "left_semi").select("label").distinct()
    kept = patches.join(good, "label", "left_semi").select(*CELL)
    return mask.select(*CELL).join(streams.select(*CELL), CELL, "left_semi").unionAll(kept)


def grown(cells: DataFrame) -> DataFrame:
    """A set of cells and all within a step of it, on or off any grid."""
    one = F.array(*[F.lit(k) for k in (-1, 0, 1)])
    wide = cells.select("dem_id", "r", "c", F.explode(one).alias("i")).select("dem_id", (F.col("r") + F.col("i")).alias("r"), "c", F.explode(one).alias("j"))
    return wide.select("dem_id", "r", (F.col("c") + F.col("j")).alias("c")).distinct()


def flow_accumulation(down: DataFrame, weight: str) -> DataFrame:
    """(dem_id, r, c, total) of pointers (dem_id, r, c, rd, cd) with a weight for each cell: that of all that drain through a cell,
    itself included. Cells on a cycle drain nowhere."""
    to = F.when(F.col("rd").isNotNull(), F.struct("dem_id", F.col("rd").alias("r"), F.col("cd").alias("c")))
    return fx.accumulate(down.select(F.struct(*CELL).alias("id"), to.alias("down"), F.col(weight).alias("w"))).select("id.dem_id", "id.r", "id.c", "total")


#: Cells of the largest grid that one task solves, which takes some 350 MB.
LARGEST = 2**19


def _by_size(cells: DataFrame, space: DataFrame | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(dem_id, r, c, z, dx, dy), all of a grid in one partition, of the grids of at most LARGEST cells, and the cells of those beyond
    or None. The spacings (dem_id, r, dx, dy) ride along as rows without c."""
    nothing = F.lit(None).cast("double")
    rows = cells.where("dem_id is not null and r is not null and c is not null").select(*CELL, "z", nothing.alias("dx"), nothing.alias("dy"))
    if space is not None:
        kinds = {f.name: f.dataType for f in rows.schema}
        alone = [F.lit(None).cast(kinds[x]).alias(x) for x in ("c", "z")]
        own = space.where("dem_id is not null and r is not null").select(F.col("dem_id").cast(kinds["dem_id"]), F.col("r").cast(kinds["r"]), *alone, F.col("dx").cast("double"), F.col("dy").cast("double"))
        rows = rows.unionAll(own)
    rows = fx.settle(rows.repartition("dem_id"))
    large = fx.settle(rows.groupBy("dem_id").agg(F.count("c").alias("n")).where(F.col("n") > LARGEST).select("dem_id"))
    if not large.limit(1).count():
        return rows, None
    rest = rows.join(large, "dem_id", "left_semi").where("c is not null").select(*CELL, "z")
    return rows.join(large, "dem_id", "left_anti").repartition("dem_id"), rest


def _solved(rows: DataFrame, raw: bool, coded: bool) -> DataFrame:
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"`{x}` {kinds[x]}" for x in CELL) + (", code int" if coded else ", steps int")
    return rows.sortWithinPartitions("dem_id").mapInArrow(lambda batches: whole.run(batches, raw, coded), schema)


def flat_gradient(cells: DataFrame, raw: bool = False) -> DataFrame:
    """(dem_id, r, c, steps): on flats of a filled grid, the gradient of Barnes et al. (2014) in steps, 0 off them. raw: fill first.

    A cell drains if a neighbour is lower, or off the grid or no data; flats are patches of one level whose other cells
    reach one that drains, a low edge. Steps are twice those from the low edges (which are 1), plus, where higher
    ground is reached through the flat, the most steps away from it in the flat less the cell's own. Integers, so that
    directions on flats compare as pairs (height, steps) and no height is ever nudged.

    A task solves whole grids of at most LARGEST cells, larger ones go by rounds over cells.
    """
    rows, large = _by_size(cells.where("z is not null") if raw else cells)
    out = _solved(rows, raw, False)
    return out if large is None else out.unionAll(gradient_by_rounds(_filled(large) if raw else large))


def _filled(cells: DataFrame) -> DataFrame:
    return fill(cells).select(*CELL, F.col("filled").alias("z"))


def gradient_by_rounds(cells: DataFrame) -> DataFrame:
    """flat_gradient by relation alone; rounds grow with the longest way through a flat."""
    cells = fx.settle(cells.select(*CELL, "z"))
    near = fx.settle(neighbours(cells))
    around = near.groupBy(*CELL).agg(F.count("*").alias("n"), F.min("zn").alias("low"), F.max("zn").alias("high"))
    closed = (F.coalesce("n", F.lit(0)) == 8) & (F.col("low") >= F.col("z"))
    kinds = fx.settle(cells.join(around, CELL, "left").select(*CELL, F.coalesce(closed, F.lit(False)).alias("flat"), (F.col("high") > F.col("z")).alias("beside")))
    level = near.where("z = zn").select(*CELL, "rn", "cn")
    links = fx.settle(level.join(kinds.where("flat").select(*CELL), CELL, "left_semi"))  # into flat cells only
    edge = links.select("dem_id", F.col("rn").alias("r"), F.col("cn").alias("c")).distinct().withColumn("met", F.lit(True))
    start = kinds.join(edge, CELL, "left").select(*CELL, F.when(~F.col("flat") & F.col("met"), 1).alias("toward"), F.when(F.col("flat") & F.col("beside"), 1).alias("away"))

    def step(s: DataFrame) -> DataFrame:
        there = s.select("dem_id", F.col("r").alias("rn"), F.col("c").alias("cn"), F.col("toward").alias("t"), F.col("away").alias("a"))
        low = links.join(there, ["dem_id", "rn", "cn"]).groupBy(*CELL).agg(F.min("t").alias("t"), F.min("a").alias("a"))
        return s.join(low, CELL, "left").select(*CELL, F.least("toward", F.col("t") + 1).alias("toward"), F.least("away", F.col("a") + 1).alias("away"))

    far = fx.fixpoint(start, step, F.struct(F.count("toward"), F.sum("toward"), F.count("away"), F.sum("away")))
    met = far.join(label(cells, "z"), CELL)
    height = met.groupBy(F.col("label").alias("_l")).agg(F.max("away").alias("height"))
    met = met.join(height, F.col("label") == F.col("_l"), "left")
    return met.select(*CELL, F.coalesce(2 * F.col("toward") + F.coalesce(F.col("height") - F.col("away"), F.lit(0)), F.lit(0)).cast("int").alias("steps"))


def drained(cells: DataFrame, space: DataFrame, raw: bool = False) -> DataFrame:
    """(dem_id, r, c, code): directions on a filled grid (dem_id, r, c, z), flats resolved by their gradient. raw: fill first."""
    rows, large = _by_size(cells.where("z is not null"), space)
    out = _solved(rows, raw, True)
    if large is None:
        return out
    large = fx.settle(_filled(large) if raw else large)
    return out.unionAll(flow_direction(large.join(gradient_by_rounds(large), CELL), space, "steps"))


def water_mask(streams: DataFrame, water: DataFrame, ocean: DataFrame) -> DataFrame:
    """Streams, and water patches that touch them, without the ocean."""
    wet = streams.select(*CELL).unionAll(water.select(*CELL)).distinct().join(ocean, CELL, "left_anti")
    return touching(wet, streams)
