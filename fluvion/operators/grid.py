"""Cell tables (dem_id, r, c, z): neighbours, flow direction, focal predicates, windows, zonal joins. A null z is no data.

Many grids share a table; every join and group has dem_id in its key, so no cell meets one of another grid.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import metres_per_degree

#: What a cell is known by.
CELL = ["dem_id", "r", "c"]

# Flow-direction codes with their row and column steps, in the order that breaks ties.
DIRECTIONS = [(64, -1, -1), (128, -1, 0), (1, -1, 1), (32, 0, -1), (2, 0, 1), (16, 1, -1), (8, 1, 0), (4, 1, 1)]


def offsets(reach: int = 1, self_too: bool = False) -> Column:
    steps = [(k, dr, dc) for k, (_, dr, dc) in enumerate(DIRECTIONS)] if reach == 1 else [(0, dr, dc) for dr in range(-reach, reach + 1) for dc in range(-reach, reach + 1) if dr or dc]
    steps += [(-1, 0, 0)] if self_too else []
    return F.array(*[F.struct(F.lit(k).alias("k"), F.lit(dr).alias("dr"), F.lit(dc).alias("dc")) for k, dr, dc in steps])


def neighbours(cells: DataFrame, reach: int = 1, value: str = "z", self_too: bool = False) -> DataFrame:
    """(r, c, z, k, zn): each cell with each valid neighbour; the cell is sent to its neighbours, one equi-join."""
    sent = cells.where(F.col(value).isNotNull()).select("*", F.explode(offsets(reach, self_too)).alias("o"))
    sent = sent.select(*cells.columns, F.col("o.k").alias("k"), (F.col("r") + F.col("o.dr")).alias("_r"), (F.col("c") + F.col("o.dc")).alias("_c"))
    there = cells.where(F.col(value).isNotNull()).select(F.col("dem_id").alias("_d"), F.col("r").alias("rn"), F.col("c").alias("cn"), F.col(value).alias("zn"))
    return sent.join(there, (F.col("dem_id") == F.col("_d")) & (F.col("_r") == F.col("rn")) & (F.col("_c") == F.col("cn"))).drop("_d", "_r", "_c")


def spacing(grids: DataFrame) -> DataFrame:
    """(dem_id, r, dx, dy) of grids (dem_id, y0, cell_x, cell_y, nrows, degrees): metres between columns, by row, and between
    rows. y0 is the upper edge. On a grid in degrees a row has its own width, and the middle row gives the height."""
    g = grids.withColumn("r", F.explode(F.sequence(F.lit(0), F.col("nrows") - 1)))
    _, east = metres_per_degree(F.col("y0") - (F.col("r") + 0.5) * F.col("cell_y"))
    north, _ = metres_per_degree(F.col("y0") - (F.floor(F.col("nrows") / 2) + 0.5) * F.col("cell_y"))
    one = F.lit(1.0)
    return g.select("dem_id", "r", (F.col("cell_x") * F.when(F.col("degrees"), east).otherwise(one)).alias("dx"), (F.col("cell_y") * F.when(F.col("degrees"), north).otherwise(one)).alias("dy"))


def _metres() -> Column:
    """From a cell to its neighbour k, by the spacing of the cell's row."""
    step = lambda which: F.element_at(F.array(*[F.lit(d[which]) for d in DIRECTIONS]), F.col("k") + 1)
    across, along = F.col("dx") * step(2), F.col("dy") * step(1)
    return F.sqrt(across * across + along * along)


def flow_direction(cells: DataFrame, space: DataFrame, steps: str | None = None) -> DataFrame:
    """(dem_id, r, c, code): steepest descent in metres to a valid neighbour, the first code of a tie, 0 where none is lower.

    steps: a column of integer steps that settles level ground (flat_gradient): heights are compared first, then steps, so
    that none is nudged.
    """
    cells = cells.select(*CELL, "z", F.col(steps).alias("s") if steps else F.lit(0).alias("s"))
    there = cells.select(F.col("dem_id").alias("_d"), F.col("r").alias("_r"), F.col("c").alias("_c"), F.col("s").alias("sn"))
    near = neighbours(cells)
    if steps:
        near = near.join(there, (F.col("dem_id") == F.col("_d")) & (F.col("rn") == F.col("_r")) & (F.col("cn") == F.col("_c")))
    near = near.join(space, ["dem_id", "r"]).withColumn("_m", _metres())
    near = near.withColumns({"slope": (F.col("z") - F.col("zn")) / F.col("_m"), "ease": (F.col("s") - F.col("sn")) / F.col("_m") if steps else F.lit(0.0)})
    code = F.element_at(F.array(*[F.lit(c) for c, _, _ in DIRECTIONS]), F.col("k") + 1)
    best = near.where("slope > 0 or (slope = 0 and ease > 0)").groupBy(*CELL).agg(F.max_by(code, F.struct("slope", "ease", -F.col("k"))).alias("code"))
    return cells.where("z is not null").select(*CELL).join(best, CELL, "left").select(*CELL, F.coalesce("code", F.lit(0)).cast("int").alias("code"))


def pointers(codes: DataFrame) -> DataFrame:
    """(dem_id, r, c, rd, cd): the cell that each cell drains to; null at pits and where that is off the grid or no data."""
    def step(which: int) -> Column:
        return F.element_at(F.create_map(*[F.lit(x) for d in DIRECTIONS for x in (d[0], d[which])]), F.col("code"))

    to = codes.select(*CELL, (F.col("r") + step(1)).alias("_r"), (F.col("c") + step(2)).alias("_c"))
    there = codes.select(F.col("dem_id").alias("_d"), F.col("r").alias("rd"), F.col("c").alias("cd"))
    met = to.join(there, (F.col("dem_id") == F.col("_d")) & (F.col("_r") == F.col("rd")) & (F.col("_c") == F.col("cd")), "left")
    return met.select(*CELL, "rd", "cd")


def step_lengths(down: DataFrame, space: DataFrame) -> DataFrame:
    """(dem_id, r, c, metres): from each cell to the one it drains to, 0 where its flow stops."""
    across, along = (F.col("cd") - F.col("c")) * F.col("dx"), (F.col("rd") - F.col("r")) * F.col("dy")
    return down.join(space, ["dem_id", "r"]).select(*CELL, F.coalesce(F.sqrt(across * across + along * along), F.lit(0.0)).alias("metres"))


def valid(cells: DataFrame, ocean: DataFrame, floor: float = -1000.0) -> DataFrame:
    """Cells with a finite height of at least the floor that aren't ocean; lower ones are no data."""
    z = F.col("z").cast("double")
    return cells.where(z.isNotNull() & ~F.isnan(z) & (F.abs(z) < float("inf")) & (z >= floor)).join(ocean.select(*CELL), CELL, "left_anti")


def level_cells(cells: DataFrame, least: int = 2) -> DataFrame:
    """Cells with at least two neighbours of the same height."""
    return neighbours(cells).groupBy(*CELL).agg(F.count_if(F.col("zn") == F.col("z")).alias("same")).where(F.col("same") >= least).select(*CELL)


def incised(cells: DataFrame, depth: float, reach: int = 2, raised: float = 0.05) -> DataFrame:
    """Cells at least `depth` below both cells `reach` away on some axis, which off the grid or its data are infinitely high; not
    those that a fill (column filled, if there is one) raised by more than `raised`. One join, four axes at once."""
    axes = [(0, 1), (1, 0), (1, 1), (1, -1)]
    ends = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(s * dr * reach).alias("dr"), F.lit(s * dc * reach).alias("dc")) for a, (dr, dc) in enumerate(axes) for s in (1, -1)])
    there = cells.where("z is not null").select(F.col("dem_id").alias("_d"), F.col("r").alias("_r"), F.col("c").alias("_c"), F.col("z").cast("double").alias("zn"))
    own = cells.where("z is not null")
    if "filled" in cells.columns:
        own = own.where(F.col("filled") - F.col("z") <= raised)
    sent = own.select(*CELL, "z", F.explode(ends).alias("o"))
    met = sent.join(there, (F.col("dem_id") == F.col("_d")) & (F.col("r") + F.col("o.dr") == F.col("_r")) & (F.col("c") + F.col("o.dc") == F.col("_c")), "left")
    low = lambda a: F.min(F.when(F.col("o.a") == a, F.coalesce("zn", F.lit(float("inf")))))
    return met.groupBy(*CELL, "z").agg(F.greatest(*[low(a) for a in range(4)]).alias("rim")).where(F.col("z") <= F.col("rim") - depth).select(*CELL)


def dilate(cells: DataFrame, grid: DataFrame, steps: int = 1) -> DataFrame:
    """Cells of the grid that lie within a step of a set of cells."""
    grown = cells.select(*CELL)
    for _ in range(steps):
        near = grown.select(*CELL, F.explode(offsets(1, True)).alias("o")).select("dem_id", (F.col("r") + F.col("o.dr")).alias("r"), (F.col("c") + F.col("o.dc")).alias("c")).distinct()
        grown = near.join(grid.select(*CELL), CELL, "left_semi")
    return grown


def crop(cells: DataFrame, r0: int, c0: int, nrows: int, ncols: int) -> DataFrame:
    """A window of the grid, its indices from 0."""
    return cells.where(F.col("r").between(r0, r0 + nrows - 1) & F.col("c").between(c0, c0 + ncols - 1)).withColumns({"r": F.col("r") - r0, "c": F.col("c") - c0})


def mosaic(cells: DataFrame, source: str, value: str) -> DataFrame:
    """Of overlapping sources the last by name wins a cell."""
    return cells.groupBy(*CELL).agg(F.max_by(value, source).alias(value))


def mode_resample(fine: DataFrame, factor: int, value: str, fallback: int) -> DataFrame:
    """The most frequent class of the fine cells in each coarse one, the least of a tie; null classes count as the fallback."""
    counts = fine.groupBy("dem_id", F.floor(F.col("r") / factor).cast("int").alias("r"), F.floor(F.col("c") / factor).cast("int").alias("c"), F.coalesce(value, F.lit(fallback)).alias(value)).count()
    return counts.groupBy(*CELL).agg(F.max_by(value, F.struct("count", -F.col(value))).alias(value))


def zonal(cells: DataFrame, zones: DataFrame) -> DataFrame:
    """Least and greatest height of each reach's cells; the greatest starts at 0."""
    return cells.join(zones, CELL).groupBy("dem_id", "reach").agg(F.min("z").alias("low"), F.greatest(F.max("z"), F.lit(0)).alias("high"), F.count("*").alias("cells"))


def reach_slope(cells: DataFrame, zones: DataFrame) -> DataFrame:
    """The 90th less the 10th percentile of a reach's heights, not below 0, over its number of cells."""
    q = F.percentile("z", F.array(F.lit(0.1), F.lit(0.9)))
    g = cells.join(zones, CELL).groupBy("dem_id", "reach").agg(q.alias("q"), F.count("*").alias("n"))
    return g.select("dem_id", "reach", F.round(F.greatest(F.col("q")[1] - F.col("q")[0], F.lit(0.0)) / F.col("n"), 6).alias("slope"))


# Steps that heights may be rounded to, the share of multiples that shows it, and the share of whole half metres.
STEPS, STEP_SHARE, HALF_SHARE = (1.0, 0.1, 0.01, 0.001), 0.9, 0.3


def height_step(cells: DataFrame) -> DataFrame:
    """(dem_id, step): the coarsest step of which nine in ten heights are multiples in single precision, else 0. Every cell counts."""
    z = F.col("z").cast("float")
    names = [f"s{k}" for k in range(len(STEPS))]  # no dots: names are no paths
    met = cells.where("z is not null").groupBy("dem_id").agg(*[F.avg(((F.rint(z.cast("double") / s) * s).cast("float") == z).cast("double")).alias(n) for n, s in zip(names, STEPS)])
    return met.select("dem_id", F.coalesce(*[F.when(F.col(n) >= STEP_SHARE, F.lit(s)) for n, s in zip(names, STEPS)], F.lit(0.0)).alias("step"))


def half_metres(water: DataFrame) -> DataFrame:
    """(dem_id, share, flattened): how much of the water stands at whole half metres, and whether that shows flattened rivers."""
    z = F.col("z").cast("double")
    met = water.groupBy("dem_id").agg(F.avg((z * 2 == F.rint(z * 2)).cast("double")).alias("s"))
    return met.select("dem_id", F.round("s", 6).alias("share"), (F.col("s") >= HALF_SHARE).alias("flattened"))


def beside_share(cells: DataFrame, zones: DataFrame, water: DataFrame) -> DataFrame:
    """For each reach, the share of its cells with water within a step; narrow if more than half are dry."""
    wet = dilate(water, cells).withColumn("_w", F.lit(1))
    g = zones.join(wet, CELL, "left").groupBy("dem_id", "reach").agg(F.avg(F.coalesce("_w", F.lit(0))).alias("s"))
    return g.select("dem_id", "reach", F.round("s", 6).alias("beside"), (F.col("s") < 0.5).alias("narrow"))


def channel_rule(d: str, rise: str, width: str, flat: str) -> Column:
    """Flat water near a stream and not far above it, or low ground within one and a half widths; all within 1500 m."""
    return (F.col(d) <= 1500) & ((F.col(flat) & (F.col(d) <= F.greatest(2 * F.col(width), F.lit(60))) & (F.col(rise) <= 2)) | ((F.col(rise) <= 1) & (F.col(width) > 0) & (F.col(d) <= 1.5 * F.col(width))))


def nearest(cells: DataFrame, features: DataFrame, radius: int, k: int = 1) -> DataFrame:
    """The k nearest feature cells within a radius (cells), by squared distance, row, column; buckets of one radius meet."""
    b = lambda x: F.floor(F.col(x) / radius).cast("int")
    sent = cells.select(*CELL, F.explode(F.array(*[F.struct((b("r") + i).alias("br"), (b("c") + j).alias("bc")) for i in (-1, 0, 1) for j in (-1, 0, 1)])).alias("b")).select(*CELL, "b.br", "b.bc")
    there = features.select("dem_id", F.col("r").alias("fr"), F.col("c").alias("fc"), b("r").alias("br"), b("c").alias("bc"))
    d2 = (F.col("r") - F.col("fr")) * (F.col("r") - F.col("fr")) + (F.col("c") - F.col("fc")) * (F.col("c") - F.col("fc"))
    met = sent.join(there, ["dem_id", "br", "bc"]).withColumn("d2", d2).where(F.col("d2") <= radius * radius)
    rank = F.row_number().over(Window.partitionBy(*CELL).orderBy("d2", "fr", "fc"))
    return met.withColumn("rank", rank).where(F.col("rank") <= k).select(*CELL, "rank", "fr", "fc", "d2")


def inverse_distance(cells: DataFrame, sources: DataFrame, radius: int) -> DataFrame:
    """Water level at each cell as the inverse-squared-distance mean of the sources within a radius; a source keeps its own."""
    b = lambda x: F.floor(F.col(x) / radius).cast("int")
    sent = cells.select(*CELL, "z", F.explode(F.array(*[F.struct((b("r") + i).alias("br"), (b("c") + j).alias("bc")) for i in (-1, 0, 1) for j in (-1, 0, 1)])).alias("b")).select(*CELL, "z", "b.br", "b.bc")
    there = sources.select("dem_id", F.col("r").alias("fr"), F.col("c").alias("fc"), "wse", b("r").alias("br"), b("c").alias("bc"))
    d2 = ((F.col("r") - F.col("fr")) * (F.col("r") - F.col("fr")) + (F.col("c") - F.col("fc")) * (F.col("c") - F.col("fc"))).cast("double")
    met = sent.join(there, ["dem_id", "br", "bc"]).withColumn("d2", d2).where(F.col("d2") <= radius * radius)
    own = F.max(F.when(F.col("d2") == 0, F.col("wse")))
    w = F.when(F.col("d2") > 0, 1 / F.col("d2"))
    g = met.groupBy(*CELL, "z").agg(F.coalesce(own, F.sum(F.col("wse") * w) / F.sum(w)).alias("level"))
    return g.select(*CELL, F.round("level", 11).alias("level"), (F.round("level", 11) > F.col("z")).alias("flooded"))


def in_polygon(cells: DataFrame, edges: DataFrame) -> DataFrame:
    """Cells whose centre lies in a polygon given by its edges (x1, y1, x2, y2): an odd number of edges crossed to the right."""
    y, x = F.col("r") + 0.5, F.col("c") + 0.5
    e = edges.where("y1 <> y2").select(F.col("dem_id").alias("_d"), "x1", "y1", "x2", "y2", F.explode(F.sequence(F.ceil(F.least("y1", "y2") - 0.5).cast("int"), F.floor(F.greatest("y1", "y2") - 0.5).cast("int"))).alias("_r"))
    hit = (F.least("y1", "y2") <= y) & (y < F.greatest("y1", "y2")) & (F.col("x1") + (y - F.col("y1")) * (F.col("x2") - F.col("x1")) / (F.col("y2") - F.col("y1")) > x)
    return cells.select(*CELL).join(e, (F.col("dem_id") == F.col("_d")) & (F.col("r") == F.col("_r")) & hit).groupBy(*CELL).agg(F.count("*").alias("n")).where("n % 2 = 1").select(*CELL)


def stream_winner(claims: DataFrame) -> DataFrame:
    """Of the reaches that claim a cell, the one of the highest order, area, and then the last."""
    return claims.groupBy(*CELL).agg(F.max_by("reach", F.struct("ord", "area", "reach")).alias("reach"))


def area_near(points: DataFrame, areas: DataFrame, reach: int = 2) -> DataFrame:
    """(point, area): the largest drainage area (dem_id, r, c, total) within so many cells of a point's cell, its own included; 0 if
    there is none."""
    sent = points.select("point", *CELL, F.explode(offsets(reach, True)).alias("o")).select("point", "dem_id", (F.col("r") + F.col("o.dr")).alias("r"), (F.col("c") + F.col("o.dc")).alias("c"))
    most = sent.join(areas, CELL).groupBy("point").agg(F.max("total").alias("area"))
    return points.select("point").join(most, "point", "left").select("point", F.coalesce("area", F.lit(0)).alias("area"))


def channels(areas: DataFrame, least: float) -> DataFrame:
    """Cells that drain at least an area, numbered from 0 by row and column in each grid."""
    return areas.where(F.col("total") >= least).withColumn("node", F.row_number().over(Window.partitionBy("dem_id").orderBy("r", "c")) - 1)


def nth_valid(cells: DataFrame) -> DataFrame:
    """Valid cells with their number, from 1, in row order within a grid."""
    return cells.where("z is not null").withColumn("nth", F.row_number().over(Window.partitionBy("dem_id").orderBy("r", "c")))


def fill_gaps(path: DataFrame) -> DataFrame:
    """(path, pos, k, r, c): the cells of paths in order, gaps between consecutive ones filled so that each touches the next; k
    counts from 0 at each given cell. Halves round to even."""
    w = Window.partitionBy("path").orderBy("pos")
    on = path.withColumns({"_r": F.lead("r").over(w), "_c": F.lead("c").over(w)})
    steps = F.greatest(F.abs(F.col("_r") - F.col("r")), F.abs(F.col("_c") - F.col("c")), F.lit(1))
    at = lambda a, b: F.rint(F.col(a) + (F.col(b) - F.col(a)) * F.col("k") / F.col("n")).cast("int")
    on = on.withColumn("n", F.coalesce(steps, F.lit(1))).withColumn("k", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
    return on.select("path", "pos", F.col("k").cast("int").alias("k"), F.when(F.col("k") == 0, F.col("r")).otherwise(at("r", "_r")).cast("int").alias("r"), F.when(F.col("k") == 0, F.col("c")).otherwise(at("c", "_c")).cast("int").alias("c"))
