"""Reach networks as edge tables (reach, ds, ord, area); -1 is an outlet."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.fixpoint import accumulate, components, depth, downstream_closure, fixpoint, on_cycles, path_sums, settle


def nodes(net: DataFrame) -> DataFrame:
    return net.select(F.col("reach").alias("id"), F.when(F.col("ds") > 0, F.col("ds")).alias("down"))


def mend_outlets(net: DataFrame) -> DataFrame:
    """A downstream id that is no reach becomes -1."""
    known = net.select(F.col("reach").alias("_k"))
    return net.join(known, F.col("ds") == F.col("_k"), "left").withColumn("ds", F.coalesce("_k", F.lit(-1))).drop("_k")


def drop_reaches(net: DataFrame, gone: DataFrame) -> DataFrame:
    """Without some reaches; what fed them ends."""
    return mend_outlets(net.join(gone, "reach", "left_anti"))


def orders_between(net: DataFrame, low: int | None, high: int | None) -> DataFrame:
    """Stream orders within bounds, inclusive; None bounds nothing; an order that is no number drops out. Without a column of
    orders nothing is filtered, with a warning."""
    if "ord" not in net.columns:
        warnings.warn("the network has no stream orders: none are filtered", stacklevel=2)
        return net
    order = F.col("ord").cast("string").try_cast("double")
    keep = order.isNotNull()
    keep = keep & (order >= low) if low is not None else keep
    return net.where(keep & (order <= high) if high is not None else keep)


def not_in_lakes(net: DataFrame, lakes: DataFrame) -> DataFrame:
    """Without the reaches that a JSON map of lakes lists as inside; nulls in the lists count for nothing."""
    inside = lakes.select(F.explode(F.from_json("json", "map<string,struct<inside:array<bigint>>>")).alias("lake", "v")).select(F.explode("v.inside").alias("reach")).where("reach is not null").distinct()
    return net.join(inside, "reach", "left_anti")


def area_km2(km2: str, m2: str) -> Column:
    return F.coalesce(F.col(km2), F.col(m2) / 1e6)


def usable(net: DataFrame, place: str) -> DataFrame:
    """Numeric positive ids, the first row of each."""
    n = net.where(F.col("reach") > 0).withColumn("_n", F.row_number().over(Window.partitionBy("reach").orderBy(place)))
    return n.where("_n = 1").drop("_n")


def largest_feeders(net: DataFrame) -> DataFrame:
    """Of the reaches that feed one, those of the highest order and then area; all of a tie."""
    rank = F.rank().over(Window.partitionBy("ds").orderBy(F.col("ord").desc(), F.col("area").desc()))
    return net.where("ds > 0").withColumn("_r", rank).where("_r = 1").select("ds", "reach")


def main_feeder(net: DataFrame, share: float = 0.5) -> DataFrame:
    """The feeder with at least a share of its reach's inflow, best by order, area, then id."""
    total = F.sum("area").over(Window.partitionBy("ds"))
    rank = F.row_number().over(Window.partitionBy("ds").orderBy(F.col("ord").desc(), F.col("area").desc(), "reach"))
    return net.where("ds > 0").withColumn("_t", total).where(F.col("area") >= share * F.col("_t")).withColumn("_n", rank).where("_n = 1").select("ds", "reach")


def inflow(net: DataFrame) -> DataFrame:
    """Summed area of what feeds each reach directly."""
    return net.where("ds > 0").groupBy(F.col("ds").alias("reach")).agg(F.sum("area").alias("inflow"))


def upstream_area(net: DataFrame) -> DataFrame:
    n = net.select(F.col("reach").alias("id"), F.when(F.col("ds") > 0, F.col("ds")).alias("down"), F.col("area").alias("w"))
    return accumulate(n).select(F.col("id").alias("reach"), F.col("total").alias("upstream_area"))


def depth_above_outlet(net: DataFrame) -> DataFrame:
    return depth(nodes(net)).select(F.col("id").alias("reach"), "depth", F.col("root").alias("outlet"))


def boundary_reaches(net: DataFrame, crossing: DataFrame) -> DataFrame:
    """Reaches that cross a boundary, all below them, and the direct feeders of those."""
    below = settle(downstream_closure(crossing.select(F.col("reach").alias("id")), nodes(net)).select(F.col("id").alias("reach")))
    feeders = net.join(below.select(F.col("reach").alias("_b")), F.col("ds") == F.col("_b"), "left_semi").select("reach")
    return below.unionAll(feeders).distinct()


def stuck_in_lakes(net: DataFrame, touching: DataFrame) -> DataFrame:
    """Reaches that touch a lake and have no dry reach above, or none below."""
    t = touching.select("reach").distinct().withColumn("_wet", F.lit(1))
    n = net.join(t, "reach", "left").select(F.col("reach").alias("id"), F.when(F.col("ds") > 0, F.col("ds")).alias("down"), F.when(F.col("_wet").isNull(), 1).otherwise(0).alias("w"))
    n = settle(n)
    above = accumulate(n)
    below = downstream_closure_counts(n)
    met = n.join(above, "id").join(below, "id")
    return met.where("w = 0 and (total = 0 or dry_below = 0)").select(F.col("id").alias("reach"))


def downstream_closure_counts(n: DataFrame) -> DataFrame:
    """(id, dry_below): dry reaches on the way down, by doubling."""
    ahead = n.select(F.col("id").alias("_a"), F.col("w").alias("w2"))
    state = settle(n.join(ahead, F.col("down") == F.col("_a"), "left").select("id", F.col("down").alias("jump"), F.coalesce("w2", F.lit(0)).cast("long").alias("dry_below")))
    for _ in range(state.count().bit_length() + 1):
        if not state.where("jump is not null").limit(1).count():
            break
        far = state.select(F.col("id").alias("_a"), F.col("jump").alias("next"), F.col("dry_below").alias("more"))
        state = settle(state.join(far, F.col("jump") == F.col("_a"), "left").select("id", F.col("next").alias("jump"), (F.col("dry_below") + F.coalesce("more", F.lit(0))).alias("dry_below")))
    return state.select("id", "dry_below")


def in_the_sea(net: DataFrame, starts_in_sea: DataFrame) -> DataFrame:
    """A reach is in the sea if its line starts there, or if all its largest feeders are."""
    feeders = settle(largest_feeders(net))

    def step(s: DataFrame) -> DataFrame:
        wet = s.select(F.col("reach").alias("_w")).withColumn("in_sea", F.lit(True))
        all_wet = feeders.join(wet, F.col("reach") == F.col("_w"), "left").groupBy("ds").agg(F.bool_and(F.coalesce("in_sea", F.lit(False))).alias("ok"))
        return s.unionAll(all_wet.where("ok").select(F.col("ds").alias("reach"))).distinct()

    return fixpoint(starts_in_sea.select("reach").distinct(), step, F.count("*"))


def matched_share(net: DataFrame, matched: DataFrame) -> DataFrame:
    """By order: share of matched reaches, and unmatched reaches directly below a matched one."""
    m = matched.select(F.col("reach").alias("_m")).withColumn("_ok", F.lit(1))
    below = matched.select("reach").join(net.select("reach", "ds"), "reach").select(F.col("ds").alias("_d")).distinct().withColumn("_under", F.lit(1))
    n = net.join(m, F.col("reach") == F.col("_m"), "left").join(below, F.col("reach") == F.col("_d"), "left")
    return n.groupBy("ord").agg(F.round(F.avg(F.coalesce("_ok", F.lit(0))), 6).alias("matched"), F.sum(F.when(F.col("_ok").isNull() & F.col("_under").isNotNull(), 1).otherwise(0)).alias("unmatched_below"))


def outranked(net: DataFrame) -> DataFrame:
    """Rivals for one place (ds): by order, area, then the lower id."""
    return net.select("ds", "reach", F.row_number().over(Window.partitionBy("ds").orderBy(F.col("ord").desc(), F.col("area").desc(), "reach")).alias("rank"))


def tour(net: DataFrame) -> DataFrame:
    """(reach, root, tin, tout, depth): numbers in each tree so that b is a or below it exactly when both have one root and
    b.tin <= a.tin <= b.tout. One row a reach: from the sizes of subtrees, those of earlier feeders, and sums on the way down."""
    n = settle(nodes(net))
    size = accumulate(n.withColumn("w", F.lit(1)))
    before = F.sum("total").over(Window.partitionBy("down").orderBy("id").rowsBetween(Window.unboundedPreceding, -1))
    offset = n.where("down is not null").join(size, "id").select("id", (1 + F.coalesce(before, F.lit(0))).alias("w"))
    sums = path_sums(n.join(offset, "id", "left").select("id", "down", F.coalesce("w", F.lit(0)).cast("long").alias("w")))
    return sums.join(size.withColumnRenamed("total", "size"), "id").select(F.col("id").alias("reach"), "root", F.col("total").alias("tin"), (F.col("total") + F.col("size") - 1).alias("tout"), "depth")


def related(pairs: DataFrame, net: DataFrame) -> DataFrame:
    """pairs (reach, other) of which the other is the reach or below it, or drains into the same reach."""
    t = settle(tour(net).join(net.select("reach", "ds"), "reach"))
    a = t.select("reach", F.col("root").alias("_r"), F.col("tin").alias("_t"), F.col("ds").alias("_s"))
    b = t.select(F.col("reach").alias("other"), "root", "tin", "tout", "ds")
    below = (F.col("_r") == F.col("root")) & (F.col("tin") <= F.col("_t")) & (F.col("_t") <= F.col("tout"))
    return pairs.join(a, "reach").join(b, "other").where(below | (F.col("_s") > 0) & (F.col("_s") == F.col("ds"))).select("reach", "other")


def break_cycles(net: DataFrame) -> DataFrame:
    """The network with one reach of each cycle, and every reach that drains into itself, ending. It is the one that closes the cycle
    for a walk from the least id that leads there."""
    net = net.withColumn("ds", F.when(F.col("ds") == F.col("reach"), -1).otherwise(F.col("ds")))
    n = settle(nodes(net))
    loop = settle(n.join(on_cycles(n), "id"))
    if not loop.limit(1).count():
        return net
    cycle = components(loop.select(F.col("id").alias("a"), F.col("down").alias("b")))
    ends = n.join(loop.select(F.col("id").alias("_l")), F.col("id") == F.col("_l"), "left").select("id", F.when(F.col("_l").isNull(), F.col("down")).alias("down"))
    entry = depth(ends).join(cycle.withColumnRenamed("id", "root"), "root").groupBy("label").agg(F.min_by("root", "id").alias("first"))
    closing = loop.join(entry, F.col("down") == F.col("first")).select(F.col("id").alias("_x"))
    return net.join(closing, F.col("reach") == F.col("_x"), "left").withColumn("ds", F.when(F.col("_x").isNull(), F.col("ds")).otherwise(-1)).drop("_x")


def with_attributes(moved: DataFrame, source: DataFrame, columns: list[str], order: str) -> DataFrame:
    """Moved reaches with attributes of the source's first row for each id, null where it has none."""
    first = source.groupBy("reach").agg(*[F.min_by(c, order).alias(c) for c in columns])
    return moved.join(first, "reach", "left")


def bounded_orders(net: DataFrame, cells: DataFrame, low: int | None, high: int | None) -> tuple[DataFrame, DataFrame]:
    """Reaches within bounds of order, and the raster cells (with a column reach) that are theirs."""
    kept = orders_between(net, low, high)
    return mend_outlets(kept), cells.join(kept.select("reach"), "reach", "left_semi")


def changed_ids(before: DataFrame, after: DataFrame) -> DataFrame:
    """(reach, change): ids that came and that went."""
    went = before.select("reach").distinct().join(after.select("reach"), "reach", "left_anti").withColumn("change", F.lit("went"))
    return went.unionAll(after.select("reach").distinct().join(before.select("reach"), "reach", "left_anti").withColumn("change", F.lit("came")))


def warning_places(flagged: DataFrame, reaches: DataFrame) -> DataFrame:
    """(lat, lon): whole degrees, towards 0, of the reaches (reach, lat, lon) with a return period flagged (reach, ret_per > 0)."""
    hit = flagged.where("ret_per > 0").select("reach").distinct()
    return reaches.join(hit, "reach", "left_semi").select(F.col("lat").cast("int").alias("lat"), F.col("lon").cast("int").alias("lon")).distinct()
