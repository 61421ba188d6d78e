"""Queries of the engine's operators over the driver's tables, each beside its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import scalars as fn
from .operators import exchange, flows, grid, hydro, lines, network, reaches
from .plans import views as v
from .sources import tables

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


D8 = "d8(k, code, dr, dc) AS (VALUES (0, 64, -1, -1), (1, 128, -1, 0), (2, 1, -1, 1), (3, 32, 0, -1), (4, 2, 0, 1), (5, 16, 1, -1), (6, 8, 1, 0), (7, 4, 1, 1))"
#: Flat number of a cell, unique over grids, and back.
ID = "dem_id * 256 + r * 16 + c"
BACK = "CAST(id // 256 AS BIGINT) AS dem_id, CAST(id % 256 // 16 AS INTEGER) AS r, CAST(id % 16 AS INTEGER) AS c"


def _near(t: str) -> str:
    return f"near AS (SELECT a.dem_id, a.r, a.c, a.z, a.dem_id * 256 + a.r * 16 + a.c AS id, k, code, dr, dc, b.r AS rn, b.c AS cn, b.z AS zn, b.dem_id * 256 + b.r * 16 + b.c AS idn FROM {t} a CROSS JOIN d8 JOIN {t} b ON b.dem_id = a.dem_id AND b.r = a.r + dr AND b.c = a.c + dc)"


CODES = f"""{v.GRID}, {v.SPACE}, {D8}, {_near("grid")},
slopes AS (SELECT near.*, (z - zn) / sqrt(dx * dc * (dx * dc) + dy * dr * (dy * dr)) AS slope FROM near JOIN space USING (dem_id, r)),
best AS (SELECT id, code FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY slope DESC, k) AS n FROM slopes WHERE slope > 0) WHERE n = 1),
codes AS (SELECT dem_id, r, c, {ID} AS id, CAST(coalesce(code, 0) AS INTEGER) AS code FROM grid LEFT JOIN best ON best.id = {ID})"""
POINTERS = f"{CODES}, pointers AS (SELECT a.*, b.r AS rd, b.c AS cd, b.id AS down FROM codes a LEFT JOIN d8 ON d8.code = a.code LEFT JOIN codes b ON b.dem_id = a.dem_id AND b.r = a.r + dr AND b.c = a.c + dc)"
AREAS = f"{POINTERS}, walk(id, pt) AS (SELECT id, id FROM pointers UNION ALL SELECT walk.id, down FROM walk JOIN pointers ON pointers.id = walk.pt WHERE down IS NOT NULL), areas AS (SELECT pt AS id, sum(dx * dy / 1000000) AS total FROM walk JOIN pointers ON pointers.id = walk.id JOIN space USING (dem_id, r) GROUP BY 1)"
NEAR_SMALL = f"{v.SMALL}, {D8}, {_near('small')}"


def _patches(cells: str, of: str = "near") -> str:
    """Patches of a set of cells: lab (id, label)."""
    return f"link AS (SELECT n.id AS a, n.idn AS b FROM {of} n JOIN {cells} x ON x.id = n.id JOIN {cells} y ON y.id = n.idn), reach(a, b) AS (SELECT id, id FROM {cells} UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b), lab AS (SELECT a AS id, min(b) AS label FROM reach GROUP BY 1)"


def _spread(cells: str, seeds: str) -> str:
    """Cells of patches with a seed within a step: hit (id)."""
    return f"link AS (SELECT n.id AS a, n.idn AS b FROM near n JOIN {cells} x ON x.id = n.id JOIN {cells} y ON y.id = n.idn), hit(id) AS (SELECT w.id FROM {cells} w JOIN {seeds} s ON w.dem_id = s.dem_id AND abs(w.r - s.r) <= 1 AND abs(w.c - s.c) <= 1 UNION SELECT link.b FROM hit JOIN link ON link.a = hit.id)"


# ---------------------------------------------------------------- flow tables


@query(f"WITH {v.ENSEMBLE}, peak AS (SELECT ensemble, rivid, max(round_even(qout, 2)) AS p FROM ensemble GROUP BY 1, 2) SELECT rivid, CAST(median(p) AS DOUBLE) AS median, CAST(min(p) AS DOUBLE) AS min, CAST(max(p) AS DOUBLE) AS max FROM peak GROUP BY 1")
def a1_ensemble_peak(spark, d):
    return flows.ensemble_peak(v.ensemble(spark, d))


@query(f"WITH {v.ENSEMBLE}, peak AS (SELECT ensemble, rivid, max(qout) AS p FROM ensemble GROUP BY 1, 2) SELECT rivid, median(p) AS median, min(p) AS min, max(p) AS max FROM peak GROUP BY 1")
def a2_member_peak(spark, d):
    return flows.ensemble_peak(v.ensemble(spark, d), None)


@query(f"WITH {v.ENSEMBLE}, last AS (SELECT rivid, qout, row_number() OVER (PARTITION BY rivid ORDER BY time DESC, qout DESC) AS n FROM ensemble) SELECT rivid, CAST(round_even(qout, 2) AS DOUBLE) AS median, CAST(round_even(qout, 2) AS DOUBLE) AS min, CAST(round_even(qout, 2) AS DOUBLE) AS max FROM last WHERE n = 1")
def a4_single_value(spark, d):
    return flows.single_value(v.ensemble(spark, d))


@query("WITH p AS (SELECT unnest([0, 1, 5, 10, 15, 20, 25, 30, 35, 40, 45, 50, 55, 60, 65, 70, 75, 80, 85, 90, 95, 100]) AS p_exceed, unnest([1 - x / 100.0 for x in [0, 1, 5, 10, 15, 20, 25, 30, 35, 40, 45, 50, 55, 60, 65, 70, 75, 80, 85, 90, 95, 100]]) AS q), s AS (SELECT user_id AS river_id, list(value ORDER BY value) AS a FROM events GROUP BY 1), h AS (SELECT river_id, p_exceed, a, (len(a) - 1) * CAST(q AS DOUBLE) AS t FROM s, p) SELECT river_id, CAST(p_exceed AS INTEGER) AS p_exceed, round(a[CAST(floor(t + 1e-9) AS BIGINT) + 1] + (t - floor(t + 1e-9)) * (a[least(CAST(floor(t + 1e-9) AS BIGINT) + 2, len(a))] - a[CAST(floor(t + 1e-9) AS BIGINT) + 1]), 6) AS flow FROM h")
def a5_flow_duration(spark, d):
    return flows.flow_duration(v.ensemble(spark, d).select(F.col("rivid").alias("river_id"), F.col("qout").alias("flow")))


@query(f"WITH {v.RP} SELECT river_id, " + ", ".join(f"CAST(round_even(avg(flow) FILTER (WHERE rp = {p} AND flow <> 0), 3) AS DOUBLE) AS rp{p}" for p in (2, 5, 10, 25, 50, 100)) + " FROM rp WHERE flow <> 0 GROUP BY 1")
def a7_return_periods(spark, d):
    return flows.rounded(flows.pivot_periods(v.return_periods(spark, d)), "river_id")


@query(f"WITH {v.RP} SELECT DISTINCT river_id, " + ", ".join(f"0.0::DOUBLE AS rp{p}" for p in (2, 5, 10, 25, 50, 100)) + " FROM rp")
def a7_no_return_periods(spark, d):
    """Nothing but zeros and nulls: a zero for every wanted river."""
    rp = v.return_periods(spark, d)
    return flows.pivot_periods(rp.withColumn("flow", F.when(F.col("rp") > 5, 0)), wanted=rp)


def _curves(spark, d):
    level = F.element_at(F.array(*map(F.lit, (0, 5, 50, 100))), (F.col("o_orderkey") % 4 + 1).cast("int"))
    return v.table(spark, d, "orders").select(F.col("o_custkey").alias("river_id"), level.alias("p_exceed"), F.floor("o_totalprice").alias("hourly_annual"), F.lit(1.0).alias("other"))


CURVES = "curves AS (SELECT o_custkey AS river_id, [0, 5, 50, 100][o_orderkey % 4 + 1] AS p_exceed, CAST(floor(o_totalprice) AS BIGINT) AS q FROM orders)"


@query(f"WITH {CURVES} SELECT river_id, " + ", ".join(f"round(avg(q) FILTER (WHERE p_exceed = {p}), 4) AS p_exceed_{p}" for p in (0, 5, 50, 100)) + " FROM curves GROUP BY 1")
def a8_duration_pivot(spark, d):
    wide = flows.pivot_duration(_curves(spark, d), levels=(0, 5, 50, 100))
    return wide.select("river_id", *[F.round(f"p_exceed_{p}", 4).alias(f"p_exceed_{p}") for p in (0, 5, 50, 100)])


@query(f"WITH {v.RP}, {CURVES}, w AS (SELECT DISTINCT o_custkey AS river_id FROM orders WHERE o_custkey % 3 > 0), p AS (SELECT river_id, " + ", ".join(f"avg(flow) FILTER (WHERE rp = {p}) AS rp{p}" for p in (2, 5, 10, 25, 50, 100)) + " FROM rp WHERE flow <> 0 AND river_id IN (SELECT river_id FROM w) GROUP BY 1), f AS (SELECT river_id, " + ", ".join(f"avg(q) FILTER (WHERE p_exceed = {p}) AS p_exceed_{p}" for p in (0, 5, 50, 100)) + " FROM curves WHERE river_id IN (SELECT river_id FROM w) GROUP BY 1) SELECT coalesce(f.river_id, p.river_id) AS comid, " + ", ".join(f"CAST(round_even({c}, 3) AS DOUBLE) AS {c}" for c in ("rp2", "rp5", "rp10", "rp25", "rp50", "rp100", "p_exceed_0", "p_exceed_5", "p_exceed_50", "p_exceed_100")) + ", CAST(round_even(1.5::DOUBLE * p_exceed_0 + 50, 3) AS DOUBLE) AS p_exceed_0_premium, CAST(round_even(1.5::DOUBLE * rp100 + 50, 3) AS DOUBLE) AS rp100_premium FROM f FULL JOIN p ON f.river_id = p.river_id WHERE p_exceed_50 >= 10000")
def x6_flow_table(spark, d):
    wanted = v.table(spark, d, "orders").where("o_custkey % 3 > 0").select(F.col("o_custkey").alias("river_id"))
    t = flows.flow_table(v.return_periods(spark, d), _curves(spark, d), wanted, "rp2", "p_exceed_50", 10000, levels=(0, 5, 50, 100))
    return t.withColumnRenamed("COMID", "comid")


@query(f"WITH {v.ENSEMBLE}, peak AS (SELECT ensemble, rivid, max(round_even(qout, 2)) AS p FROM ensemble GROUP BY 1, 2) SELECT rivid, CAST(median(p) AS DOUBLE) AS median, CAST(min(p) AS DOUBLE) AS min, CAST(max(p) AS DOUBLE) AS max FROM peak GROUP BY 1")
def a3_j14_members_apart(spark, d):
    e = v.ensemble(spark, d)
    names = [r[0] for r in e.select("ensemble").distinct().collect()]  # a handful of members
    return flows.peaks_of_members([e.where(F.col("ensemble") == n) for n in names])


@query("WITH x AS (SELECT o_custkey AS comid, o_orderkey % 9 + 1 AS n, o_orderkey % 1000 / 8.0 AS a FROM orders UNION ALL SELECT o_custkey, o_orderkey % 5 + 1, o_orderkey % 100 / 4.0 FROM orders WHERE o_orderkey % 2 = 0) SELECT comid, CAST(sum(n) AS BIGINT) AS n, round(CAST(sum(a * n) AS DOUBLE) / sum(n), 6) AS a FROM x GROUP BY 1")
def a11_w11_coefficients(spark, d):
    o = v.table(spark, d, "orders")
    one = o.select(F.col("o_custkey").alias("comid"), (F.col("o_orderkey") % 9 + 1).alias("n"), (F.col("o_orderkey") % 1000 / 8).alias("a"))
    two = o.where("o_orderkey % 2 = 0").select((F.col("o_orderkey") % 100 / 4).alias("a"), (F.col("o_orderkey") % 5 + 1).alias("n"), F.col("o_custkey").alias("comid"))
    return flows.weighted_means(flows.check_coefficients([one, two], "n", "comid"), "comid", "n", ["a"])


@query("SELECT o_custkey AS reach, median(CASE WHEN o_orderkey % 5 > 0 THEN o_totalprice END) AS median, count(*) FILTER (WHERE o_orderkey % 5 > 0) AS n FROM orders GROUP BY 1")
def a23_median_rise(spark, d):
    rise = F.when(F.col("o_orderkey") % 5 > 0, F.col("o_totalprice")).when(F.col("o_orderkey") % 10 == 0, F.lit(float("nan")))
    return flows.median_rise(v.table(spark, d, "orders").select(F.col("o_custkey").alias("reach"), rise.alias("v")), "reach", "v")


@query("SELECT DISTINCT CAST(k AS BIGINT) AS river_id FROM (SELECT json_extract_string(props, '$.k') AS k FROM events) WHERE try_cast(k AS BIGINT) IS NOT NULL")
def a24_s29_river_ids(spark, d):
    return flows.river_ids(v.table(spark, d, "events").select(F.get_json_object("props", "$.k").alias("k")), "k")


@query("SELECT min(ts) AS first, max(ts) AS last FROM events")
def s29_time_span(spark, d):
    return flows.time_span(v.ensemble(spark, d))


@query(f"WITH {v.RP}, w AS (SELECT river_id, " + ", ".join(f"max(flow) FILTER (WHERE rp = {p}) AS rp{p}" for p in (2, 5, 10, 25, 50)) + " FROM rp GROUP BY 1) SELECT river_id, round_even(greatest(rp2, rp5, rp10, rp25, rp50) / 1000.0, 3)::DOUBLE AS high FROM w")
def a6_row_max(spark, d):
    w = v.return_periods(spark, d).groupBy("river_id").pivot("rp", [2, 5, 10, 25, 50]).agg(F.max("flow") / 1000.0)
    return flows.row_max(w, ["2", "5", "10", "25", "50"], "high").select("river_id", "high")


@query(f"WITH {v.RP} SELECT river_id, max(flow) AS rp100, CAST(1.5 * max(flow) + 50 AS DOUBLE) AS rp100_premium FROM rp GROUP BY 1")
def a9_premium(spark, d):
    return v.return_periods(spark, d).groupBy("river_id").agg(F.max("flow").alias("rp100")).select("river_id", "rp100", flows.premium("rp100"))


def _coefficients(spark, d):
    o = v.table(spark, d, "orders")
    return o.select(F.col("o_custkey").alias("comid"), (F.col("o_orderkey") % 9 + 1).alias("n"), F.when(F.col("o_orderkey") % 4 != 0, F.col("o_orderkey") % 1000 / 8).alias("a"), F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderkey") % 100 / 4).alias("b"))


@query("WITH x AS (SELECT o_custkey AS comid, o_orderkey % 9 + 1 AS n, CASE WHEN o_orderkey % 4 <> 0 THEN o_orderkey % 1000 / 8.0 END AS a, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 100 / 4.0 END AS b FROM orders) SELECT comid, CAST(sum(n) AS BIGINT) AS n, round(CAST(sum(a * n) AS DOUBLE) / sum(n) FILTER (WHERE a IS NOT NULL), 6) AS a, round(CAST(sum(b * n) AS DOUBLE) / sum(n) FILTER (WHERE b IS NOT NULL), 6) AS b FROM x GROUP BY 1")
def a10_weighted_means(spark, d):
    return flows.weighted_means(_coefficients(spark, d), "comid", "n", ["a", "b"])


@query("WITH c AS (SELECT l_partkey AS comid, l_discount AS depth_a, l_tax AS depth_b, l_quantity AS tw_a, l_tax AS tw_b FROM lineitem), q AS (SELECT p_partkey AS comid, p_retailprice AS q FROM part), m AS (SELECT comid, round(avg(tw_a * pow(q * 0.1, tw_b)), 6) AS top_width, round(avg(depth_a * pow(q * 0.1, depth_b)), 6) AS depth FROM c JOIN q USING (comid) WHERE depth_a > 0 AND depth_b > 0 AND tw_a > 0 AND tw_b > 0 GROUP BY 1) SELECT comid, coalesce(top_width, 0) AS top_width, coalesce(depth, 0) AS depth FROM (SELECT DISTINCT comid FROM q) LEFT JOIN m USING (comid)")
def a12_power_law(spark, d):
    return _power_law(spark, d)


@query("WITH c AS (SELECT l_partkey AS comid, l_discount AS depth_a, l_tax AS depth_b, l_quantity AS tw_a, l_tax AS tw_b FROM lineitem), m AS (SELECT comid, round(avg(tw_a * pow(p_retailprice * 0.1, tw_b)), 6) AS w FROM c JOIN part ON p_partkey = comid WHERE depth_a > 0 AND depth_b > 0 AND tw_a > 0 AND tw_b > 0 GROUP BY 1) SELECT coalesce(max(w), 0) AS top_width FROM m")
def a12_widest(spark, d):
    return flows.widest(_power_law(spark, d))


def _power_law(spark, d):
    curves = v.table(spark, d, "lineitem").select(F.col("l_partkey").alias("comid"), F.col("l_discount").alias("depth_a"), F.col("l_tax").alias("depth_b"), F.col("l_quantity").alias("tw_a"), F.col("l_tax").alias("tw_b"))
    return flows.power_law(curves, v.table(spark, d, "part").select(F.col("p_partkey").alias("comid"), F.col("p_retailprice").alias("q")))


@query(f"WITH {v.RP}, hi AS (SELECT river_id, max(flow) AS high FROM rp WHERE rp = 50 GROUP BY 1), lo AS (SELECT river_id, min(flow) AS low FROM rp WHERE rp = 2 GROUP BY 1) SELECT coalesce(hi.river_id, lo.river_id) AS river_id, high, low FROM hi FULL JOIN lo ON hi.river_id = lo.river_id")
def j2_full_outer(spark, d):
    rp = v.return_periods(spark, d)
    hi = rp.where("rp = 50").groupBy("river_id").agg(F.max("flow").alias("high"))
    lo = rp.where("rp = 2").groupBy("river_id").agg(F.min("flow").alias("low"))
    return flows.full_outer(hi, lo, "river_id")


@query(f"WITH {v.RP}, f AS (SELECT river_id, max(flow) AS flow FROM rp GROUP BY 1) SELECT c_custkey AS pos, river_id, flow FROM customer JOIN f ON river_id = 7 * c_custkey % 1500")
def j1_look_up(spark, d):
    f = v.return_periods(spark, d).groupBy("river_id").agg(F.max("flow").alias("flow"))
    return flows.look_up(f, v.table(spark, d, "customer").select(F.col("c_custkey").alias("pos"), (7 * F.col("c_custkey") % 1500).alias("river_id")))


@query(f"WITH {v.RP} SELECT river_id, rp, flow FROM rp WHERE flow >= 15000000")
def p8_baseflow(spark, d):
    return flows.baseflow_between(v.return_periods(spark, d), "flow", 15000000)


@query(f"WITH {v.RP} SELECT river_id, rp, flow FROM rp WHERE river_id IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def p10_wanted_rivers(spark, d):
    wanted = v.table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("river_id"))
    return flows.check_rivers(v.return_periods(spark, d), wanted, drop=True)


@query("SELECT o_orderkey AS reach, CAST(p AS DOUBLE) AS level, CASE p WHEN 2 THEN o_totalprice ELSE o_totalprice * 2 END AS flow FROM orders, (VALUES (2), (5)) t(p)")
def s12_unpivot(spark, d):
    w = v.table(spark, d, "orders").select(F.col("o_orderkey").alias("reach"), F.col("o_totalprice").alias("rp2"), (F.col("o_totalprice") * 2).alias("rp5"), F.lit(1.0).alias("rp5_premium"))
    return flows.unpivot(w, "reach", "rp")


@query(f"WITH {v.ENSEMBLE} SELECT rivid, ensemble, time, qout FROM (SELECT *, row_number() OVER (PARTITION BY rivid ORDER BY time, qout) AS n FROM ensemble) WHERE n = 1")
def w4_first_row(spark, d):
    return flows.first_of(v.ensemble(spark, d), "rivid", ["time", "qout"])


@query("SELECT o_custkey AS river, o_orderkey AS pos, min(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS level, CAST(sum(CAST(round(o_totalprice) AS BIGINT)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS dist, CAST(round(o_totalprice * 100) AS BIGINT) - lag(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS step FROM orders")
def w1_w2_w3_along_paths(spark, d):
    o = v.table(spark, d, "orders").select(F.col("o_custkey").alias("river"), F.col("o_orderkey").alias("pos"), F.round(F.col("o_totalprice") * 100).cast("long").alias("z"), F.round("o_totalprice").cast("long").alias("s"))
    return lines.distance_along(lines.never_rising(o, "river", "pos", "z"), "river", "pos", "s").select("river", "pos", "level", "dist", "step")


VERTICES = "vertices AS (SELECT o_custkey AS line, o_orderkey AS pos, CAST(o_orderkey % 37 AS DOUBLE) AS x, CAST(o_orderkey // 5 % 11 AS DOUBLE) AS y FROM orders)"
SEGMENTS = f"{VERTICES}, seg AS (SELECT *, sqrt((x - x0) * (x - x0) + (y - y0) * (y - y0)) AS length FROM (SELECT *, lag(x) OVER w AS x0, lag(y) OVER w AS y0 FROM vertices WINDOW w AS (PARTITION BY line ORDER BY pos)) WHERE x0 IS NOT NULL), cum AS (SELECT *, sum(length) OVER (PARTITION BY line ORDER BY pos ROWS UNBOUNDED PRECEDING) - length AS before FROM seg)"


def _vertices(spark, d):
    return v.table(spark, d, "orders").select(F.col("o_custkey").alias("line"), F.col("o_orderkey").alias("pos"), (F.col("o_orderkey") % 37).cast("double").alias("x"), F.expr("cast(o_orderkey div 5 % 11 as double)").alias("y"))


@query(f"WITH {SEGMENTS} SELECT line, pos, round(length, 6) AS length, round(before, 6) AS before FROM cum")
def f10_segments(spark, d):
    return lines.segments(_vertices(spark, d)).select("line", "pos", F.round("length", 6).alias("length"), F.round("before", 6).alias("before"))


@query(f"WITH {SEGMENTS}, k AS (SELECT *, unnest(range(0, CAST(floor((before + length) / 7.3) AS BIGINT) + 2)) AS k FROM cum), inner_ AS (SELECT line, k * 7.3::DOUBLE AS along, x0 + (k * 7.3::DOUBLE - before) / length * (x - x0) AS x, y0 + (k * 7.3::DOUBLE - before) / length * (y - y0) AS y FROM k WHERE k > 0 AND length > 0 AND k * 7.3::DOUBLE > before - 1e-9 AND k * 7.3::DOUBLE <= before + length - 1e-9), ends AS (SELECT line, min_by(x0, pos) AS x0, min_by(y0, pos) AS y0, max_by(x, pos) AS x, max_by(y, pos) AS y, sum(length) AS total FROM cum GROUP BY 1), pts AS (SELECT line, 0.0::DOUBLE AS along, x0 AS x, y0 AS y FROM ends UNION ALL SELECT * FROM inner_ UNION ALL SELECT line, total, x, y FROM ends WHERE total > coalesce((SELECT max(along) FROM inner_ i WHERE i.line = ends.line), -1) + 1e-9) SELECT line, round(along, 5) AS along, round(x, 5) + 0.0 AS x, round(y, 5) + 0.0 AS y FROM pts")
def m3_resample(spark, d):
    return lines.resample(_vertices(spark, d), 7.3).select("line", F.round("along", 5).alias("along"), F.round("x", 5).alias("x"), F.round("y", 5).alias("y"))


# ---------------------------------------------------------------- reach networks


@query(f"WITH {v.NETWORK}, n AS (SELECT * FROM network WHERE reach % 5 <> 0) SELECT n.reach, coalesce(k.reach, -1) AS ds, n.area FROM n LEFT JOIN n k ON n.ds = k.reach")
def p5_p15_drop_reaches(spark, d):
    n = v.network(spark, d)
    return network.drop_reaches(n, n.where("reach % 5 = 0").select("reach")).select("reach", "ds", "area")


@query(f"WITH {v.NETWORK} SELECT reach, ord FROM network WHERE ord BETWEEN 3 AND 6")
def p3_orders_between(spark, d):
    return network.orders_between(v.network(spark, d), 3, 6).select("reach", "ord")


@query(f"WITH {v.NETWORK} SELECT n.reach, n.ord, c_nationkey AS nation FROM network n LEFT JOIN customer ON c_custkey = n.reach AND c_custkey % 2 = 0")
def j3_attributes(spark, d):
    source = v.table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("reach"), F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("place"))
    twice = source.unionAll(source.withColumns({"nation": F.col("nation") + 100, "place": F.col("place") + 1}))
    return network.with_attributes(v.network(spark, d).select("reach", "ord"), twice, ["nation"], "place")


@query(f"WITH {v.NETWORK} SELECT reach, CASE WHEN reach % 3 = 0 THEN 'went' ELSE 'came' END AS change FROM network WHERE (reach % 3 = 0) <> (reach % 2 = 0)")
def w12_changed_ids(spark, d):
    n = v.network(spark, d)
    return network.changed_ids(n.where("reach % 3 = 0"), n.where("reach % 2 = 0"))


@query(f"WITH {v.NETWORK} SELECT reach, CAST(reach % 12 AS INTEGER) AS r FROM network WHERE ord BETWEEN 2 AND 4")
def p16_bounded_cells(spark, d):
    n = v.network(spark, d)
    return network.bounded_orders(n, n.select("reach", (F.col("reach") % 12).cast("int").alias("r")), 2, 4)[1].select("reach", "r")


@query(f"WITH {v.NETWORK}, inside AS (SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS reach FROM events) SELECT reach, ds FROM network WHERE reach NOT IN (SELECT reach FROM inside WHERE reach IS NOT NULL)")
def p2_lake_filter(spark, d):
    k = F.get_json_object("props", "$.k")
    lakes = v.table(spark, d, "events").select(F.concat(F.lit('{"lake": {"inside": ['), k, F.lit(", null]}}")).alias("json"))
    return network.not_in_lakes(v.network(spark, d), lakes).select("reach", "ds")


@query("SELECT c_custkey AS reach, CASE WHEN c_acctbal > 0 THEN c_acctbal ELSE c_nationkey / 1e6 END AS km2 FROM customer")
def p6_area_km2(spark, d):
    c = v.table(spark, d, "customer").select(F.col("c_custkey").alias("reach"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("a"), F.col("c_nationkey").alias("b"))
    return c.select("reach", network.area_km2("a", "b").alias("km2"))


@query("SELECT reach, place FROM (SELECT o_custkey % 300 - 5 AS reach, o_orderkey AS place, row_number() OVER (PARTITION BY o_custkey % 300 - 5 ORDER BY o_orderkey) AS n FROM orders) WHERE n = 1 AND reach > 0")
def p12_usable_reaches(spark, d):
    return network.usable(v.table(spark, d, "orders").select((F.col("o_custkey") % 300 - 5).alias("reach"), F.col("o_orderkey").alias("place")), "place")


@query(f"WITH {v.NETWORK} SELECT ds, reach FROM (SELECT *, rank() OVER (PARTITION BY ds ORDER BY ord DESC, area DESC) AS n FROM network WHERE ds > 0) WHERE n = 1")
def a19_largest_feeders(spark, d):
    return network.largest_feeders(v.network(spark, d))


@query(f"WITH {v.NETWORK}, t AS (SELECT *, sum(area) OVER (PARTITION BY ds) AS total FROM network WHERE ds > 0) SELECT ds, reach FROM (SELECT *, row_number() OVER (PARTITION BY ds ORDER BY ord DESC, area DESC, reach) AS n FROM t WHERE area >= 0.5 * total) WHERE n = 1")
def a20_main_feeder(spark, d):
    return network.main_feeder(v.network(spark, d))


@query(f"WITH {v.NETWORK} SELECT ds AS reach, CAST(sum(area) AS BIGINT) AS inflow FROM network WHERE ds > 0 GROUP BY 1")
def a21_inflow(spark, d):
    return network.inflow(v.network(spark, d))


@query(f"WITH {v.NETWORK}, under AS (SELECT DISTINCT ds AS u FROM network WHERE reach % 3 = 0) SELECT ord, round(avg(CASE WHEN reach % 3 = 0 THEN 1 ELSE 0 END), 6) AS matched, CAST(sum(CASE WHEN reach % 3 <> 0 AND u IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS unmatched_below FROM network LEFT JOIN under ON reach = u GROUP BY 1")
def a22_matched_share(spark, d):
    n = v.network(spark, d)
    return network.matched_share(n, n.where("reach % 3 = 0"))


@query(f"WITH {v.NETWORK} SELECT ds, reach, CAST(row_number() OVER (PARTITION BY ds ORDER BY ord DESC, area DESC, reach) AS INTEGER) AS rank FROM network")
def w5_outranked(spark, d):
    return network.outranked(v.network(spark, d))


@query(f"WITH RECURSIVE {v.NETWORK}, down(reach, pt) AS (SELECT reach, reach FROM network UNION ALL SELECT down.reach, ds FROM down JOIN network ON network.reach = down.pt WHERE ds > 0) SELECT pt AS reach, CAST(sum(area) AS BIGINT) AS upstream_area FROM down JOIN network USING (reach) GROUP BY 1")
def g5_upstream_area(spark, d):
    return network.upstream_area(v.network(spark, d))


@query(f"WITH RECURSIVE {v.NETWORK}, down(reach, pt, n) AS (SELECT reach, reach, 0 FROM network UNION ALL SELECT down.reach, ds, n + 1 FROM down JOIN network ON network.reach = down.pt WHERE ds > 0) SELECT reach, CAST(max(n) AS INTEGER) AS depth, max_by(pt, n) AS outlet FROM down GROUP BY 1")
def g12_w9_depth(spark, d):
    return network.depth_above_outlet(v.network(spark, d))


@query(f"WITH RECURSIVE {v.NETWORK}, below(reach) AS (SELECT reach FROM network WHERE reach % 97 = 0 UNION SELECT ds FROM below JOIN network USING (reach) WHERE ds > 0) SELECT reach FROM below UNION SELECT reach FROM network WHERE ds IN (SELECT reach FROM below)")
def g11_boundary_reaches(spark, d):
    n = v.network(spark, d)
    return network.boundary_reaches(n, n.where("reach % 97 = 0"))


@query(f"WITH RECURSIVE {v.NETWORK}, down(reach, pt) AS (SELECT reach, ds FROM network WHERE ds > 0 UNION ALL SELECT down.reach, ds FROM down JOIN network ON network.reach = down.pt WHERE ds > 0), wet AS (SELECT reach FROM network WHERE segment IN ('BUILDING', 'MACHINERY')) SELECT reach FROM wet WHERE reach NOT IN (SELECT reach FROM down WHERE pt NOT IN (SELECT reach FROM wet)) OR reach NOT IN (SELECT pt FROM down WHERE reach NOT IN (SELECT reach FROM wet))")
def g9_stuck_in_lakes(spark, d):
    n = v.network(spark, d)
    return network.stuck_in_lakes(n, n.where("segment in ('BUILDING', 'MACHINERY')"))


@query()
def g10_in_the_sea(spark, d):
    n = v.network(spark, d)
    return network.in_the_sea(n, n.where("reach % 4 < 3 and reach > 500"))


TOUR = f"{v.NETWORK}, down(reach, pt) AS (SELECT reach, reach FROM network UNION ALL SELECT down.reach, ds FROM down JOIN network ON network.reach = down.pt WHERE ds > 0), size AS (SELECT pt AS reach, count(*) AS m FROM down GROUP BY 1), off AS (SELECT reach, CASE WHEN ds > 0 THEN 1 + coalesce(sum(m) OVER (PARTITION BY ds ORDER BY reach ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) ELSE 0 END AS o FROM network JOIN size USING (reach)), tin AS (SELECT down.reach, CAST(sum(o) AS BIGINT) AS tin, CAST(count(*) - 1 AS INTEGER) AS depth, min(pt) AS root FROM down JOIN off ON off.reach = pt GROUP BY 1)"


@query(f"WITH RECURSIVE {TOUR} SELECT reach, root, tin, CAST(tin + m - 1 AS BIGINT) AS tout, depth FROM tin JOIN size USING (reach)")
def g3_tour(spark, d):
    return network.tour(v.network(spark, d))


PAIRS = "pairs AS (SELECT DISTINCT o_custkey + 1 AS reach, o_orderkey % (SELECT count(*) FROM customer) // 4 + 1 AS other FROM orders)"


@query(f"WITH RECURSIVE {TOUR}, {PAIRS} SELECT reach, other FROM pairs WHERE reach IN (SELECT reach FROM network) AND other IN (SELECT reach FROM network) AND (EXISTS (SELECT 1 FROM down WHERE down.reach = pairs.reach AND pt = other) OR EXISTS (SELECT 1 FROM network a JOIN network b USING (ds) WHERE ds > 0 AND a.reach = pairs.reach AND b.reach = other))")
def g20_related(spark, d):
    many = v.table(spark, d, "customer").agg(F.count("*").alias("m"))
    pairs = v.table(spark, d, "orders").join(F.broadcast(many)).select((F.col("o_custkey") + 1).alias("reach"), F.expr("o_orderkey % m div 4 + 1").alias("other")).distinct()
    return network.related(pairs, v.network(spark, d))


@query("WITH n AS (SELECT c_custkey AS reach, CASE c_custkey % 4 WHEN 3 THEN c_custkey - 3 WHEN 2 THEN c_custkey + 1 WHEN 1 THEN c_custkey ELSE c_custkey + 2 END AS ds FROM customer) SELECT reach, CASE WHEN reach % 4 IN (1, 3) AND (reach % 4 = 1 OR reach - 3 IN (SELECT reach FROM n)) THEN -1 ELSE ds END AS ds FROM n WHERE reach > 3 AND reach // 4 < (SELECT max(reach) FROM n) // 4")
def g7_break_cycles(spark, d):
    n = v.table(spark, d, "customer").select(F.col("c_custkey").alias("reach"), F.expr("case c_custkey % 4 when 3 then c_custkey - 3 when 2 then c_custkey + 1 when 1 then c_custkey else c_custkey + 2 end").alias("ds"))
    whole = n.agg(F.max("reach").alias("m"))  # rings of three and a reach that drains into itself, the last group left out as it may be cut off
    n = n.join(F.broadcast(whole)).where("reach > 3 and reach div 4 < m div 4").drop("m")
    return network.break_cycles(n)


# ---------------------------------------------------------------- grids


def _space(spark, d):
    return grid.spacing(v.grids(spark, d))


def _down(spark, d):
    return grid.pointers(grid.flow_direction(v.grid(spark, d), _space(spark, d)))


def _areas(spark, d):
    down = _down(spark, d).join(_space(spark, d).withColumn("km2", F.col("dx") * F.col("dy") / 1e6), ["dem_id", "r"])
    return hydro.flow_accumulation(down, "km2")


@query(f"WITH {v.SPACE} SELECT dem_id, r, round(dx, 6) AS dx, round(dy, 6) AS dy FROM space")
def g19_spacing(spark, d):
    return _space(spark, d).select("dem_id", "r", F.round("dx", 6).alias("dx"), F.round("dy", 6).alias("dy"))


@query(f"WITH {CODES} SELECT dem_id, r, c, code FROM codes")
def r25_w6_flow_direction(spark, d):
    return grid.flow_direction(v.grid(spark, d), _space(spark, d))


@query(f"WITH {POINTERS} SELECT dem_id, r, c, rd, cd FROM pointers")
def g1_pointers(spark, d):
    return _down(spark, d)


@query(f"WITH {POINTERS} SELECT dem_id, r, c, round(coalesce(sqrt((cd - c) * dx * ((cd - c) * dx) + (rd - r) * dy * ((rd - r) * dy)), 0), 6) AS metres FROM pointers JOIN space USING (dem_id, r)")
def g4_step_lengths(spark, d):
    return grid.step_lengths(_down(spark, d), _space(spark, d)).withColumn("metres", F.round("metres", 6))


@query(f"WITH RECURSIVE {AREAS} SELECT {BACK}, round(total, 8) AS total FROM areas")
def g2_accumulation(spark, d):
    return _areas(spark, d).withColumn("total", F.round("total", 8))


@query(f"WITH RECURSIVE {AREAS} SELECT {BACK}, CAST(row_number() OVER (PARTITION BY id // 256 ORDER BY id) - 1 AS INTEGER) AS node FROM areas WHERE total >= 0.01")
def g6_channel_network(spark, d):
    return grid.channels(_areas(spark, d), 0.01).select("dem_id", "r", "c", "node")


@query(f"WITH RECURSIVE {AREAS}, p AS (SELECT c_custkey AS point, c_custkey % (SELECT count(*) FROM supplier) + 1 AS dem_id, CAST(c_custkey % 19 - 1 AS INTEGER) AS r, CAST(c_custkey % 23 - 3 AS INTEGER) AS c FROM customer) SELECT point, round(coalesce(max(total), 0), 8) AS area FROM p LEFT JOIN (SELECT {BACK}, total FROM areas) a ON a.dem_id = p.dem_id AND abs(a.r - p.r) <= 2 AND abs(a.c - p.c) <= 2 GROUP BY 1")
def g21_largest_near(spark, d):
    many = v.table(spark, d, "supplier").agg(F.count("*").alias("m"))
    p = v.table(spark, d, "customer").join(F.broadcast(many)).select(F.col("c_custkey").alias("point"), (F.col("c_custkey") % F.col("m") + 1).alias("dem_id"), (F.col("c_custkey") % 19 - 1).cast("int").alias("r"), (F.col("c_custkey") % 23 - 3).cast("int").alias("c"))
    return grid.area_near(p, _areas(spark, d)).withColumn("area", F.round("area", 8))


@query(f"WITH {NEAR_SMALL} SELECT dem_id, r, c FROM near GROUP BY 1, 2, 3 HAVING count(*) FILTER (WHERE zn = z) >= 2")
def r9_level_cells(spark, d):
    return grid.level_cells(v.small_grid(spark, d))


LEVEL = f"{NEAR_SMALL}, lev AS (SELECT id FROM near GROUP BY id HAVING count(*) FILTER (WHERE zn = z) >= 2), {_patches('lev')}"


@query(f"WITH RECURSIVE {LEVEL} SELECT {BACK}, n AS cells FROM (SELECT label AS id, count(*) AS n FROM lab GROUP BY 1)")
def r30_a17_patch_sizes(spark, d):
    return hydro.patch_sizes(grid.level_cells(v.small_grid(spark, d)))


@query(f"WITH RECURSIVE {LEVEL} SELECT {BACK} FROM lab WHERE label IN (SELECT label FROM lab GROUP BY 1 HAVING count(*) > 6)")
def r10_flat_cells(spark, d):
    return hydro.flat_cells(v.small_grid(spark, d))


@query(f"WITH RECURSIVE {NEAR_SMALL}, wet AS (SELECT *, {ID} AS id FROM small WHERE z <= 4), seed AS (SELECT * FROM small WHERE r = c AND r % 5 = 0), {_spread('wet', 'seed')} SELECT {BACK} FROM hit")
def r11_touching_streams(spark, d):
    g = v.small_grid(spark, d)
    return hydro.touching(g.where("z <= 4"), g.where("r = c and r % 5 = 0"))


@query(f"WITH {v.SMALL}, wet AS (SELECT * FROM small WHERE z <= 2) SELECT DISTINCT s.dem_id, s.r, s.c FROM small s JOIN wet w ON s.dem_id = w.dem_id AND abs(s.r - w.r) <= 1 AND abs(s.c - w.c) <= 1")
def r31_dilate(spark, d):
    g = v.small_grid(spark, d)
    return grid.dilate(g.where("z <= 2"), g)


@query(f"WITH {v.GRID}, axes(a, dr, dc) AS (VALUES (0, 0, 2), (1, 2, 0), (2, 2, 2), (3, 2, -2)), e AS (SELECT g.dem_id, g.r, g.c, g.z, a, least(coalesce(x.z, 'inf'::DOUBLE), coalesce(y.z, 'inf'::DOUBLE)) AS low FROM grid g CROSS JOIN axes LEFT JOIN grid x ON x.dem_id = g.dem_id AND x.r = g.r + dr AND x.c = g.c + dc LEFT JOIN grid y ON y.dem_id = g.dem_id AND y.r = g.r - dr AND y.c = g.c - dc WHERE g.z % 7 <> 0) SELECT dem_id, r, c FROM e GROUP BY 1, 2, 3, z HAVING z <= max(low) - 30000")
def r28_incised(spark, d):
    g = v.grid(spark, d)
    return grid.incised(g.withColumn("filled", F.when(F.col("z") % 7 == 0, F.col("z") + 1).otherwise(F.col("z"))), 30000)


FILLED = f"{NEAR_SMALL}, level(t) AS (SELECT DISTINCT z FROM small), rim AS (SELECT s.dem_id, s.r, s.c, s.z FROM small s LEFT JOIN near USING (dem_id, r, c) GROUP BY 1, 2, 3, 4 HAVING count(idn) < 8), open(id, t) AS (SELECT {ID}, t FROM rim, level WHERE z <= t UNION SELECT near.idn, open.t FROM open JOIN near ON near.id = open.id WHERE near.zn <= open.t), filled AS (SELECT {BACK}, id, min(t) AS z FROM open GROUP BY id)"


@query(f"WITH RECURSIVE {FILLED} SELECT s.dem_id, s.r, s.c, s.z, f.z AS filled FROM small s JOIN filled f USING (dem_id, r, c)")
def r21_fill(spark, d):
    return hydro.fill(v.small_grid(spark, d))


@query(f"WITH RECURSIVE {FILLED} SELECT s.dem_id, s.r, s.c, CAST(s.z AS DOUBLE) AS z, CAST(f.z AS DOUBLE) AS filled FROM small s JOIN filled f USING (dem_id, r, c)")
def r21_fill_kernel(spark, d):
    return hydro.fill_kernel(v.small_grid(spark, d))


# breadth first by UNION over (id, steps), bounded by the number of a grid's cells: the least steps count
STEPS = f"""{FILLED}, fn AS (SELECT a.id, a.z, b.id AS idn, b.z AS zn FROM filled a CROSS JOIN d8 JOIN filled b ON b.dem_id = a.dem_id AND b.r = a.r + dr AND b.c = a.c + dc),
flat AS (SELECT id, bool_or(zn > z) AS beside FROM fn GROUP BY id HAVING count(*) = 8 AND min(zn) >= min(z)),
into_flat AS (SELECT fn.id, fn.idn FROM fn JOIN flat ON flat.id = fn.idn WHERE z = zn),
tw(id, n) AS (SELECT DISTINCT id, 1 FROM into_flat WHERE id NOT IN (SELECT id FROM flat) UNION SELECT idn, n + 1 FROM tw JOIN into_flat USING (id) WHERE n < 40),
aw(id, n) AS (SELECT id, 1 FROM flat WHERE beside UNION SELECT idn, n + 1 FROM aw JOIN into_flat USING (id) JOIN flat f ON f.id = aw.id WHERE n < 40),
toward AS (SELECT id, min(n) AS t FROM tw GROUP BY 1), away AS (SELECT id, min(n) AS a FROM aw WHERE id IN (SELECT id FROM flat) GROUP BY 1),
same(a, b) AS (SELECT id, id FROM filled UNION SELECT same.a, fn.idn FROM same JOIN fn ON fn.id = same.b AND fn.z = fn.zn), lab AS (SELECT a AS id, min(b) AS label FROM same GROUP BY 1),
height AS (SELECT label, max(a) AS h FROM away JOIN lab USING (id) GROUP BY 1),
steps AS (SELECT filled.id, CAST(coalesce(2 * t + coalesce(h - a, 0), 0) AS INTEGER) AS steps FROM filled LEFT JOIN toward USING (id) LEFT JOIN away USING (id) LEFT JOIN lab USING (id) LEFT JOIN height USING (label))"""


@query(f"WITH RECURSIVE {STEPS} SELECT {BACK}, steps FROM steps")
def r23_flat_gradient(spark, d):
    return hydro.flat_gradient(v.small_grid(spark, d), raw=True)


@query(f"WITH RECURSIVE {STEPS}, {v.SPACE}, e AS (SELECT a.dem_id, a.r, a.c, k, code, (a.z - b.z) / sqrt(dx * dc * (dx * dc) + dy * dr * (dy * dr)) AS slope, (s.steps - t.steps) / sqrt(dx * dc * (dx * dc) + dy * dr * (dy * dr)) AS ease FROM filled a CROSS JOIN d8 JOIN filled b ON b.dem_id = a.dem_id AND b.r = a.r + dr AND b.c = a.c + dc JOIN steps s ON s.id = a.id JOIN steps t ON t.id = b.id JOIN space ON space.dem_id = a.dem_id AND space.r = a.r), best AS (SELECT dem_id, r, c, code FROM (SELECT *, row_number() OVER (PARTITION BY dem_id, r, c ORDER BY slope DESC, ease DESC, k) AS n FROM e WHERE slope > 0 OR slope = 0 AND ease > 0) WHERE n = 1) SELECT f.dem_id, f.r, f.c, CAST(coalesce(code, 0) AS INTEGER) AS code FROM filled f LEFT JOIN best USING (dem_id, r, c)")
def r24_r26_drained(spark, d):
    return hydro.drained(v.small_grid(spark, d), _space(spark, d), raw=True)


@query(f"WITH {v.GRID} SELECT dem_id, r - 5 AS r, c - 7 AS c, z FROM grid WHERE r BETWEEN 5 AND 12 AND c BETWEEN 7 AND 12")
def r5_crop(spark, d):
    return grid.crop(v.grid(spark, d), 5, 7, 8, 6)


@query("WITH x AS (SELECT l_suppkey AS dem_id, CAST(l_orderkey % 16 AS INTEGER) AS r, CAST(l_partkey % 16 AS INTEGER) AS c, l_orderkey AS src, max(l_linenumber) AS v FROM lineitem GROUP BY 1, 2, 3, 4) SELECT dem_id, r, c, max_by(v, src) AS v FROM x GROUP BY 1, 2, 3")
def r1_w8_mosaic(spark, d):
    x = v.table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("dem_id"), (F.col("l_orderkey") % 16).cast("int").alias("r"), (F.col("l_partkey") % 16).cast("int").alias("c"), F.col("l_orderkey").alias("src")).agg(F.max("l_linenumber").alias("v"))
    return grid.mosaic(x, "src", "v")


@query(f"WITH {v.GRID}, n AS (SELECT dem_id, CAST(r // 4 AS INTEGER) AS r, CAST(c // 4 AS INTEGER) AS c, z % 5 AS k, count(*) AS m FROM grid GROUP BY 1, 2, 3, 4) SELECT dem_id, r, c, k FROM (SELECT *, row_number() OVER (PARTITION BY dem_id, r, c ORDER BY m DESC, k) AS i FROM n) WHERE i = 1")
def r4_land_cover_mode(spark, d):
    return grid.mode_resample(v.grid(spark, d).select("dem_id", "r", "c", (F.col("z") % 5).alias("k")), 4, "k", 10)


def _zones(g):
    return g.select("dem_id", "r", "c", F.expr("cast(r div 4 * 10 + c div 4 as bigint)").alias("reach"))


@query(f"WITH {v.GRID} SELECT dem_id, CAST(r // 4 * 10 + c // 4 AS BIGINT) AS reach, min(z) AS low, greatest(max(z), 0) AS high, count(*) AS cells FROM grid GROUP BY 1, 2")
def a13_j12_zonal(spark, d):
    g = v.grid(spark, d)
    return grid.zonal(g, _zones(g))


@query(f"WITH {v.GRID}, s AS (SELECT dem_id, CAST(r // 4 * 10 + c // 4 AS BIGINT) AS reach, quantile_cont(z, [0.1, 0.9]) AS q, count(*) AS n FROM grid GROUP BY 1, 2) SELECT dem_id, reach, round(greatest(q[2] - q[1], 0) / n, 6) AS slope FROM s")
def a14_reach_slope(spark, d):
    g = v.grid(spark, d)
    return grid.reach_slope(g, _zones(g))


METRES = f"{v.GRID}, m AS (SELECT dem_id, CAST(CASE dem_id % 4 WHEN 0 THEN z // 100 WHEN 1 THEN z // 10 / 10.0 WHEN 2 THEN z / 100.0 ELSE z / 700.0 END AS FLOAT) AS z FROM grid)"


def _metres(spark, d):
    z = F.col("z")
    k = F.col("dem_id") % 4
    m = F.when(k == 0, F.floor(z / 100).cast("double")).when(k == 1, F.floor(z / 10) / 10.0).when(k == 2, z / 100.0).otherwise(z / 700.0)
    return v.grid(spark, d).withColumn("z", m.cast("float"))


@query(f"WITH {METRES}, s AS (SELECT dem_id, " + ", ".join(f"avg(CASE WHEN CAST(round_even(CAST(z AS DOUBLE) / {x}::DOUBLE, 0) * {x}::DOUBLE AS FLOAT) = z THEN 1 ELSE 0 END) AS s{k}" for k, x in enumerate(("1.0", "0.1", "0.01", "0.001"))) + " FROM m GROUP BY 1) SELECT dem_id, CAST(CASE WHEN s0 >= 0.9 THEN 1 WHEN s1 >= 0.9 THEN 0.1 WHEN s2 >= 0.9 THEN 0.01 WHEN s3 >= 0.9 THEN 0.001 ELSE 0 END AS DOUBLE) AS step FROM s")
def a15_height_step(spark, d):
    return grid.height_step(_metres(spark, d))


@query(f"WITH {METRES}, s AS (SELECT dem_id, avg(CASE WHEN z::DOUBLE * 2 = round_even(z::DOUBLE * 2, 0) THEN 1 ELSE 0 END) AS s FROM m GROUP BY 1) SELECT dem_id, round(s, 6) AS share, s >= 0.3 AS flattened FROM s")
def a16_half_step_share(spark, d):
    return grid.half_metres(_metres(spark, d))


@query(f"WITH {v.SMALL}, wet AS (SELECT * FROM small WHERE z <= 1), x AS (SELECT s.dem_id, s.r // 4 AS reach, max(CASE WHEN w.r IS NULL THEN 0 ELSE 1 END) AS b FROM small s LEFT JOIN wet w ON s.dem_id = w.dem_id AND abs(s.r - w.r) <= 1 AND abs(s.c - w.c) <= 1 GROUP BY s.dem_id, s.r, s.c) SELECT dem_id, CAST(reach AS BIGINT) AS reach, round(avg(b), 6) AS beside, avg(b) < 0.5 AS narrow FROM x GROUP BY 1, 2")
def a18_beside_share(spark, d):
    g = v.small_grid(spark, d)
    return grid.beside_share(g, g.select("dem_id", "r", "c", F.expr("cast(r div 4 as bigint)").alias("reach")), g.where("z <= 1"))


def _near_sql(k: int) -> str:
    return f"WITH {v.GRID}, f AS (SELECT dem_id, r AS fr, c AS fc FROM grid WHERE z % 17 = 0), m AS (SELECT dem_id, r, c, fr, fc, (r - fr) * (r - fr) + (c - fc) * (c - fc) AS d2 FROM grid JOIN f USING (dem_id)) SELECT dem_id, r, c, CAST(n AS INTEGER) AS rank, fr, fc, d2 FROM (SELECT *, row_number() OVER (PARTITION BY dem_id, r, c ORDER BY d2, fr, fc) AS n FROM m WHERE d2 <= 36) WHERE n <= {k}"


@query(_near_sql(1))
def j8_j10_nearest(spark, d):
    g = v.grid(spark, d)
    return grid.nearest(g, g.where("z % 17 = 0"), 6)


@query(_near_sql(16))
def j9_w10_candidates(spark, d):
    g = v.grid(spark, d)
    return grid.nearest(g, g.where("z % 17 = 0"), 6, 16)


@query(f"WITH {v.SMALL}, s AS (SELECT dem_id, r AS fr, c AS fc, z + 3 AS wse FROM small WHERE z <= 3), m AS (SELECT dem_id, r, c, z, wse, CAST((r - fr) * (r - fr) + (c - fc) * (c - fc) AS DOUBLE) AS d2 FROM small JOIN s USING (dem_id)), g AS (SELECT dem_id, r, c, z, coalesce(max(wse) FILTER (WHERE d2 = 0), sum(wse / d2) FILTER (WHERE d2 > 0) / sum(1 / d2) FILTER (WHERE d2 > 0)) AS level FROM m WHERE d2 <= 16 GROUP BY 1, 2, 3, 4) SELECT dem_id, r, c, round(level, 11) AS level, round(level, 11) > z AS flooded FROM g")
def r20_set_depth(spark, d):
    g = v.small_grid(spark, d)
    return grid.inverse_distance(g, g.where("z <= 3").select("dem_id", "r", "c", (F.col("z") + 3).alias("wse")), 4)


@query(f"WITH {v.GRID} SELECT dem_id, r, c FROM grid WHERE r + 0.5 > 2 AND c + 0.5 > 3 AND r + 0.5 < 14 AND c + 0.5 < 3 + (r + 0.5 - 2)")
def r7_polygon_cells(spark, d):
    g = v.grid(spark, d)
    edges = g.select("dem_id").distinct().select("dem_id", F.inline(F.expr("array(named_struct('x1', 3.0D, 'y1', 2.0D, 'x2', 15.0D, 'y2', 14.0D), named_struct('x1', 15.0D, 'y1', 14.0D, 'x2', 3.0D, 'y2', 14.0D), named_struct('x1', 3.0D, 'y1', 14.0D, 'x2', 3.0D, 'y2', 2.0D))")))
    return grid.in_polygon(g, edges)


@query(f"WITH {v.GRID} SELECT dem_id, r, c, (c * 50.0 <= 1500) AND ((z % 2 = 0 AND c * 50.0 <= greatest(2 * (r * 2.0), 60) AND z % 7 <= 2) OR (z % 7 <= 1 AND r * 2.0 > 0 AND c * 50.0 <= 1.5 * (r * 2.0))) AS channel FROM grid")
def r13_channel_rule(spark, d):
    g = v.grid(spark, d).select("dem_id", "r", "c", (F.col("c") * 50.0).alias("d"), (F.col("z") % 7).alias("rise"), (F.col("r") * 2.0).alias("width"), (F.col("z") % 2 == 0).alias("flat"))
    return g.select("dem_id", "r", "c", grid.channel_rule("d", "rise", "width", "flat").alias("channel"))


@query(f"WITH {v.NETWORK} SELECT CAST(ord AS BIGINT) AS dem_id, CAST(reach % 12 AS INTEGER) AS r, CAST(reach % 7 AS INTEGER) AS c, max_by(reach, (ord, area, reach)) AS reach FROM network GROUP BY 1, 2, 3")
def r6_w7_stream_winner(spark, d):
    n = v.network(spark, d).select(F.col("ord").cast("long").alias("dem_id"), (F.col("reach") % 12).cast("int").alias("r"), (F.col("reach") % 7).cast("int").alias("c"), "reach", "ord", "area")
    return grid.stream_winner(n)


@query(f"WITH RECURSIVE {NEAR_SMALL}, seeds AS (SELECT dem_id, r, c FROM small WHERE r = c AND z < 9), wet AS (SELECT *, {ID} AS id FROM (SELECT dem_id, r, c FROM seeds UNION SELECT dem_id, r, c FROM small WHERE z <= 3) WHERE NOT (r >= 12 AND c >= 12)), {_spread('wet', 'seeds')} SELECT {BACK} FROM hit")
def r17_water_mask(spark, d):
    g = v.small_grid(spark, d)
    return hydro.water_mask(g.where("r = c and z < 9"), g.where("z <= 3"), g.where("r >= 12 and c >= 12").select("dem_id", "r", "c"))


@query(f"WITH RECURSIVE {NEAR_SMALL}, streams AS (SELECT dem_id, r, c, r // 4 AS reach FROM small WHERE r = c), mask AS (SELECT dem_id, r, c FROM small WHERE z <= 4 OR r = c), water AS (SELECT *, {ID} AS id FROM mask WHERE r <> c), beside AS (SELECT s.dem_id, s.r, s.c, s.reach, max(CASE WHEN w.r IS NULL THEN 0 ELSE 1 END) AS b FROM streams s LEFT JOIN water w ON s.dem_id = w.dem_id AND abs(s.r - w.r) <= 1 AND abs(s.c - w.c) <= 1 GROUP BY 1, 2, 3, 4), wide AS (SELECT dem_id, r, c FROM beside JOIN (SELECT dem_id, reach FROM beside GROUP BY 1, 2 HAVING avg(b) >= 0.5) USING (dem_id, reach)), {_patches('water')}, kept AS (SELECT DISTINCT label FROM lab JOIN water USING (id) LEFT JOIN wide x ON x.dem_id = water.dem_id AND abs(x.r - water.r) <= 1 AND abs(x.c - water.c) <= 1 WHERE x.r IS NOT NULL OR water.r = 15) SELECT dem_id, r, c FROM streams UNION ALL SELECT {BACK} FROM lab WHERE label IN (SELECT label FROM kept)")
def r18_one_cell_wide(spark, d):
    g = v.small_grid(spark, d)
    streams = g.where("r = c").select("dem_id", "r", "c", F.expr("r div 4").alias("reach"))
    return hydro.one_cell_wide(g.where("z <= 4 or r = c"), streams, g.where("r = 15"))


@query(f"WITH {v.GRID} SELECT dem_id, r, c, CAST(row_number() OVER (PARTITION BY dem_id ORDER BY r, c) AS INTEGER) AS nth FROM grid WHERE z % 3 = 0")
def w13_nth_valid(spark, d):
    return grid.nth_valid(v.grid(spark, d).where("z % 3 = 0")).select("dem_id", "r", "c", "nth")


@query(f"WITH {v.GRID} SELECT dem_id, r, c, z - 2000000.5::DOUBLE AS z FROM grid WHERE z - 2000000.5 >= -1000 AND NOT (r = 3 AND c > 9)")
def p13_p14_valid_cells(spark, d):
    g = v.grid(spark, d).withColumn("z", F.col("z") - 2000000.5)
    return grid.valid(g, g.where("r = 3 and c > 9"))


@query("WITH p AS (SELECT o_custkey AS path, o_orderkey AS pos, CAST(o_orderkey % 13 AS INTEGER) AS r, CAST(o_orderkey // 3 % 11 AS INTEGER) AS c FROM orders), x AS (SELECT *, lead(r) OVER w AS r2, lead(c) OVER w AS c2 FROM p WINDOW w AS (PARTITION BY path ORDER BY pos)), y AS (SELECT *, coalesce(greatest(abs(r2 - r), abs(c2 - c), 1), 1) AS n FROM x), z AS (SELECT *, unnest(range(0, n)) AS k FROM y) SELECT path, pos, CAST(k AS INTEGER) AS k, CASE WHEN k = 0 THEN r ELSE CAST(round_even(r + (r2 - r) * k / n, 0) AS INTEGER) END AS r, CASE WHEN k = 0 THEN c ELSE CAST(round_even(c + (c2 - c) * k / n, 0) AS INTEGER) END AS c FROM z")
def m20_fill_gaps(spark, d):
    o = v.table(spark, d, "orders").select(F.col("o_custkey").alias("path"), F.col("o_orderkey").alias("pos"), (F.col("o_orderkey") % 13).cast("int").alias("r"), F.expr("cast(o_orderkey div 3 % 11 as int)").alias("c"))
    return grid.fill_gaps(o)


# ---------------------------------------------------------------- reaches in grids


STREAM_CELLS = "stream AS (SELECT dem_id, id, r // 6 AS reach FROM pointers WHERE c % 5 <> 0)"


def _stream_cells(spark, d):
    return v.grid(spark, d).where("c % 5 <> 0").select("dem_id", "r", "c", F.expr("r div 6").alias("reach"))


@query(f"""WITH RECURSIVE {POINTERS}, {STREAM_CELLS},
link AS (SELECT s.dem_id, s.id, s.reach, coalesce(s1.id, s2.id) AS nxt, CASE WHEN s1.id IS NOT NULL THEN 1 WHEN s2.id IS NOT NULL THEN 2 END AS gap FROM stream s JOIN pointers p1 ON p1.id = s.id LEFT JOIN stream s1 ON s1.id = p1.down AND s1.reach = s.reach LEFT JOIN pointers p2 ON p2.id = p1.down LEFT JOIN stream s2 ON s2.id = p2.down AND s2.reach = s.reach),
walk AS (SELECT dem_id, reach, id AS head, id AS fin, 1 AS covered, 0 AS len FROM link UNION ALL SELECT walk.dem_id, walk.reach, head, nxt, covered + 1, len + gap FROM walk JOIN link ON link.id = fin WHERE nxt IS NOT NULL),
ends AS (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY head ORDER BY covered DESC) = 1)
SELECT dem_id, CAST(head % 256 AS BIGINT) AS start_pixel, CAST(fin % 256 AS BIGINT) AS end_pixel, CAST(len + 1 AS BIGINT) AS length, CAST(reach AS BIGINT) AS stream_id FROM ends WHERE reach > 0 QUALIFY row_number() OVER (PARTITION BY dem_id, reach ORDER BY covered DESC, len DESC, head) = 1""")
def g13_g14_stream_info(spark, d):
    return reaches.stream_info(_stream_cells(spark, d), _down(spark, d), v.grids(spark, d).withColumn("ncols", F.lit(16)))


PATHS = "paths AS (SELECT CAST(o_custkey % 5 AS BIGINT) AS dem_id, o_custkey AS reach, CAST(row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS INTEGER) AS pos, CAST(o_orderkey % 13 AS INTEGER) AS r, CAST(o_orderkey // 3 % 11 AS INTEGER) AS c, CAST(floor(o_totalprice) AS BIGINT) % 7 AS z, o_orderkey % 9 = 0 AS joined FROM orders)"


@query(f"""WITH {PATHS}, lake AS (SELECT s_suppkey % 5 AS dem_id, s_suppkey % 13 AS r, s_suppkey % 11 AS c FROM supplier),
leaving AS (SELECT dem_id, reach FROM paths p WHERE pos = 0 AND NOT joined AND EXISTS (SELECT 1 FROM lake l WHERE l.dem_id = p.dem_id AND abs(l.r - p.r) <= 1 AND abs(l.c - p.c) <= 1)),
falls AS (SELECT *, z - lead(z) OVER w >= 2 AS fall, count(*) OVER (PARTITION BY reach) AS n, coalesce(min(CASE WHEN joined THEN pos END) OVER (PARTITION BY reach), 99) AS stop FROM paths JOIN leaving USING (dem_id, reach) WINDOW w AS (PARTITION BY reach ORDER BY pos)),
foot AS (SELECT reach, n, max(pos) + 1 AS foot FROM falls WHERE fall AND pos < 6 AND pos < stop GROUP BY ALL),
moved AS (SELECT reach, foot FROM foot f WHERE n - foot >= 3 AND NOT EXISTS (SELECT 1 FROM falls x WHERE x.reach = f.reach AND x.fall AND x.pos >= foot AND x.pos < foot + 1))
SELECT dem_id, reach, pos, r, c, z, joined FROM paths LEFT JOIN moved USING (reach) WHERE foot IS NULL OR pos >= foot""")
def m12_below_outlets(spark, d):
    o = v.table(spark, d, "orders").selectExpr("o_custkey % 5 dem_id", "o_custkey reach", "cast(row_number() over (partition by o_custkey order by o_orderkey) - 1 as int) pos", "cast(o_orderkey % 13 as int) r", "cast(o_orderkey div 3 % 11 as int) c", "cast(floor(o_totalprice) as long) % 7 z", "o_orderkey % 9 = 0 joined")
    lake = v.table(spark, d, "supplier").selectExpr("s_suppkey % 5 dem_id", "s_suppkey % 13 r", "s_suppkey % 11 c")
    return reaches.below_outlets(o, lake, 1, 6, 1, 2, 3)


# ---------------------------------------------------------------- exchange between tiles


@query("WITH t AS (SELECT s_suppkey AS tile, s_nationkey % 2 AS crs, s_suppkey % 10 * 3.0 AS xmin, s_suppkey % 10 * 3.0 + 3 + s_nationkey % 3 AS xmax, s_suppkey // 10 * 2.0 AS ymin, s_suppkey // 10 * 2.0 + 2 + s_nationkey % 2 AS ymax FROM supplier) SELECT a.tile, b.tile AS other FROM t a JOIN t b ON a.crs = b.crs AND a.tile <> b.tile AND a.xmin < b.xmax AND b.xmin < a.xmax AND a.ymin < b.ymax AND b.ymin < a.ymax")
def j7_s27_neighbour_tiles(spark, d):
    t = v.table(spark, d, "supplier").selectExpr("s_suppkey tile", "s_nationkey % 2 crs", "s_suppkey % 10 * 3.0D xmin", "s_suppkey % 10 * 3.0D + 3 + s_nationkey % 3 xmax", "s_suppkey div 10 * 2.0D ymin", "s_suppkey div 10 * 2.0D + 2 + s_nationkey % 2 ymax")
    return exchange.neighbour_tiles(t)


@query("WITH s AS (SELECT o_custkey AS reach, o_orderkey % 37 * 1.0 AS x1, o_orderkey % 11 * 1.0 AS y1, o_orderkey % 37 + o_orderkey % 5 - 2.0 AS x2, o_orderkey % 11 + o_orderkey % 3 - 1.0 AS y2 FROM orders), u(p) AS (VALUES (23.0), (29.0)), w(p) AS (VALUES (5.0), (7.0)) SELECT DISTINCT reach FROM s, u WHERE least(x1, x2) <= p AND greatest(x1, x2) >= p AND CASE WHEN x1 = x2 THEN least(y1, y2) <= 9 AND greatest(y1, y2) >= 3 ELSE y1 + (p - x1) * (y2 - y1) / (x2 - x1) BETWEEN 3 AND 9 END UNION SELECT reach FROM s, w WHERE least(y1, y2) <= p AND greatest(y1, y2) >= p AND CASE WHEN y1 = y2 THEN least(x1, x2) <= 31 AND greatest(x1, x2) >= 21 ELSE x1 + (p - y1) * (x2 - x1) / (y2 - y1) BETWEEN 21 AND 31 END")
def j5_crossing_reaches(spark, d):
    s = v.table(spark, d, "orders").selectExpr("o_custkey reach", "o_orderkey % 37 * 1.0D x1", "o_orderkey % 11 * 1.0D y1", "o_orderkey % 37 + o_orderkey % 5 - 2.0D x2", "o_orderkey % 11 + o_orderkey % 3 - 1.0D y2")
    return exchange.crossing_reaches(s, 21, 3, 31, 9, 2)


@query("WITH x AS (SELECT vec_id AS reach, unnest(range(1, 65)) AS i, embedding FROM embeddings WHERE label % 2 = 0 AND least(vec_id % 50, 49 - vec_id % 50, vec_id % 31, 30 - vec_id % 31) <= 7) SELECT reach, CAST(embedding[i] AS DOUBLE) AS flow, CAST(embedding[i] * 2 AS DOUBLE) AS wse FROM x WHERE embedding[i] > 0")
def x3_f14_boundary_water(spark, d):
    e = v.table(spark, d, "embeddings")
    up = F.transform("embedding", lambda x: F.when(x > 0, x.cast("double")))
    vdt = e.select(F.col("vec_id").alias("reach"), (F.col("vec_id") % 50).alias("x"), (F.col("vec_id") % 31).alias("y"), up.alias("q"), F.transform("embedding", lambda x: (x * 2).cast("double")).alias("wse"))
    return exchange.boundary_water(vdt, e.where("label % 2 = 0").select(F.col("vec_id").alias("reach")), exchange.near_edge("x", "y", 0, 0, 49, 30, 4, 1))


@query("SELECT c_custkey AS reach, c_nationkey AS tile, CAST(c_custkey % 50 AS DOUBLE) AS x, CAST(c_custkey % 31 AS DOUBLE) AS y FROM customer WHERE c_nationkey <> 3 AND c_custkey % 50 > 10 AND c_custkey % 50 < 30 AND c_custkey % 31 > 5 AND c_custkey % 31 < 20")
def x4_j6_gather(spark, d):
    p = v.table(spark, d, "customer").selectExpr("c_custkey reach", "c_nationkey tile", "c_custkey % 50 * 1.0D x", "c_custkey % 31 * 1.0D y")
    return exchange.gather(p, 10, 5, 30, 20, 3)


# ---------------------------------------------------------------- scalars, sources


@query("SELECT c_custkey AS id, printf('%s%02d%s%03d', CASE WHEN ceil(c_custkey % 170 - 85.5) >= 0 THEN 'n' ELSE 's' END, CAST(abs(ceil(c_custkey % 170 - 85.5)) AS INTEGER), CASE WHEN floor(c_custkey % 350 - 175.5) >= 0 THEN 'e' ELSE 'w' END, CAST(abs(floor(c_custkey % 350 - 175.5)) AS INTEGER)) AS tile FROM customer")
def f5_s21_tile_names(spark, d):
    return v.table(spark, d, "customer").select(F.col("c_custkey").alias("id"), fn.usgs_tile(F.col("c_custkey") % 170 - 85.5, F.col("c_custkey") % 350 - 175.5).alias("tile"))


@query("SELECT event_id, CAST(hour(ts) // 6 * 6 AS INTEGER) AS cycle, CASE WHEN regexp_extract(f, 'Forecast_(\\d{8})', 1) <> '' THEN CAST(strptime(regexp_extract(f, 'Forecast_(\\d{8})', 1), '%Y%m%d') AS DATE) END AS issued FROM (SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN 'other.csv' ELSE 'dem_Forecast_' || strftime(ts, '%Y%m%d') || '_00.csv' END AS f FROM events)")
def f3_f4_cycles(spark, d):
    e = v.table(spark, d, "events").withColumn("f", F.when(F.col("event_id") % 3 == 0, "other.csv").otherwise(F.concat(F.lit("dem_Forecast_"), F.date_format("ts", "yyyyMMdd"), F.lit("_00.csv"))))
    return e.select("event_id", fn.cycle_hour(F.hour("ts")).alias("cycle"), fn.forecast_date(F.col("f")).alias("issued"))


@query("SELECT p_partkey AS id, floor(p_retailprice / 7 * 2) / 2 AS half, round(p_retailprice / 0.3048, 6) AS feet, CAST(least((p_partkey - 700) - 20 * floor((p_partkey - 700) / 20.0), 19 - ((p_partkey - 700) - 20 * floor((p_partkey - 700) / 20.0))) AS BIGINT) AS mirror, CAST(floor((p_size - 2.5) / 1.5) AS INTEGER) AS col FROM part")
def f8_f9_f17_f19_scalars(spark, d):
    p = v.table(spark, d, "part")
    _, col = fn.to_cell(F.col("p_size"), F.lit(0), 2.5, 1.5, 0.0, -1.0)
    return p.select(F.col("p_partkey").alias("id"), fn.half_floor(F.col("p_retailprice") / 7).cast("double").alias("half"), F.round(fn.feet(F.col("p_retailprice")), 6).alias("feet"), fn.reflected(F.col("p_partkey") - 700, 10).alias("mirror"), col.alias("col"))


@query("SELECT s_suppkey AS id, round(111132.92 - 559.82 * cos(2 * radians(s_suppkey % 80)) + 1.175 * cos(4 * radians(s_suppkey % 80)), 4) AS north, round(111412.84 * cos(radians(s_suppkey % 80)) - 93.5 * cos(3 * radians(s_suppkey % 80)), 4) AS east FROM supplier")
def f6_metres_per_degree(spark, d):
    north, east = fn.metres_per_degree(F.col("s_suppkey") % 80)
    return v.table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.round(north, 4).alias("north"), F.round(east, 4).alias("east"))


@query("SELECT event_id, strftime(ts - INTERVAL 2 HOUR, '%Y%m%d') AS short_day, strftime(ts - INTERVAL 2 HOUR, '%H') AS short_hour, strftime(ts, '%Y%m%d') AS day, printf('%02d', CAST(hour(ts) // 6 * 6 AS INTEGER)) AS medium_hour, '00' AS long_hour, CAST(NULL AS VARCHAR) AS daily_hour FROM events")
def f3_issues(spark, d):
    e = v.table(spark, d, "events")
    at = {k: fn.forecast_issue(F.col("ts"), k) for k in ("short", "medium", "long", "daily")}
    return e.select("event_id", at["short"][0].alias("short_day"), at["short"][1].alias("short_hour"), at["medium"][0].alias("day"), at["medium"][1].alias("medium_hour"), at["long"][1].alias("long_hour"), at["daily"][1].alias("daily_hour"))


@query("SELECT event_id, CASE WHEN event_id % 30 < 24 THEN printf('%02d', CAST(event_id % 30 AS INTEGER)) END AS hour, CASE event_id % 3 WHEN 2 THEN NULL ELSE CAST(ts AS DATE) END AS day, CASE WHEN event_id % 4 = 3 THEN event_type || chr(39) ELSE event_type END AS name FROM events")
def f1_f2_text(spark, d):
    e = v.table(spark, d, "events")
    day = F.when(F.col("event_id") % 3 == 0, F.date_format("ts", "yyyyMMdd")).when(F.col("event_id") % 3 == 1, F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC"))).otherwise("soon")
    k, t = F.col("event_id") % 4, F.col("event_type")
    name = F.when(k == 0, t).when(k == 1, F.concat(F.lit(" 'x\"").substr(1, 2), t, F.lit("' "))).when(k == 2, F.concat(F.lit("\"' '"), F.lit("'"), t, F.lit("'"), F.lit("' '\""))).otherwise(F.concat(t, F.lit("'")))
    return e.select("event_id", fn.forecast_hour((F.col("event_id") % 30).cast("string")).alias("hour"), fn.forecast_day(day).alias("day"), fn.strip_quotes(name).alias("name"))


BANDS = "bands(b, n0, n1, e0, e1) AS (VALUES " + ", ".join(f"({k}, {a[0]}::DOUBLE, {a[1]}::DOUBLE, {b[0]}::DOUBLE, {b[1]}::DOUBLE)" for k, (a, b) in enumerate(zip(fn.LATITUDE_KM, fn.LONGITUDE_KM))) + ")"


@query(f"WITH {BANDS}, p AS (SELECT c_custkey AS id, c_custkey % 901 / 10.0::DOUBLE AS lat, CASE WHEN c_custkey % 7 = 0 THEN 30.0 ELSE 0.001 END::DOUBLE AS cell FROM customer), q AS (SELECT id, cell, n0 + (n1 - n0) * (lat - b * 10) / 10 AS n, e0 + (e1 - e0) * (lat - b * 10) / 10 AS e FROM p JOIN bands ON b = greatest(ceil(lat / 10) - 1, 0)) SELECT id, round(CASE WHEN cell > 0.5 THEN cell ELSE cell * e * 1000 END, 6) AS width, round(CASE WHEN cell > 0.5 THEN cell ELSE cell * n * 1000 END, 6) AS height, round(CASE WHEN cell > 0.5 THEN 1 ELSE 1000 * (n + e) / 2 END, 4) AS unit FROM q")
def f7_banded_metres(spark, d):
    c = v.table(spark, d, "customer")
    w, h, u = fn.banded_metres(F.when(F.col("c_custkey") % 7 == 0, F.lit(30.0)).otherwise(F.lit(0.001)), -(F.col("c_custkey") % 901) / 10.0)
    return c.select(F.col("c_custkey").alias("id"), F.round(w, 6).alias("width"), F.round(h, 6).alias("height"), F.round(u, 4).alias("unit"))


@query("SELECT p_partkey AS id, round(p_size * pow(1e-6::DOUBLE, p_partkey % 3 / 2.0::DOUBLE), 9) AS scaled FROM part")
def f11_power_scaled(spark, d):
    return v.table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.round(fn.power_scaled(F.col("p_size"), F.col("p_partkey") % 3 / 2.0), 9).alias("scaled"))


@query("SELECT CAST(m AS INTEGER) AS member, CAST(h AS INTEGER) AS hour FROM range(1, 8) a(m), range(6, 720, 6) b(h)")
def s16_forecast_files(spark, d):
    return tables.forecast_files(spark, 7, 6, 720, 6)


@query("SELECT DISTINCT CAST(trunc(c_custkey % 300 / 7.0 - 20) AS INTEGER) AS lat, CAST(trunc(c_custkey % 500 / 3.0 - 80) AS INTEGER) AS lon FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_totalprice > 100000")
def s20_warning_tiles(spark, d):
    flagged = v.table(spark, d, "orders").select(F.col("o_custkey").alias("reach"), F.when(F.col("o_totalprice") > 100000, 5).otherwise(0).alias("ret_per"))
    return network.warning_places(flagged, v.table(spark, d, "customer").selectExpr("c_custkey reach", "c_custkey % 300 / 7.0 - 20 lat", "c_custkey % 500 / 3.0 - 80 lon"))


@query("SELECT name FROM (SELECT 'dem' || event_id % 12 || CASE WHEN event_id % 5 = 0 THEN '0' ELSE '' END || '_Forecast_' || strftime(ts, '%Y%m%d') || CASE WHEN event_id % 2 = 0 THEN '_06' ELSE '' END || '.csv' AS name, CAST(ts AS DATE) AS day, event_id FROM events) WHERE event_id % 12 = 1 AND event_id % 5 > 0 AND date_diff('day', day, DATE '2024-02-01') >= 20 AND day <> DATE '2024-01-05'")
def k13_expired(spark, d):
    e = F.col("event_id")
    names = v.table(spark, d, "events").select(F.concat(F.lit("dem"), (e % 12).cast("string"), F.when(e % 5 == 0, "0").otherwise(""), F.lit("_Forecast_"), F.date_format("ts", "yyyyMMdd"), F.when(e % 2 == 0, "_06").otherwise(""), F.lit(".csv")).alias("name"))
    return tables.expired(names, "2024-02-01", 20, "dem1", "20240105")


@query(f"WITH {v.SMALL}, m(k, n) AS (VALUES (10, 0.12), (20, 0.05), (30, 0.03), (40, 0.035), (50, 0.075), (60, 0.03), (70, 0.03), (80, 0.03), (90, 0.1), (95, 0.1), (100, 0.1)) SELECT dem_id, r, c, CAST(n AS DOUBLE) AS n FROM small JOIN m ON k = (z + 1) * 10")
def k12_roughness(spark, d):
    g = v.small_grid(spark, d).select("dem_id", "r", "c", ((F.col("z") + 1) * 10).alias("k"))
    return g.join(F.broadcast(tables.manning(spark)), F.col("k") == F.col("lc_id")).select("dem_id", "r", "c", "n")
