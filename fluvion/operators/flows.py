"""Flow statistics over ordinary tables: ensemble peaks, flow-duration curves, return periods, weighted means."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Exceedance percentages and return periods that flow tables carry.
EXCEEDANCE = [0, 1, 5, 10, 15, 20, 25, 30, 35, 40, 45, 50, 55, 60, 65, 70, 75, 80, 85, 90, 95, 100]
RETURN_PERIODS = [2, 5, 10, 25, 50, 100]


def ensemble_peak(flows: DataFrame, digits: int | None = 2) -> DataFrame:
    """Median, least and greatest over members of each member's peak: two partial aggregates, then a small exact median."""
    q = F.bround("qout", digits) if digits is not None else F.col("qout")
    peak = flows.groupBy("ensemble", "rivid").agg(F.max(q).alias("peak"))
    return peak.groupBy("rivid").agg(F.median("peak").alias("median"), F.min("peak").alias("min"), F.max("peak").alias("max"))


def single_value(flows: DataFrame) -> DataFrame:
    """The latest flow as median, least and greatest; nothing but nulls is an error."""
    if not flows.where("qout is not null").limit(1).count():
        raise ValueError("the forecast holds no flows")
    q = F.bround(F.max_by("qout", F.struct("time", "qout")), 2)
    return flows.groupBy("rivid").agg(q.alias("median")).select("rivid", "median", F.col("median").alias("min"), F.col("median").alias("max"))


def flow_duration(flows: DataFrame, levels=tuple(EXCEEDANCE)) -> DataFrame:
    """(river_id, p_exceed, flow): the flow exceeded p percent of the time is the quantile 1 - p/100, interpolated."""
    q = F.percentile("flow", F.array(*[F.lit(1 - p / 100) for p in levels]))
    named = flows.groupBy("river_id").agg(q.alias("q")).select("river_id", F.posexplode(F.arrays_zip(F.array(*map(F.lit, levels)).alias("p"), F.col("q"))))
    return named.select("river_id", F.col("col.p").alias("p_exceed"), F.round("col.q", 6).alias("flow"))


def clean_periods(flows: DataFrame) -> DataFrame:
    """Drops null, NaN, positive infinity and zero; negatives stay."""
    f = F.col("flow")
    return flows.where(f.isNotNull() & (f != 0) & ~F.isnan(f.cast("double")) & (f.cast("double") != float("inf")))


def pivot_periods(flows: DataFrame, periods=tuple(RETURN_PERIODS), wanted: DataFrame | None = None) -> DataFrame:
    """A column rp<n> for each period: the mean of duplicates, of flows rounded to three digits and then cleaned. If none is left,
    zeros for the wanted rivers (river_id). The list of periods is fixed, so no extra job finds it."""
    clean = clean_periods(flows.withColumn("flow", F.bround("flow", 3)))
    wide = clean.groupBy("river_id").pivot("rp", list(periods)).agg(F.avg("flow"))
    wide = wide.select("river_id", *[F.col(str(p)).alias(f"rp{p}") for p in periods])
    if wanted is None or clean.limit(1).count():
        return wide
    return wanted.select("river_id").distinct().select("river_id", *[F.lit(0.0).alias(f"rp{p}") for p in periods])


def duration_variable(variables: list[str], chosen: str | None = None) -> str:
    """Which of a table's curves counts: the one chosen, the annual one of hourly flows, or the only one."""
    name = chosen or ("hourly_annual" if "hourly_annual" in variables else variables[0] if len(variables) == 1 else None)
    if name not in variables:
        raise ValueError(f"no flow-duration curve {name!r}: choose one of {sorted(variables)}")
    return name


def pivot_duration(flows: DataFrame, chosen: str | None = None, levels=tuple(EXCEEDANCE)) -> DataFrame:
    """(river_id, p_exceed, one column for each curve) to a column p_exceed_<n> for each level, the mean of duplicates. A level that no
    row has is an error."""
    name = duration_variable([c for c in flows.columns if c not in ("river_id", "p_exceed")], chosen)
    here = {float(r[0]) for r in flows.select("p_exceed").where(F.col("p_exceed").cast("double").isin([float(x) for x in levels])).distinct().collect()}  # at most the levels
    missing = [x for x in levels if float(x) not in here]
    if missing:
        raise ValueError(f"no flows for exceedances of {missing} %")
    wide = flows.groupBy("river_id").agg(*[F.avg(F.when(F.col("p_exceed") == x, F.col(name))).alias(f"p_exceed_{x}") for x in levels])
    return wide


def rounded(table: DataFrame, key: str, digits: int = 3) -> DataFrame:
    """Every column but the key to three digits, halves to even."""
    return table.select(key, *[F.bround(F.col(c), digits).alias(c) for c in table.columns if c != key])


class NoStreams(ValueError):
    """Nothing is left to work on."""


def flow_table(periods: DataFrame, curves: DataFrame | None, wanted: DataFrame, high: str, low: str | None = None, least: float | None = None, drop_missing: bool = True, levels=tuple(EXCEEDANCE)) -> DataFrame:
    """The table of flow statistics (COMID, p_exceed_<n>, rp<n>, premium columns) of the wanted rivers (river_id): missing rivers are
    dropped or an error, periods and curves pivoted and put side by side, high flows raised, and reaches whose low flow is
    below the least one left out. An empty table, or one whose mean high flow isn't positive, is an error."""
    wanted = wanted.select("river_id").where("river_id is not null").distinct()
    periods = check_rivers(periods, wanted, drop_missing)
    wide = pivot_periods(periods, wanted=wanted.join(periods.select("river_id"), "river_id", "left_semi"))
    if curves is not None:
        wide = full_outer(pivot_duration(check_rivers(curves, wanted, drop_missing), levels=levels), wide, "river_id")
    for name in ("p_exceed_0", "rp100"):
        if name in wide.columns:
            wide = wide.withColumn(f"{name}_premium", premium(name))
    if not (wide.agg(F.avg(high)).first()[0] or 0) > 0:
        raise NoStreams("no streamflow for these rivers")
    if least and low not in wide.columns:
        warnings.warn(f"no column {low!r}: the least baseflow is not applied", stacklevel=2)
    elif least:
        wide = baseflow_between(wide, low, least)
        if not wide.limit(1).count():
            raise NoStreams("no river has the least baseflow")
    return rounded(wide.withColumnRenamed("river_id", "COMID"), "COMID")


def check_coefficients(frames: list[DataFrame], weight: str = "Cross_Section_Count", key: str = "COMID") -> DataFrame:
    """The union of coefficient tables that are fit to be averaged: the same columns, a key in every row, positive whole counts."""
    if not frames:
        raise ValueError("no coefficients were given")
    names = frames[0].columns
    if not {key, weight} <= set(names) or len(names) < 3:
        raise ValueError(f"coefficients need {key}, {weight} and a column more")
    if any(set(f.columns) != set(names) for f in frames):
        raise ValueError("coefficient tables differ in their columns")
    whole = frames[0]
    for f in frames[1:]:
        whole = whole.unionByName(f)
    n = F.col(weight).cast("double")
    bad = whole.where(F.col(key).isNull() | n.isNull() | F.isnan(n) | (n <= 0) | (n % 1 != 0) | (n == float("inf")))
    if bad.limit(1).count():
        raise ValueError(f"every row needs a {key} and a positive whole {weight}")
    return whole.withColumn(weight, n.cast("long"))


def peaks_of_members(members: list[DataFrame], digits: int | None = 2) -> DataFrame:
    """ensemble_peak over members that stand in tables of their own."""
    whole = members[0]
    for m in members[1:]:
        whole = whole.unionByName(m)
    return ensemble_peak(whole, digits)


def river_ids(table: DataFrame, column: str) -> DataFrame:
    """Distinct whole ids that aren't null."""
    return table.select(F.col(column).try_cast("long").alias("river_id")).where("river_id is not null").distinct()


def time_span(flows: DataFrame) -> DataFrame:
    return flows.agg(F.min("time").alias("first"), F.max("time").alias("last"))


def numeric_columns(table: DataFrame) -> list[str]:
    """All but the first column that hold numbers."""
    numbers = ("byte", "short", "integer", "long", "float", "double", "decimal")
    return [f.name for f in table.schema.fields[1:] if f.dataType.typeName() in numbers]


def median_rise(rises: DataFrame, key: str, value: str) -> DataFrame:
    """The median of each key's values, those that are null or not a number left out."""
    return rises.groupBy(key).agg(F.median(F.when(~F.isnan(value), F.col(value))).alias("median"), F.count_if(~F.isnan(value) & F.col(value).isNotNull()).alias("n"))


def unpivot(wide: DataFrame, key: str, prefix: str) -> DataFrame:
    """Columns <prefix><number> as rows; names whose rest is no number are left out."""
    columns = [c for c in wide.columns if c.startswith(prefix) and c[len(prefix) :].replace(".", "", 1).isdigit()]
    long = wide.unpivot(key, columns, "name", "flow")
    return long.select(key, F.substring("name", len(prefix) + 1, 20).cast("double").alias("level"), "flow")


def premium(column: str) -> Column:
    return (1.5 * F.col(column) + 50).alias(f"{column}_premium")


def full_outer(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.join(b, key, "full_outer")


def row_max(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """The greatest of several columns, nulls skipped, to three digits."""
    return df.withColumn(name, F.bround(F.greatest(*columns), 3))


def weighted_means(rows: DataFrame, key: str, weight: str, columns: list[str]) -> DataFrame:
    """Means weighted by a count, each over its own finite rows; none: null. The count is the sum."""
    def mean(c: str) -> Column:
        ok = F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))
        return F.round(F.try_divide(F.sum(F.when(ok, F.col(c) * F.col(weight))), F.sum(F.when(ok, F.col(weight)))), 6).alias(c)

    return rows.groupBy(key).agg(F.sum(weight).cast("long").alias(weight), *[mean(c) for c in columns])


def baseflow_between(flows: DataFrame, column: str, least: float) -> DataFrame:
    """Rows with at least the flow; all gone is an error for the caller to raise from an empty result."""
    return flows.where(F.col(column) >= least)


def check_rivers(flows: DataFrame, wanted: DataFrame, drop: bool) -> DataFrame:
    """Flows of the wanted rivers; a missing river is an error, or dropped."""
    if not drop and wanted.join(flows, "river_id", "left_anti").limit(1).count():
        raise ValueError("rivers without flows")
    return flows.join(wanted, "river_id", "left_semi")


def look_up(flows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Flows of the wanted rivers (pos, river_id), in their order."""
    return wanted.join(flows, "river_id").select("pos", "river_id", "flow")


def widest(reaches: DataFrame) -> DataFrame:
    """The greatest mean top width of any reach."""
    return reaches.agg(F.max("top_width").alias("top_width"))


def power_law(curves: DataFrame, flows: DataFrame, fraction: float = 0.1) -> DataFrame:
    """Mean top width and depth of each reach at a fraction of its flow, 0 where it has none; only curves whose four numbers are positive."""
    good = curves.where("depth_a > 0 and depth_b > 0 and tw_a > 0 and tw_b > 0")
    q = F.col("q") * fraction
    met = good.join(flows, "comid").groupBy("comid").agg(F.round(F.avg(F.col("tw_a") * F.pow(q, F.col("tw_b"))), 6).alias("top_width"), F.round(F.avg(F.col("depth_a") * F.pow(q, F.col("depth_b"))), 6).alias("depth"))
    return flows.select("comid").distinct().join(met, "comid", "left").na.fill(0, ["top_width", "depth"])


def first_of(rows: DataFrame, key: str, order: list) -> DataFrame:
    """The first row of each key."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where("_n = 1").drop("_n")
