"""Every registered query against DuckDB, and the kernels against hand-made or random grids."""


import numpy as np
import pytest
from pyspark.sql import functions as F

from fluvion import registry
from fluvion.operators import grid, hydro, network

from .oracle import connect, rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    if name in registry.ORACLE_SQL:
        want = duck.sql(registry.ORACLE_SQL[name])
        assert sorted(df.columns) == sorted(want.columns)
        assert got == rows(want.columns, want.fetchall())


def cells_of(spark, z):
    """Two grids in one table: the one given, and above it one that would drain it if they met."""
    data = [(k, r, c, None if np.isnan(z[r, c]) else float(z[r, c]) - 50 * k) for k in (0, 1) for r in range(z.shape[0]) for c in range(z.shape[1])]
    return spark.createDataFrame(data, "dem_id int, r int, c int, z double")


def square(spark, rows):
    return spark.createDataFrame([(k, r, 1.0, 1.0) for k in (0, 1) for r in range(rows)], "dem_id int, r int, dx double, dy double")


def test_fill_forms_agree(spark):
    rng = np.random.default_rng(6)
    for trial in range(3):
        z = rng.integers(100, 104, (9, 12)).astype(float)
        if trial == 2:
            z[4, 5] = np.nan
        want = hydro.fill_array(z)
        got = {(r.r, r.c): r.filled for r in hydro.fill(cells_of(spark, z)).where('dem_id = 0').collect()}
        assert all(got[r, c] == want[r, c] for r in range(9) for c in range(12) if not np.isnan(z[r, c]))
        assert (want[~np.isnan(z)] >= z[~np.isnan(z)]).all()


def test_accumulation_conserves(spark):
    z = np.add.outer(np.arange(8), np.arange(6)) * 1.0
    codes = grid.flow_direction(cells_of(spark, z), square(spark, 8))
    acc = {(r.dem_id, r.r, r.c): r.total for r in hydro.flow_accumulation(grid.pointers(codes).withColumn("one", F.lit(1)), "one").collect()}
    assert acc[0, 0, 0] == acc[1, 0, 0] >= 2 and len(acc) == 96
    codes = {(r.dem_id, r.r, r.c): r.code for r in codes.collect()}
    assert codes[0, 0, 0] == 0 and codes[0, 3, 3] == 64
    wide = {(r.r, r.c): r.code for r in grid.flow_direction(cells_of(spark, z), square(spark, 8).withColumn("dx", F.lit(100.0))).where("dem_id = 0").collect()}
    assert wide[3, 3] == 128  # columns far apart: straight up is steepest


def test_flat_sloping_land_has_no_flat_cells(spark):
    z = 100 + 0.0137 * np.arange(12)[:, None] + 0.0171 * np.arange(15)[None, :]
    assert hydro.flat_cells(cells_of(spark, z)).count() == 0


def test_sea_spreads_only_when_all_feeders_are_wet(spark):
    net = spark.createDataFrame([(1, 2, 1, 1), (2, 3, 1, 2), (3, 4, 1, 3), (5, 4, 1, 3), (4, -1, 2, 9)], "reach long, ds long, ord int, area long")
    start = lambda *ids: spark.createDataFrame([(i,) for i in ids], "reach long")
    assert {r.reach for r in network.in_the_sea(net, start(3)).collect()} == {3}
    assert {r.reach for r in network.in_the_sea(net, start(1, 5)).collect()} == {1, 2, 3, 4, 5}


def test_cycles_are_cut(spark):
    rows = [(1, 2, 1, 5), (2, 3, 1, 7), (3, 1, 1, 11), (4, 2, 1, 13), (5, 4, 1, 17), (6, 6, 1, 19), (7, -1, 1, 23)]
    net = spark.createDataFrame(rows, "reach long, ds long, ord int, area long")
    # all of a cycle is cut loose: 2 has its own area and that of its feeders off the cycle
    assert {r.reach: r.upstream_area for r in network.upstream_area(net).collect()} == {1: 5, 2: 7 + 13 + 17, 3: 11, 4: 30, 5: 17, 6: 19, 7: 23}
    # the walk from 1 comes back to 1: 3 closes it
    assert {r.reach: r.ds for r in network.break_cycles(net).collect()} == {1: 2, 2: 3, 3: -1, 4: 2, 5: 4, 6: -1, 7: -1}
    late = spark.createDataFrame([(1, 5, 1, 1), (5, 6, 1, 1), (6, 7, 1, 1), (7, 5, 1, 1), (0, 6, 1, 1)], "reach long, ds long, ord int, area long")
    assert {r.reach: r.ds for r in network.break_cycles(late).collect()} == {1: 5, 5: -1, 6: 7, 7: 5, 0: 6}
    assert {r.reach for r in network.tour(net).collect()} == {1, 2, 3, 4, 5, 6, 7}
