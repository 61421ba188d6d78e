"""What a review found missing in grid operators, each against a brute-force version."""

from decimal import Decimal

import numpy as np
import pyarrow as pa

from fluvion.operators import grid, hydro, whole

from .test_registry import cells_of, square


def spread(seeds, through):
    """Steps from seeds (1) to the cells of `through`, one ring at a time."""
    far, ring = {x: 1 for x in seeds}, set(seeds)
    while ring:
        ring = {y for r, c in ring for y in ((r + i, c + j) for i in (-1, 0, 1) for j in (-1, 0, 1)) if y in through and y not in far}
        far |= {y: 1 + max(far.values()) for y in ring}
    return far


def brute_gradient(z):
    """Each patch of one level by itself."""
    at = {(r, c): z[r, c] for r in range(z.shape[0]) for c in range(z.shape[1]) if not np.isnan(z[r, c])}
    near = lambda x: [(x[0] + i, x[1] + j) for i in (-1, 0, 1) for j in (-1, 0, 1) if i or j]
    closed = {x for x in at if all(at.get(y, -np.inf) >= at[x] for y in near(x))}
    out, left = {x: 0 for x in at}, set(at)
    while left:
        first = left.pop()
        patch = set(spread([first], {x for x in at if at[x] == at[first]}))
        left -= patch
        flat = patch & closed
        low = [x for x in patch - flat if flat & set(near(x))]
        away = spread([x for x in flat if any(at[y] > at[x] for y in near(x))], flat)
        for x, t in spread(low, flat).items():
            out[x] = 2 * t + (max(away.values()) - away[x] if x in away else 0)
    return out


def test_flat_gradient(spark):
    rng = np.random.default_rng(3)
    pit = np.full((7, 9), 5.0)  # a lake that spills over its rim at its own level
    pit[0, :], pit[:, 0], pit[:, 8], pit[6, :] = 9, 9, 9, 9
    pit[6, 4] = 5
    hole = np.full((8, 8), 4.0)
    hole[0, :], hole[3, 3] = 7, np.nan
    rough = hydro.fill_array(rng.integers(1, 4, (10, 11)).astype(float))
    for z in (pit, hole, rough):
        want = brute_gradient(z)
        got = {(r.r, r.c): r.steps for r in hydro.flat_gradient(cells_of(spark, z)).where('dem_id = 0').collect()}
        assert {x: got[x] for x in want} == want and max(want.values()) > 2
        assert all(got[r, c] == 0 for r, c in got if (r, c) not in want)
    # by hand: the outlet is 2, the cell before it has 1 step from higher ground of 3 at most
    got = brute_gradient(pit)
    assert got[6, 4] == 2 and got[5, 4] == 2 * 2 + 3 - 1 and got[3, 4] == 2 * 4 + 3 - 3


def test_patches_across_tiles(spark, monkeypatch):
    """Tiles of three by three cells give the same patches as one."""
    rng = np.random.default_rng(5)
    z = rng.integers(0, 2, (11, 13)).astype(float)
    cells = cells_of(spark, z)
    want = {(r.dem_id, r.r, r.c): r.label for r in hydro.label(cells, "z").collect()}
    monkeypatch.setattr(hydro, "TILE", 3)
    assert {(r.dem_id, r.r, r.c): r.label for r in hydro.label(cells, "z").collect()} == want
    assert len(want) == 2 * z.size and len(set(want.values())) > 4
    whole = spread([(0, 0)], {(r, c) for r in range(11) for c in range(13) if z[r, c] == z[0, 0]})
    assert {x for x in want if want[x] == want[0, 0, 0]} == {(0, *x) for x in whole}


def settled(monkeypatch):
    """Counts checkpoints."""
    seen, settle = [], hydro.fx.settle
    monkeypatch.setattr(hydro.fx, "settle", lambda df: seen.append(1) or settle(df))
    return seen


def winding(n):
    """A flat one cell wide that turns at each end, with one outlet on the rim."""
    z = np.full((n, n), 9.0)
    z[1:-1:2, 1:-1] = 1
    for i in range(2, n - 2, 2):
        z[i, n - 2 if i // 2 % 2 else 1] = 1
    z[1, 0] = 1
    return z


def rough_cells(spark):
    """Grids with pits, flats, gaps and null heights, from negative rows on."""
    rng = np.random.default_rng(11)
    rows = [(f"grid {k}", r - 3, c - 5, None if rng.random() < 0.02 else Decimal(int(rng.integers(0, 5))) / 4) for k in range(5) for r in range(9) for c in range(8 + k) if rng.random() < 0.97]
    return spark.createDataFrame(rows, "dem_id string, r int, c int, z decimal(8,2)")


def table_of(df):
    out = {(r.dem_id, r.r, r.c): r[3] for r in df.collect()}
    assert len(out) == df.count()
    return out


def test_f1_a_long_flat_takes_no_rounds(spark, monkeypatch):
    z, seen = winding(13), settled(monkeypatch)
    want = brute_gradient(z)
    got = {x[1:]: s for x, s in table_of(hydro.flat_gradient(cells_of(spark, z))).items() if x[0] == 0}
    assert got == want and max(want.values()) > 60
    assert len(seen) < 5


def test_f1_tasks_and_rounds_agree(spark, monkeypatch):
    cells = rough_cells(spark)
    one, two = table_of(hydro.flat_gradient(cells)), table_of(hydro.flat_gradient(cells, raw=True))
    assert one == table_of(hydro.gradient_by_rounds(cells)) and len(one) > len(two)
    monkeypatch.setattr(hydro, "LARGEST", 75)  # most grids go by rounds
    assert table_of(hydro.flat_gradient(cells, raw=True)) == two and max(two.values()) > 4


def test_f1_grids_across_batches(monkeypatch):
    """Batches and tasks' shares that end inside grids give the rows of a single one."""
    rng = np.random.default_rng(4)
    n = 600
    g = np.sort(rng.integers(0, 6, n))
    g[100:400] = g[100]
    g.sort()
    place = np.concatenate([rng.permutation(900)[: (g == k).sum()] for k in np.unique(g)])
    t = pa.table({"dem_id": g, "r": (place // 30).astype("int32"), "c": (place % 30).astype("int32"), "z": rng.integers(0, 3, n), "dx": np.ones(n), "dy": np.ones(n)})
    want = whole.solve(t, True, False)
    for rows, batch in ((1, 7), (50, 20), (50, 600)):
        monkeypatch.setattr(whole, "ROWS", rows)
        got = list(whole.run(iter(t.to_batches(batch)), True, False))
        assert pa.Table.from_batches(got).equals(want)
    assert not list(whole.run(iter([]), True, False))


def test_f2_directions_take_no_rounds(spark, monkeypatch):
    z, seen = winding(13), settled(monkeypatch)
    got = {x[1:]: k for x, k in table_of(hydro.drained(cells_of(spark, z), square(spark, 13))).items() if x[0] == 0}
    assert len(seen) < 5
    steps = {code: (dr, dc) for code, dr, dc in grid.DIRECTIONS}
    at, way = (11, 11 if z[10, 11] == 9 else 1), 0  # from the far end to the outlet
    while at != (1, 0):
        at, way = (at[0] + steps[got[at]][0], at[1] + steps[got[at]][1]), way + 1
    assert way > 50 and got[1, 0] == 0


def test_f2_tasks_and_rounds_agree(spark, monkeypatch):
    cells = rough_cells(spark)
    # one grid has no spacing, and one row has none; widths differ by row
    space = cells.select("dem_id", "r").distinct().where("dem_id not like '%3' and r <> 2").selectExpr("dem_id", "r", "30.0D + r dx", "if(r = 0, null, 20.0D) dy")
    got = table_of(hydro.drained(cells, space, raw=True))
    monkeypatch.setattr(hydro, "LARGEST", 75)
    assert table_of(hydro.drained(cells, space, raw=True)) == got
    assert len(set(got.values())) == 9 and {x[1] for x in got if got[x]} == set(range(-3, 6)) - {0, 2}
