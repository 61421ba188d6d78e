"""Whole grids in numpy: fill, flats and directions of many small grids, or of a large one, at a time. Cells are a sorted list with
the places of their neighbours, so gaps cost nothing, and heights are ranks, so that any type that sorts will do."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .grid import DIRECTIONS

#: Rows that a task solves at once, or one grid's if that has more.
ROWS = 2**16


def near_places(g: np.ndarray, r: np.ndarray, c: np.ndarray) -> np.ndarray:
    """(8, n): the places of the neighbours of n cells sorted by grid, row and column, in the order of DIRECTIONS; n where there is none."""
    n = len(g)
    new = np.r_[True, (g[1:] != g[:-1]) | (r[1:] != r[:-1])]
    row, first = np.cumsum(new) - 1, np.flatnonzero(new)
    touch = (g[first[1:]] == g[first[:-1]]) & (r[first[1:]] == r[first[:-1]] + 1)
    there = {-1: np.r_[False, touch][row], 0: np.ones(n, bool), 1: np.r_[touch, False][row]}
    width = int(c.max() - c.min()) + 3
    key = row * width + (c - c.min() + 1)
    out = np.empty((8, n), np.int32)
    for k, (_, dr, dc) in enumerate(DIRECTIONS):
        want = key + (dr * width + dc)
        at = np.minimum(np.searchsorted(key, want), n - 1)
        out[k] = np.where(there[dr] & (key[at] == want), at, n)
    return out


def fill_ranks(z: np.ndarray, near: np.ndarray) -> np.ndarray:
    """The spill level of each cell; a cell with a neighbour missing is open. Only what a round lowered is looked at in the next."""
    n = len(z)
    front = np.flatnonzero((near == n).any(0))
    w = np.full(n + 1, n, np.int32)
    w[front], w[n] = z[front], -1
    z = np.append(z, n).astype(np.int32)
    while len(front):
        to = near[:, front]
        low = np.maximum(z[to], w[front])
        better = low < w[to]
        to = to[better]
        np.minimum.at(w, to, low[better])
        front = np.unique(to)
    return w[:n]


def rings(seeds: np.ndarray, into: np.ndarray) -> np.ndarray:
    """Steps from the seeds, which are 1, along links (8, n); 0 where none leads."""
    n = into.shape[1]
    far = np.zeros(n + 1, np.int32)
    far[seeds], far[n], step = 1, 1, 1
    while len(seeds):
        to = into[:, seeds]
        seeds = np.unique(to[far[to] == 0])
        step += 1
        far[seeds] = step
    return far[:n]


def patches(level: np.ndarray) -> np.ndarray:
    """The first cell of each cell's patch, by links (8, n) of both directions."""
    n = level.shape[1]
    own = np.arange(n)
    level = np.where(level == n, own, level)
    while True:
        was = own
        low = np.minimum(own, own[level].min(0))
        own = low.copy()
        np.minimum.at(own, was, low)  # what a cell found is its label's too
        own = own[own]
        if (own == was).all():
            return own


def gradient(z: np.ndarray, near: np.ndarray) -> np.ndarray:
    """hydro.flat_gradient of ranks."""
    n = len(z)
    zn = np.append(z, -1)[near]
    flat, beside = (zn >= z).all(0), (zn > z).any(0)
    level = np.where(zn == z, near, n)
    into = np.where(np.append(flat, False)[level], level, n)
    toward = rings(np.flatnonzero(~flat & (into < n).any(0)), into)
    away = rings(np.flatnonzero(flat & beside), into)
    of = patches(level)
    height = np.zeros(n, np.int32)
    np.maximum.at(height, of, away)
    return np.where(toward > 0, 2 * toward + np.where(away > 0, height[of] - away, 0), 0).astype(np.int32)


def directions(z: np.ndarray, steps: np.ndarray, near: np.ndarray, dx: np.ndarray, dy: np.ndarray) -> np.ndarray:
    """grid.flow_direction of heights and steps. As in Spark, NaN is above any number; without a spacing (NaN) there is no direction."""
    n = len(z)
    above = lambda a, b: (a > b) | (np.isnan(a) & ~np.isnan(b))
    same = lambda a, b: (a == b) | (np.isnan(a) & np.isnan(b))
    code, most, ease = np.zeros(n, np.int32), np.zeros(n), np.zeros(n)
    for k, (name, dr, dc) in enumerate(DIRECTIONS):
        across, along = dx * dc, dy * dr
        metres = np.sqrt(across * across + along * along)
        i = np.flatnonzero((near[k] < n) & ~np.isnan(metres))
        j, m = near[k, i], metres[i]
        if (m == 0).any():
            raise ZeroDivisionError("cells without a width or height")
        down, less = np.asarray(z[i] - z[j], dtype=None if z.dtype != object else float) / m, (steps[i] - steps[j]) / m
        better = above(down, most[i]) | (same(down, most[i]) & above(less, ease[i]))  # the first of a tie stays
        i = i[better]
        code[i], most[i], ease[i] = name, down[better], less[better]
    return code


def _changes(ids: pa.ChunkedArray) -> np.ndarray:
    """True where a row's grid isn't that of the row before."""
    return np.r_[True, pc.not_equal(ids.slice(1), ids.slice(0, len(ids) - 1)).to_numpy().astype(bool)] if len(ids) else np.zeros(0, bool)


def solve(t: pa.Table, raw: bool, coded: bool) -> pa.Table:
    """Rows (dem_id, r, c, z, dx, dy), those without c being spacings, to (dem_id, r, c, steps), or (dem_id, r, c, code). raw: fill first."""
    g = np.cumsum(_changes(t["dem_id"]))
    cell = t["c"].is_valid().to_numpy()
    r = t["r"].to_numpy().astype(np.int64)
    on = np.flatnonzero(cell & t["z"].is_valid().to_numpy())
    c = t["c"].take(pa.array(on)).to_numpy().astype(np.int64)
    order = np.lexsort((c, r[on], g[on]))
    on, c = on[order], c[order]
    out = np.zeros(len(t), np.int32)
    if len(on):
        near = near_places(g[on], r[on], c)
        values, rank = np.unique(t["z"].take(pa.array(on)).to_numpy(), return_inverse=True)
        rank = rank.astype(np.int32)
        if raw:
            rank = fill_ranks(rank, near)
        out[on] = gradient(rank, near)
        if coded:
            beside = np.flatnonzero(~cell)
            width = int(r.max() - r.min()) + 1
            key = lambda i: g[i] * width + (r[i] - r.min())
            beside = np.append(beside[np.argsort(key(beside), kind="stable")], -1)
            keys = np.append(key(beside[:-1]), np.iinfo(np.int64).max)
            at = np.searchsorted(keys, key(on))
            spaced = lambda name: np.where(keys[at] == key(on), t[name].to_numpy()[beside[at]], np.nan)
            out[on] = directions(values[rank], out[on], near, spaced("dx"), spaced("dy"))
    t = t.select(["dem_id", "r", "c"]).append_column("code" if coded else "steps", pa.array(out))
    return t.filter(pa.array(cell))


def run(batches: Iterator[pa.RecordBatch], raw: bool, coded: bool) -> Iterator[pa.RecordBatch]:
    """solve over batches sorted by dem_id, some whole grids at a time."""
    held, rows = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        rows += b.num_rows
        if rows < ROWS or b["dem_id"][-1] == held[0]["dem_id"][0]:
            continue
        t = pa.Table.from_batches(held).combine_chunks()
        cut = int(np.flatnonzero(_changes(t["dem_id"]))[-1])  # the last grid may go on
        yield from solve(t.slice(0, cut), raw, coded).to_batches()
        held = t.slice(cut).to_batches()
        rows = len(t) - cut
    if rows:
        yield from solve(pa.Table.from_batches(held).combine_chunks(), raw, coded).to_batches()
