"""Mixing sources to target weights by the cube method.

A source with target t and size s takes every document floor(t/s) times, and once more with probability t/s minus that.
Those fractional probabilities move through the null space of the balancing constraints (token total and document total
of the source) until only a few documents are undecided. Documents are dealt to blocks by a hash within their source, so
a hot source is many blocks; each block leaves at most two undecided, which meet in fewer blocks at the next level, and
so on; the last two of a source land by the choice nearest to its token target.

Cases: a null or empty text has size 0; a null source is a source of its own, last; repeated rows are separate
documents; an empty table gives an empty table; a source whose documents are all empty has target 0. The same input gives
the same mix, in whatever order it is read: blocks and draws come from hashes, and blocks are sorted.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, keep, one_of_equals, ship

#: Documents in a block, about; bounds what one task holds.
BLOCK = 4096
#: Distinct sources that the driver plans for; more is an error, not a cut.
MOST_SOURCES = 200_000


def targets(sizes: list[int], weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0) -> list[float]:
    """The words each source gives: by weight, at most `most` times its size, the excess going to the others by weight."""
    n = len(sizes)
    w = [weights[i % len(weights)] for i in range(n)]
    pool, open_, out = share * sum(sizes), set(range(n)), [0.0] * n
    while open_:
        total = sum(w[i] for i in sorted(open_))
        over = [i for i in sorted(open_) if pool * w[i] / total > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = pool * w[i] / total
            break
        for i in over:
            out[i] = most * float(sizes[i])
            open_.discard(i)
        pool -= sum(out[i] for i in over)
    return out


def _uniform(key: np.ndarray, salt: int) -> np.ndarray:
    from .common import mix

    with np.errstate(over="ignore"):
        return mix(key + np.uint64(0x9E3779B97F4A7C15) * np.uint64(salt + 1)).astype(np.float64) / 2.0**64


def flight(p: np.ndarray, size: np.ndarray, draw: np.ndarray) -> np.ndarray:
    """Moves the probabilities until at most two are fractional, keeping their sum and their token sum.

    Three undecided units have one direction that changes neither sum: the cross product of the rows (1,1,1) and the
    sizes. A random step along it, fair in the mean, decides at least one unit.
    """
    p = p.astype(float).copy()
    eps = 1e-9
    undecided = [i for i in range(len(p)) if eps < p[i] < 1 - eps]
    live: list[int] = []
    at = 0
    while True:
        while len(live) < 3 and at < len(undecided):
            live.append(undecided[at])
            at += 1
        if len(live) < 3:
            return p
        a, b, c = live
        u = (size[c] - size[b], size[a] - size[c], size[b] - size[a])
        if u == (0, 0, 0):
            u = (1.0, -1.0, 0.0)
        up = down = np.inf
        for k, i in enumerate(live):
            if u[k] > 0:
                up, down = min(up, (1 - p[i]) / u[k]), min(down, p[i] / u[k])
            elif u[k] < 0:
                up, down = min(up, p[i] / -u[k]), min(down, (1 - p[i]) / -u[k])
        step = up if draw[a] < down / (up + down) else -down
        draw[a] = (draw[a] * 6364136.2238 + 0.4142135) % 1.0
        for k, i in enumerate(live):
            p[i] = min(1.0, max(0.0, p[i] + step * u[k]))
        live = [i for i in live if eps < p[i] < 1 - eps]


def landing(p: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Decides the last few: of all outcomes, the one whose token total is nearest to what the probabilities promise."""
    left = [i for i in range(len(p)) if 1e-9 < p[i] < 1 - 1e-9]
    goal, best = sum(p[i] * size[i] for i in left), None
    for mask in range(1 << len(left)):
        got = sum(size[i] for k, i in enumerate(left) if mask >> k & 1)
        miss = (abs(got - goal), abs(bin(mask).count("1") - sum(p[i] for i in left)), mask)
        best = min(best, miss) if best else miss
    out = p.copy()
    for k, i in enumerate(left):
        out[i] = float(best[2] >> k & 1)
    return np.round(out)


def _block(last: bool, level: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["_key", "size", "p"], kind="stable").reset_index(drop=True)
        size = pdf["size"].to_numpy(np.float64)
        p = flight(pdf["p"].to_numpy(np.float64), size, _uniform(pdf["_key"].to_numpy(np.int64).view(np.uint64), level))
        if last:
            p = landing(p, size)
        return pdf.assign(p=p)

    return run


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0, block: int = BLOCK) -> DataFrame:
    """id, source, size, source_size, target, copies, taken (words) and text_hash, one row for each row of docs."""
    size = F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long")
    sized = keep(docs.select(F.col(id_col).alias("_id"), F.col(source_col).alias("_source"), size.alias("size"), F.xxhash64(F.col(id_col), F.lit(17)).alias("_key"), F.xxhash64(F.col(text_col)).alias("_th")), "mix_sizes")
    found = sized.groupBy("_source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")).limit(MOST_SOURCES + 1).collect()
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    found.sort(key=lambda r: (r["_source"] is None, r["_source"] or ""))
    goals = targets([r["source_size"] for r in found], weights, share, most)
    plan = docs.sparkSession.createDataFrame(
        [(r["_source"], r["source_size"], float(t), int(t // r["source_size"]) if r["source_size"] else 0, min(1.0, t / r["source_size"] - t // r["source_size"]) if r["source_size"] else 0.0, max(1, -(-r["n"] // block))) for r, t in zip(found, goals)],
        "_s string, source_size long, target double, base int, p double, blocks long",
    )
    # one row a source, at most MOST_SOURCES rows: its size is checked above
    rows = sized.join(F.broadcast(plan), F.col("_source").eqNullSafe(F.col("_s"))).drop("_s")
    rows = rows.withColumn("_block", F.pmod("_key", "blocks"))
    columns = "_id, _th, _source, size, _key, source_size, target, base, p, blocks, _block".split(", ")
    schema = rows.select(columns).schema
    done, blocks, level = [], max((-(-r["n"] // block) for r in found), default=1), 0
    open_ = rows.select(columns)
    while True:
        last = blocks <= 1
        # a block of level n holds what is left of block/2 blocks of level n - 1
        flown = open_.groupBy("_source", "_block").applyInPandas(_block(last, level), schema)
        if last:
            done.append(flown)
            break
        flown = keep(flown, "mix_flight")
        fractional = (F.col("p") > 1e-9) & (F.col("p") < 1 - 1e-9)
        done.append(flown.where(~fractional))
        few = max(2, block // 2)
        open_ = flown.where(fractional).withColumns({"_block": F.floor(F.col("_block") / few).cast("long")})
        blocks, level = -(-blocks // few), level + 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    copies = (F.col("base") + F.round("p").cast("int")).cast("int")
    return out.select(F.col("_id").alias(id_col), F.col("_source").alias(source_col), "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).cast("long").alias("taken"), F.col("_th").alias("text_hash"))


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """docs with each row as often as the mix takes it; rows equal in id and text share their copies."""
    mix = mix_sources(docs, id_col, text_col, **settings)
    per = keep(mix.groupBy(F.col(id_col).alias("__i"), F.col("text_hash").alias("__h")).agg(F.sum("copies").alias("__n"), F.count("*").alias("__rows")).where("__n > 0"), "mix_copies")
    met = docs.join(per, F.col(id_col).eqNullSafe(F.col("__i")) & (F.xxhash64(F.col(text_col)) == F.col("__h")))
    return one_of_equals(met, per, "__rows", ["__i", "__h"]).withColumn("__k", F.explode(F.sequence(F.lit(1), F.col("__n").cast("int")))).select(*docs.columns)


ship(__name__)
