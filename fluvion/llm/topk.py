"""Exact top-k inner products by an impact-ordered index, score at a time.

Vectors are dealt to blocks. A block is indexed in one task: each dimension's postings (vector, component) are cut into
segments by quantised impact, the power of two below the component's magnitude; zeros have no posting. Queries stream
past the block in batches. Segments are processed by descending impact times the batch's greatest weight for their
dimension, each adding to the accumulators of its postings alone. What a vector has not yet shown has a known norm, so
a score is known up to |query| * |rest|. Processing stops once few vectors can still reach a query's k-th best lower
bound, which is the proof, or when no segment is left; the possible members are then scored exactly. Blocks give their
own top k, and the best k of all blocks are the answer. A block and its postings cross the network once, a query once
for each block.

Cases: rows without id, and vectors that are null or hold null or non-finite components, take no part; vectors of another
length than the query score over the dimensions both have; ties go to the smaller id; rows repeated with one id are
separate candidates, and only a query's own row is left out; an empty table, or one vector, gives no rows; scores are
64-bit integers and wrap beyond that.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import give_back, keep, ship

#: Vectors of a block, on average, and queries of a batch: what a task holds at once.
BLOCK, BATCH = 8192, 256


class ImpactIndex:
    """Postings of a block of vectors, by dimension and quantised impact."""

    def __init__(self, v: np.ndarray, v_row: np.ndarray, v_id: np.ndarray):
        self.v, self.row, self.id = v, v_row, v_id
        vec, dim = np.nonzero(v)
        value = v[vec, dim].astype(float)
        level = np.frexp(np.abs(value))[1]
        order = np.lexsort((vec, dim, -level))
        self.vec, self.value, level, dim = vec[order], value[order], level[order], dim[order]
        new = np.flatnonzero((np.diff(level, prepend=-1) != 0) | (np.diff(dim, prepend=-1) != 0))
        self.start, self.end = new, np.append(new[1:], len(vec))
        self.impact, self.dim = np.ldexp(1.0, level[new]), dim[new]  # no component of the segment reaches it
        self.energy = (v.astype(float) ** 2).sum(1)

    def search(self, q: np.ndarray, q_row: np.ndarray, k: int, few: float = 0.02):
        """(query, vector, score) places of each query's best k in the block, ties to the smaller id."""
        n, d = len(self.v), min(self.v.shape[1], q.shape[1])
        q, v, kk = q[:, :d], self.v[:, :d], min(k, n)
        weight = np.ascontiguousarray(q.T.astype(float))
        norm = np.sqrt((weight**2).sum(0))[None, :]
        margin = 1e-6 * np.sqrt(self.energy)  # above what rounding can add up to
        own = self.row[:, None] == q_row[None, :]
        known, rest = np.zeros((n, len(q))), self.energy.copy()
        bound = np.where(self.dim < d, self.impact * np.abs(weight).max(1, initial=0)[np.minimum(self.dim, d - 1)], 0) if d else np.zeros(len(self.dim))
        order = np.argsort(-bound, kind="stable")
        due, left, total = np.inf, float(rest.sum()), float(rest.sum())

        def can_reach():
            slack = (np.sqrt(np.maximum(rest, 0)) + margin)[:, None] * norm
            low = np.where(own, -np.inf, known - slack)
            kth = np.partition(low, n - kk, axis=0)[n - kk]
            return (known + slack >= kth) & ~own

        possible = None
        for s in order:
            if bound[s] == 0:  # no query of the batch weighs this dimension
                break
            if bound[s] <= due:
                if due < np.inf and left <= total / 4:  # with more than that open, no proof is near
                    possible = can_reach()
                    if possible.sum() <= few * possible.size + kk * len(q):
                        break
                    possible = None
                due = bound[s] / 2
            at = self.vec[self.start[s] : self.end[s]]
            value = self.value[self.start[s] : self.end[s]]
            known[at] += value[:, None] * weight[self.dim[s]]
            square = value**2
            rest[at] -= square
            left -= float(square.sum())
        else:
            s = None
        if possible is None:
            if s is None or bound[s] == 0:
                rest[:] = 0  # what is left weighs nothing
            possible = can_reach()
        vi, qi = np.nonzero(possible)
        exact_in_double = np.abs(v.astype(float)).max(initial=0) * np.abs(weight).max(initial=0) * max(d, 1) < 2.0**52
        score = np.einsum("ij,ij->i", q[qi].astype(float), v[vi].astype(float)).astype(np.int64) if exact_in_double else np.einsum("ij,ij->i", q[qi], v[vi])
        order = np.lexsort((self.row[vi], self.id[vi], -score, qi))
        qi, vi, score = qi[order], vi[order], score[order]
        top = np.arange(len(qi)) - np.searchsorted(qi, qi, "left") < k
        return qi[top], vi[top], score[top]


def _matrix(arrays: list[pa.Array]) -> np.ndarray:
    """Lists of whole numbers as rows, short ones filled with zeros."""
    lists = pa.chunked_array(arrays).combine_chunks()
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lists), int(size.max(initial=0))), np.int64)
    out[np.arange(out.shape[1]) < size[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _search(k: int, batch: int):
    names = ["query_id", "query_row", "vec_id", "vec_row", "score"]

    def run(batches):
        def parts():
            """Rows sorted by block, vectors before queries: cut where either changes, queries also into batches."""
            for b in batches:
                key = b["_block"].to_numpy() * 2 + b["_query"].to_numpy(zero_copy_only=False)
                cuts = [*np.flatnonzero(np.diff(key, prepend=-1)).tolist(), b.num_rows]
                for lo, hi in zip(cuts, cuts[1:]):
                    yield int(key[lo]), b.slice(lo, hi - lo)

        index, held, held_key, count = None, [], None, 0

        def settle():
            nonlocal index, held, count
            rows = pa.Table.from_batches(held)
            v, row, ident = _matrix(rows["_v"].chunks), rows["_row"].to_numpy(), rows["_id"].to_numpy()
            held, count = [], 0
            if held_key % 2 == 0:
                index = held_key // 2, ImpactIndex(v, row, ident)
            elif index and index[0] == held_key // 2:
                for lo in range(0, len(v), batch):
                    qi, vi, score = index[1].search(v[lo : lo + batch], row[lo : lo + batch], k)
                    qi = qi + lo
                    yield pa.record_batch([pa.array(x) for x in (ident[qi], row[qi], index[1].id[vi], index[1].row[vi], score)], names)

        for key, part in parts():
            if held and (key != held_key or (key % 2 and count >= batch)):
                yield from settle()
            held_key, count = key, count + part.num_rows
            held.append(part)
        if held:
            yield from settle()

    return lambda batches: give_back(run(batches))


def top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = 256, block: int | None = None, batch: int | None = None) -> DataFrame:
    """query_id, rank, vec_id and score of the k best for each row that is_query (a Column) picks."""
    good = F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & F.forall(F.col(vec_col), lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    ints = F.transform(F.col(vec_col), lambda x: F.floor(x.cast("double") * scale).cast("long"))
    named = vectors.where(good).select(F.col(id_col).cast("long").alias("_id"), F.coalesce(is_query, F.lit(False)).alias("_q"), ints.alias("_v"))
    rows = keep(named.withColumn("_row", F.monotonically_increasing_id()), "topk_vectors")
    blocks = max(1, -(-rows.count() // (block or BLOCK)))
    of_row = F.pmod(F.xxhash64("_row"), F.lit(blocks)).cast("long")
    indexed = rows.select(of_row.alias("_block"), F.lit(False).alias("_query"), "_id", "_row", "_v")
    # the stated query set against all rows, in blocks: every query meets every block once
    asked = rows.where("_q").select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("_block"), F.lit(True).alias("_query"), "_id", "_row", "_v")
    met = indexed.unionByName(asked).repartitionById(blocks, F.col("_block").cast("int")).sortWithinPartitions("_block", "_query", "_row")
    found = met.mapInArrow(_search(k, batch or BATCH), "query_id long, query_row long, vec_id long, vec_row long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id", "query_row").orderBy(F.col("score").desc(), F.col("vec_id"), F.col("vec_row")))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ship(__name__)
