"""Iteration over DataFrames: each round is checkpointed into the folder that all executors share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def settle(df: DataFrame) -> DataFrame:
    """Cuts lineage with checkpoint(); sets a local folder only where spark.checkpoint.dir is unset and Spark is local."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        where = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not where:
            if not sc.master.startswith("local["):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            where = tempfile.mkdtemp(prefix="fluvion-ck-")
            atexit.register(shutil.rmtree, where, True)
        sc.setCheckpointDir(where)
    return df.checkpoint()


def fixpoint(df: DataFrame, step: Callable[[DataFrame], DataFrame], measure) -> DataFrame:
    """Applies step until measure (an aggregate Column) stops changing; steps must only ever move one way."""
    df = settle(df)
    was = df.agg(measure.alias("m")).first()["m"]
    while True:
        df = settle(step(df))
        now = df.agg(measure.alias("m")).first()["m"]
        if now == was:
            return df
        was = now


def _reset(nodes: DataFrame) -> DataFrame:
    """nodes (id, down, w) to (id, jump, total); sums of integers are long."""
    whole = nodes.schema["w"].dataType.typeName() in ("byte", "short", "integer", "long")
    return settle(nodes.select("id", F.col("down").alias("jump"), F.col("w").cast("long" if whole else "double").alias("total")))


def _ends(state: DataFrame) -> bool:
    return not state.where("jump is not null").limit(1).count()


def on_cycles(nodes: DataFrame) -> DataFrame:
    """(id) of the nodes on cycles: where any way down of at least as many steps as there are nodes ends."""
    state = settle(nodes.select("id", F.col("down").alias("jump")))
    for _ in range(state.count().bit_length() + 1):
        if _ends(state):
            break
        ahead = state.select(F.col("id").alias("_a"), F.col("jump").alias("next"))
        state = settle(state.join(ahead, F.col("jump") == F.col("_a"), "left").select("id", F.col("next").alias("jump")))
    return settle(state.where("jump is not null").select(F.col("jump").alias("id")).distinct())


def cut_cycles(nodes: DataFrame) -> DataFrame:
    """nodes whose cycles are cut loose: a node on one drains nowhere."""
    loop = on_cycles(nodes).select(F.col("id").alias("_c"))
    return nodes.join(loop, F.col("id") == F.col("_c"), "left").withColumn("down", F.when(F.col("_c").isNull(), F.col("down"))).drop("_c")


def accumulate(nodes: DataFrame) -> DataFrame:
    """(id, down, w) to (id, total): w summed over everything upstream, itself included, in log2(depth) joins.

    S[k+1](c) = S[k](c) + sum of S[k](u) over u whose 2^k-th node downstream is c. Nodes on cycles are cut loose first.
    """
    state = _reset(nodes)
    for _ in range(state.count().bit_length() + 1):  # a longer way down than there are nodes is a cycle
        if _ends(state):
            return state.select("id", "total")
        sent = state.where("jump is not null").groupBy(F.col("jump").alias("_j")).agg(F.sum("total").alias("more"))
        ahead = state.select(F.col("id").alias("_a"), F.col("jump").alias("next"))
        state = settle(
            state.join(sent, F.col("id") == F.col("_j"), "left").join(ahead, F.col("jump") == F.col("_a"), "left").select("id", F.col("next").alias("jump"), (F.col("total") + F.coalesce("more", F.lit(0))).alias("total"))
        )
    return accumulate(cut_cycles(nodes))


def path_sums(nodes: DataFrame) -> DataFrame:
    """(id, down, w) to (id, root, depth, total): on the way to the outlet its end, how many steps there are, and w summed over
    all nodes but the end. Nodes on cycles are cut loose first."""
    state = _reset(nodes).withColumns({"root": F.coalesce("jump", "id"), "depth": F.when(F.col("jump").isNull(), 0).otherwise(1), "total": F.when(F.col("jump").isNull(), F.col("total") * 0).otherwise(F.col("total"))})
    for _ in range(state.count().bit_length() + 1):
        if _ends(state):
            return state.select("id", "root", "depth", "total")
        ahead = state.select(F.col("id").alias("_a"), F.col("jump").alias("next"), F.col("root").alias("r2"), F.col("depth").alias("d2"), F.col("total").alias("t2"))
        met = state.join(ahead, F.col("jump") == F.col("_a"), "left")
        state = settle(met.select("id", F.col("next").alias("jump"), (F.col("total") + F.coalesce("t2", F.lit(0))).alias("total"), F.coalesce("r2", "root").alias("root"), (F.col("depth") + F.coalesce("d2", F.lit(0))).alias("depth")))
    return path_sums(cut_cycles(nodes))


def depth(nodes: DataFrame) -> DataFrame:
    """(id, down) to (id, depth, root): steps to the outlet and the outlet itself, by doubling."""
    return path_sums(nodes.withColumn("w", F.lit(0))).select("id", "depth", "root")


def downstream_closure(start: DataFrame, nodes: DataFrame) -> DataFrame:
    """start (id) and everything below, by doubling the jumps: (id). Cycles do no harm: after log2(nodes) rounds all is reached."""
    reached, jumps = settle(start.select("id").distinct()), settle(nodes.where("down is not null").select("id", "down"))
    for _ in range(nodes.count().bit_length() + 1):
        reached = settle(reached.unionAll(reached.join(jumps, "id").select(F.col("down").alias("id"))).distinct())
        if not jumps.limit(1).count():
            break
        ahead = jumps.select(F.col("id").alias("_a"), F.col("down").alias("next"))
        jumps = settle(jumps.join(ahead, F.col("down") == F.col("_a")).select("id", F.col("next").alias("down")))
    return reached


def components(edges: DataFrame) -> DataFrame:
    """(a, b) undirected, with (a, a) for lone nodes, to (id, label): the least id of each component; label passing and jumping."""
    both = settle(edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.first("a")).alias("label"))

    def step(s: DataFrame) -> DataFrame:
        near = both.join(s, both["b"] == s["id"]).groupBy(F.col("a").alias("id")).agg(F.min("label").alias("label"))
        own = s.select("id", F.col("label").alias("old"))
        low = near.join(own, "id").select("id", F.least("label", "old").alias("label"))
        jump = low.select(F.col("id").alias("_j"), F.col("label").alias("far"))
        return low.join(jump, low["label"] == jump["_j"], "left").select("id", F.least("label", "far").alias("label"))

    return fixpoint(label, step, F.bit_xor(F.xxhash64("id", "label")))
