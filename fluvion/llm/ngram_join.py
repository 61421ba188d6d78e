"""N-gram Jaccard join by prefixes, in place of a token-group matrix.

Words are runs without white space, ASCII capitals lowered; a document's set is its distinct runs of five words. Two sets
meet only over a token of both prefixes, and only where length and position leave enough overlap possible; they are then
verified on the full sets. The components of the links found so far are groups: crowded runs of a token are settled in a
second pass, which skips pairs within a group. No union of a group's tokens is kept and no overlap with a group bounded.

Cases: null or empty texts, or texts of white space, have an empty set and no links; fewer than five words are one run;
copies are one set, counted once; rows may share an id, and rows without an id link like others but name no component
(null, if no member has an id); an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLOTS, WORD, count_into, forget, gather_sketch, give_back, grams, keep, levels, one_of_equals, order_key, partitions, ship, sketch_rows, small_side, word_chunks
from .setjoin import Poster, bucket_count, candidates, components, degrees, parity, unsettled, verified

WORDS = 5


def shingle_sets(texts: pa.Array, n: int = WORDS):
    """Of each text, the distinct runs of n words as sorted 64-bit hashes."""
    for lo, hi, h, row, _ in word_chunks(texts):
        edge = np.searchsorted(row, np.arange(hi - lo + 1))
        flat = grams(h, n)
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            yield np.unique(flat[a : b - n + 1] if b - a >= n else grams(h[a:b], n))


def item_of(s: np.ndarray) -> int:
    """A 64-bit name of a set, as a signed integer."""
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64))


def _sign(kind: str, n: int):
    """Texts to names, sizes and signatures of their sets (what 0), and the task's sketch (what 1)."""
    names = ["what", "_id", "_th", "item", "n", "bucket", "blob"]  # blob: signature or part of the sketch

    def run(batches):
        counts = np.zeros(SLOTS, np.uint32)
        for b in batches:
            items, sizes, signs, held = [], [], [], []
            for s in shingle_sets(b["_t"], n):
                items.append(item_of(s) if len(s) else None)
                sizes.append(len(s))
                signs.append(parity(s) if len(s) else None)
                held.append(s)
                if len(held) == 500:
                    count_into(counts, np.concatenate(held))
                    held = []
            if held:
                count_into(counts, np.concatenate(held))
            m = len(items)
            yield pa.record_batch([pa.array(np.zeros(m, np.int32)), b["_id"], b["_th"], pa.array(items, pa.int64()), pa.array(sizes, pa.int64()), pa.nulls(m, pa.int64()), pa.array(signs, pa.binary())], names)
        for seg, blob in sketch_rows(counts):
            yield pa.record_batch([pa.array([1], pa.int32()), pa.nulls(1, pa.int64() if kind == "bigint" else pa.int32() if kind == "int" else pa.string()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([seg], pa.int64()), pa.array([blob])], names)

    return lambda batches: give_back(run(batches))


def _post(level, n: int, buckets: int):
    def run(batches):
        poster = Poster(buckets)
        for b in batches:
            rows = []
            for s in shingle_sets(b["_t"], n):
                if len(s):
                    rows += poster.add(item_of(s), 0, 0, np.sort(order_key(s, level.value)))
            if rows:
                yield pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows])], ["bucket", "blob"])
        rows = list(poster.flush())
        if rows:
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows])], ["bucket", "blob"])

    return lambda batches: give_back(run(batches))


def _sets(n: int):
    def run(batches):
        for b in batches:
            items, sets = [], []
            for s in shingle_sets(b["_t"], n):
                items.append(item_of(s) if len(s) else None)
                sets.append(s.tobytes())
                if len(items) == 1000:
                    yield pa.record_batch([pa.array(items, pa.int64()), pa.array(sets)], ["item", "set"])
                    items, sets = [], []
            if items:
                yield pa.record_batch([pa.array(items, pa.int64()), pa.array(sets)], ["item", "set"])

    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, count_links: bool = True) -> DataFrame:
    """One row for each row of docs: id, n_shingles, item (name of its set), n_links (of the set, to other
    sets; null unless counted), component_id, part (name of the component) and text_hash."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"))
    signed = keep(base.withColumn("_th", F.xxhash64("_t")).mapInArrow(_sign(kind, words), f"what int, _id {kind}, _th long, item long, n long, bucket long, blob binary"), "ngram_sets", "what")
    rows = signed.where("what = 0").select("_id", "_th", "item", "n")
    counts = gather_sketch(signed.where("what = 1"))
    buckets = bucket_count(int(counts.sum(dtype=np.int64)), spark)
    level = spark.sparkContext.broadcast(levels(counts))  # fixed size: one byte for each of SLOTS counters
    pairs, found = candidates(base.mapInArrow(_post(level, words, buckets), "bucket long, blob binary"), buckets)
    one = rows.where("item is not null").groupBy("item").agg(F.min("_id").alias("_r"))

    def sets(items: DataFrame) -> DataFrame:
        picked = small_side(keep(one.join(items, "item", "left_semi").select("_r").distinct(), "ngram_wanted"))
        texts = base.join(picked, base["_id"].eqNullSafe(picked["_r"])).select("_t")
        wanted = texts.mapInArrow(_sets(words), "item long, set binary").where("item is not null")
        return wanted.join(items, "item", "left_semi")

    links = verified(pairs, sets)
    parts = components(links)
    signatures = signed.where("what = 0 and item is not null").select("item", F.col("blob").alias("sig"))
    more = verified(unsettled(found, parts, signatures), sets)
    links = links.unionAll(more)
    parts = keep(components(links), "ngram_parts")
    forget(found)
    # the joins verify only the links that components need
    if count_links:
        sizes = rows.where("item is not null").groupBy("item").agg(F.first("n").alias("n"))
        degree = degrees(links, parts, sizes, sets)
    else:
        degree = parts.select("item", F.lit(None).cast("long").alias("n_links"))
    named = one.join(parts, "item", "left").select("item", "_r", F.coalesce("part", "item").alias("part"))
    least = named.groupBy("part").agg(F.min("_r").alias("least"))
    member = named.join(least, "part").join(degree, "item", "left").select(F.col("item").alias("_i"), "least", "part", "n_links")
    n_links = F.coalesce("n_links", F.lit(0)).cast("long") if count_links else F.col("n_links")
    out = rows.join(member, rows["item"] == member["_i"], "left")
    return out.select(F.col("_id").alias(id_col), F.col("n").alias("n_shingles"), "item", n_links.alias("n_links"), F.when(F.col("item").isNull(), F.col("_id")).otherwise(F.col("least")).alias("component_id"), "part", F.col("_th").alias("text_hash"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """docs with one row of each group of near duplicates, that with the least id; rows without words all stay."""
    found = near_duplicates(docs, id_col, text_col, words, count_links=False)
    least = found.where("part is not null").groupBy("part", id_col, "text_hash").agg(F.count("*").alias("n")).groupBy("part").agg(F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("i"), F.col("text_hash").alias("h"), F.col("n"))).alias("m"))
    stays = keep(least.select(F.col("m.i").alias("__i"), F.col("m.h").alias("__h"), F.col("m.n").alias("__rows")), "ngram_stays")
    empty = ~F.coalesce(F.col(text_col), F.lit("")).rlike(WORD)
    met = docs.join(stays, F.col(id_col).eqNullSafe(F.col("__i")) & (F.xxhash64(F.col(text_col)) == F.col("__h")), "left").where(empty | F.col("__h").isNotNull())
    met = met.withColumn("__rows", F.coalesce("__rows", F.lit(1)))
    return one_of_equals(met, stays, "__rows", ["__i", "__h"]).select(*docs.columns)


ship(__name__)
