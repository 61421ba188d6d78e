"""Line dedup by an exact set-similarity join.

A line's set is its distinct words, ASCII capitals lowered. Words are ordered by rarity (a sketch of fixed size counts
them over all lines), prefixes are posted, pairs pass the length, positional and bitmap filters, and Jaccard is verified
on the full sets. A line goes if an earlier line (by document id, then line number) reaches the similarity, whether or
not that one stays. Lines with equal sets are one item, so a very common line is one entry a task.

Cases: null texts stay null; lines without words stay; rows that repeat an id and text are one place, so the first of
equal lines within a place stays in each; different texts under one id are places of their own, in the order of their
hashes; a null id is later than every other; an empty table gives an empty table; other columns are not read, and
documents of which every line goes keep an empty text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLOTS, count_into, forget, gather_sketch, give_back, keep, levels, mix, order_key, partitions, ship, sketch_rows, small_side, sorted_within, word_chunks
from .setjoin import DEN, ENTRY, LONG_SET, NUM, SHORT_SET, Poster, bucket_count, candidates, unsettled_later, verified

LAST = 2**63 - 1


def line_sets(texts: pa.Array):
    """Portions of all lines with words: row, line number, size, and start in the flat array of distinct word hashes; that
    array, and the line of each hash."""
    for lo, _, h, row, line in word_chunks(texts):
        first = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (line[1:] != line[:-1])]) if len(h) else np.zeros(0, np.int64)
        own = np.repeat(np.arange(len(first)), np.diff(np.r_[first, len(h)]))
        h = h[sorted_within(own, h)]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (own[1:] != own[:-1])
        h, own = h[new], own[new]
        n = np.bincount(own, minlength=len(first)).astype(np.int64)
        start = np.r_[0, np.cumsum(n)[:-1]].astype(np.int64) if len(n) else n
        yield row[first] + lo, line[first].astype(np.int64), n, start, h, own


def item_names(h: np.ndarray, n: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A 64-bit name for each set: the sum of its mixed hashes, mixed with its size; order plays no part."""
    if not len(n):
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        return mix(np.add.reduceat(mix(h + np.uint64(0x51)), start) + n.astype(np.uint64)).view(np.int64)


def _sign(batches):
    names = ["what", "doc", "th", "line", "item", "bucket", "blob"]
    counts = np.zeros(SLOTS, np.uint32)
    for b in batches:
        ids, prints = b["_id"].to_numpy(), b["_th"].to_numpy()
        lines_of = np.zeros(len(ids), np.int64)
        for row, number, n, start, h, _ in line_sets(b["_t"]):
            count_into(counts, h)
            m = len(row)
            np.add.at(lines_of, row, 1)
            yield pa.record_batch([pa.array(np.zeros(m, np.int32)), pa.array(ids[row]), pa.array(prints[row]), pa.array(number), pa.array(item_names(h, n, start)), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary())], names)
        # how many lines of each text have words
        some = np.flatnonzero(lines_of)
        m = len(some)
        yield pa.record_batch([pa.array(np.full(m, 2, np.int32)), pa.array(ids[some]), pa.array(prints[some]), pa.array(lines_of[some]), pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.binary())], names)
    for seg, blob in sketch_rows(counts):
        yield pa.record_batch([pa.array([1], pa.int32()), *[pa.nulls(1, pa.int64())] * 4, pa.array([seg], pa.int64()), pa.array([blob])], names)


def _post(level, buckets: int):
    def run(batches):
        poster = Poster(buckets)

        def out(rows):
            rows = list(rows)
            if rows:
                yield pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows])], ["bucket", "blob"])

        for b in batches:
            ids = b["_id"].to_numpy()
            for row, number, n, start, h, line in line_sets(b["_t"]):
                if not len(n):
                    continue
                doc = ids[row]
                item = item_names(h, n, start)
                word, part = np.uint64(1) << ((h >> np.uint64(56)) & np.uint64(63)), (h >> np.uint64(62)).astype(np.int8)
                sig = [np.bitwise_xor.reduceat(np.where(part == k, word, np.uint64(0)), start) for k in range(4)]
                for k, to, most in ((2, 0, LONG_SET), (3, 1, LONG_SET), (1, 0, SHORT_SET)):
                    sig[to] = np.where(n <= most, sig[to] ^ sig[k], sig[to])
                    sig[k] = np.where(n <= most, np.uint64(0), sig[k])
                key = order_key(h, level.value)
                key = key[sorted_within(line, key)]  # lines keep their places, tokens of a line now stand by rarity
                pos = np.arange(len(key)) - start[line]
                _, first = np.unique(item, return_index=True)
                fresh = np.zeros(len(n), bool)
                fresh[[i for i in first.tolist() if item[i] not in poster.seen]] = True
                poster.seen.update(item[fresh].tolist())
                take = (pos < (n - -(-NUM * n // DEN) + 1)[line]) & fresh[line]
                at = line[take]
                columns = [key[take], item[at], doc[at], number[at], n[at], pos[take], *[x[at] for x in sig]]
                yield from out(poster.extend([c.astype(t, copy=False) for c, t in zip(columns, ENTRY)]))
        yield from out(poster.flush())

    return lambda batches: give_back(run(batches))


def _line_sets_of(batches):
    """Sets of the wanted lines of each text."""
    for b in batches:
        wanted = [set(x) for x in b["lines"].to_pylist()]
        for row, number, n, start, h, _ in line_sets(b["_t"]):
            item = item_names(h, n, start)
            pick = [k for k, (r, i) in enumerate(zip(row.tolist(), number.tolist())) if i in wanted[r]]
            yield pa.record_batch([pa.array(item[pick]), pa.array([h[start[k] : start[k] + n[k]].tobytes() for k in pick], pa.binary())], ["item", "set"])


def _places(docs: DataFrame, id_col: str, text_col: str) -> list[F.Column]:
    """What a row's place is: its id, nulls last, and a hash of its text."""
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)), F.xxhash64(F.col(text_col))]


def find_duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, th, lines, n_lines): for each document id (nulls as LAST) and hash of its text, if that has words, the sorted numbers of
    the lines that go, and how many lines have words."""
    spark = docs.sparkSession
    doc, th = _places(docs, id_col, text_col)
    base = docs.select(doc.alias("_id"), th.alias("_th"), F.col(text_col).alias("_t"))
    signed = keep(base.mapInArrow(_sign, "what int, doc long, th long, line long, item long, bucket long, blob binary"), "line_sets", "what")
    lines = signed.where("what = 0").select("doc", "th", "line", "item")
    counts = gather_sketch(signed.where("what = 1"))
    tokens, level = int(counts.sum(dtype=np.int64)), spark.sparkContext.broadcast(levels(counts))  # one byte for each of SLOTS counters
    first = lines.groupBy("item").agg(F.min(F.struct("doc", "line", "th")).alias("f"), F.count("*").alias("n"))
    first = keep(first.select("item", F.col("f.doc").alias("first_doc"), F.col("f.line").alias("first_line"), F.col("f.th").alias("first_th"), "n"), "line_items")
    buckets = bucket_count(tokens, spark)
    pairs, found = candidates(base.mapInArrow(_post(level, buckets), "bucket long, blob binary"), buckets, True)

    def sets(items: DataFrame) -> DataFrame:
        items = small_side(keep(items, "line_items_met"))
        places = first.join(items, "item", "left_semi").groupBy("first_doc", "first_th").agg(F.collect_set("first_line").alias("lines"))
        picked = small_side(keep(places, "line_wanted"), F.size("lines"))
        texts = base.join(picked, (base["_id"] == F.col("first_doc")) & (base["_th"] == F.col("first_th"))).select("_t", "lines")
        return texts.mapInArrow(_line_sets_of, "item long, set binary").join(items, "item", "left_semi")

    def later(links: DataFrame) -> DataFrame:
        """Of each verified pair, the item whose first line is the later one."""
        links = small_side(links)
        place = F.struct("first_doc", "first_line", "first_th", "item").alias("at")
        side = lambda k: first.select("item", place).join(links, F.col("item") == F.col(k)).select("a", "b", "at")
        met = side("a").unionAll(side("b")).groupBy("a", "b").agg(F.max("at").alias("at"))
        return met.select(F.col("at.item").alias("item")).distinct()

    links = verified(pairs, sets)
    gone = keep(later(links), "lines_gone")
    owed = unsettled_later(found, gone)
    if owed is not None:
        gone = keep(gone.unionAll(later(verified(owed, sets))).distinct(), "lines_gone")
    forget(links, found)
    # of items with one line that stays there is nothing to tell
    gone = small_side(gone)
    fate = first.join(gone.withColumn("gone", F.lit(True)), "item", "left").where("gone or n > 1")
    fate = fate.select(F.col("item").alias("_i"), "first_doc", "first_line", "first_th", F.coalesce("gone", F.lit(False)).alias("gone"), "n")
    # items that fill more than a quarter of an average task are dealt to several; there are at most four a task
    share = max(1000, lines.count() // (4 * partitions(spark)))
    hot = F.broadcast(first.where(F.col("n") > share).select(F.col("item").alias("_h"), F.ceil(F.col("n") / share).cast("int").alias("_s")))
    salted = lines.join(hot, F.col("item") == F.col("_h"), "left").withColumn("_k", F.pmod(F.xxhash64("doc", "th", "line"), F.coalesce("_s", F.lit(1))).cast("int"))
    spread = F.when(F.col("n") > share, F.ceil(F.col("n") / share).cast("int")).otherwise(1)
    fate = fate.withColumn("_f", F.explode(F.sequence(F.lit(0), spread - 1))).drop("n")
    met = salted.join(fate, (F.col("item") == F.col("_i")) & (F.col("_k") == F.col("_f")))
    goes = F.col("gone") | (F.col("doc") != F.col("first_doc")) | (F.col("line") != F.col("first_line")) | (F.col("th") != F.col("first_th"))
    removed = met.where(goes).groupBy("doc", "th").agg(F.sort_array(F.collect_set("line")).alias("lines"))
    many = signed.where("what = 2").groupBy("doc", "th").agg(F.max("line").alias("n_lines"))
    out = many.join(removed, ["doc", "th"], "left").select("doc", "th", F.coalesce("lines", F.array().cast("array<long>")).alias("lines"), "n_lines")
    out._holds = [signed, first]
    return out


def with_lines(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of docs with __lines and __n, what find_duplicate_lines says of its place, or nulls."""
    doc, th = _places(docs, id_col, text_col)
    found = found.select(F.col("doc").alias("__doc"), F.col("th").alias("__th"), F.col("lines").alias("__lines"), F.col("n_lines").alias("__n"))
    placed = docs.withColumns({"__d": doc, "__t": th})  # as columns, so that a text no one asks for isn't dealt
    return placed.join(found, (F.col("__d") == F.col("__doc")) & (F.col("__t") == F.col("__th")), "left").drop("__doc", "__th", "__d", "__t")


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with the text that stays, every other column as it was."""
    every = find_duplicate_lines(docs, id_col, text_col)
    found = keep(every.where(F.size("lines") > 0), "lines_of")
    forget(*every._holds)
    met = with_lines(docs, found, id_col, text_col)
    kept = F.array_join(F.filter(F.split(F.col(text_col), "\n", -1), lambda x, i: ~F.array_contains("__lines", i.cast("long"))), "\n")
    return met.withColumn(text_col, F.when(F.col("__lines").isNull(), F.col(text_col)).otherwise(kept)).select(*docs.columns)


ship(__name__)
