"""Repeated passages by sparse suffix arrays.

Of a text's suffixes only those stay that start at a minimiser: the least hash of eight words among the starts in each
window of the least passage length. Content selects them, so two copies of a passage keep the same suffixes. Suffixes are
dealt by the hash of their first words and sorted; those with an equal neighbour are matches to extend. They are extended
left and right to every window of the least length around them, windows are sorted again by content, and neighbours that
agree are repeats; unions of agreeing windows are the maximal passages. (Comparing a suffix with its sorted neighbours
alone would lose passages whose best partner to the left isn't the best one to the right; windows lose none.)

A task sorts what it has before sending it: of windows that agree within a task, one is sent and the others are known to
be later repeats, so a very common passage is one entry a task.

Cases: null or short texts have no passages; a document's own repeats count; rows that repeat an id and text are one
place; different texts under one id are places of their own, in the order of their hashes; a null id is later than every
other; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, grams, keep, mix, pack, partitions, ship, unpack, word_chunks

#: Least passage, in words; words of a suffix that are hashed to choose and sort it.
LEAST, PREFIX = 50, 8
#: Bits of the filter for suffixes that have an equal neighbour: 8 MB, whatever the input; a fuller one only extends more.
FILTER_BITS, FILTER_SEGMENTS = 1 << 26, 64
FLUSH = 500_000
LAST = 2**63 - 1


def text_hashes(texts: pa.Array):
    """The word hashes of each text."""
    for lo, hi, h, row, _ in word_chunks(texts):
        edge = np.searchsorted(row, np.arange(hi - lo + 1))
        for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
            yield h[a:b]


def minimisers(g: np.ndarray, width: int) -> np.ndarray:
    """For each window of `width` starts, the place of the least hash, the leftmost if equal."""
    if len(g) < width:
        return np.zeros(0, np.int64)
    view = np.lib.stride_tricks.sliding_window_view(g, width)
    return np.concatenate([view[k : k + 4096].argmin(axis=1) + np.arange(k, min(k + 4096, len(view))) for k in range(0, len(view), 4096)])


def window_prints(h: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit print of each run of n words, mixed from prints of 1, 2, 4 and more words."""
    many = len(h) - n + 1
    out, at, power = np.zeros(many, np.uint64), 0, h
    with np.errstate(over="ignore"):
        for k in range(n.bit_length()):
            if n >> k & 1:
                out = mix(out * np.uint64(0x9E3779B97F4A7C15) + power[at : at + many] + np.uint64(k + 1))
                at += 1 << k
            power = mix(power[: len(power) - (1 << k)] * np.uint64(0xD1B54A32D192ED03) + power[1 << k :] + np.uint64(k + 101)) if len(power) > 1 << k else power[:0]
    return out


def _deal(bucket: np.ndarray, *columns: np.ndarray):
    """Arrays sorted by bucket as packed blobs."""
    cut = np.flatnonzero(np.diff(bucket)) + 1
    if len(bucket):
        for lo, hi in zip([0, *cut], [*cut, len(bucket)]):
            yield int(bucket[lo]), pack(*[c[lo:hi] for c in columns])


def _batch(rows: list[tuple], kind: int | None = None):
    columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())]
    names = ["bucket", "blob"]
    if kind is not None:
        columns, names = [pa.array([kind] * len(rows), pa.int32()), *columns], ["kind", *names]
    return pa.record_batch(columns, names)


def _suffixes(buckets: int, least: int, prefix: int):
    """First pass: hashes of the retained suffixes, each with how often the task has it."""

    def run(batches):
        held, size = [], 0

        def flush():
            h, n = np.unique(np.concatenate(held), return_counts=True)
            bucket = (mix(h) % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            return list(_deal(bucket[order], h[order], np.minimum(n, 2)[order].astype("<u1")))

        for b in batches:
            for h in text_hashes(b["_t"]):
                if len(h) >= least:
                    g = grams(h, prefix)
                    held.append(g[np.unique(minimisers(g, least - prefix + 1))])
                    size += len(held[-1])
            if size > FLUSH:
                yield _batch(flush())
                held, size = [], 0
        if held:
            yield _batch(flush())

    return run


def _places(h: np.ndarray) -> np.ndarray:
    """Three bits of the filter for each hash."""
    with np.errstate(over="ignore"):
        return np.stack([(mix(h + np.uint64(k * 0x51ED27)) % np.uint64(FILTER_BITS)).astype(np.int64) for k in (1, 2, 3)])


def _repeated(batches):
    """Suffixes with an equal neighbour, as bits of the filter."""
    held: dict[int, list] = {}
    for b in batches:
        for k, x in zip(b["bucket"].to_pylist(), b["blob"].to_pylist()):
            held.setdefault(k, []).append(unpack(x, "<u8", "<u1"))
    per = FILTER_BITS // FILTER_SEGMENTS
    bits = []
    for parts in held.values():
        h, n = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        order = np.argsort(h, kind="stable")
        h, n = h[order], n[order]
        new = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
        many = np.add.reduceat(n.astype(np.int64), new) if len(h) else new
        bits.append(_places(h[new][many > 1]).reshape(-1))
    if bits:
        places = np.unique(np.concatenate(bits))
        cut = np.searchsorted(places, np.arange(FILTER_SEGMENTS + 1) * per)
        yield _batch([(s, pack((places[cut[s] : cut[s + 1]] - s * per).astype("<u4"))) for s in range(FILTER_SEGMENTS) if cut[s + 1] > cut[s]])


def _merge_bits(batches):
    per, held = FILTER_BITS // FILTER_SEGMENTS, {}
    for b in batches:
        for s, x in zip(b["bucket"].to_pylist(), b["blob"].to_pylist()):
            held.setdefault(s, np.zeros(per, bool))[unpack(x, "<u4")[0]] = True
    yield _batch([(s, np.packbits(v).tobytes()) for s, v in held.items()])


def _by_print(fp: np.ndarray, doc: np.ndarray, th: np.ndarray, at: np.ndarray):
    """Sorted by print and place, places once; first: the first of each print."""
    order = np.lexsort((at, th, doc, fp))
    fp, doc, th, at = fp[order], doc[order], th[order], at[order]
    once = np.r_[True, (fp[1:] != fp[:-1]) | (doc[1:] != doc[:-1]) | (th[1:] != th[:-1]) | (at[1:] != at[:-1])] if len(fp) else np.zeros(0, bool)
    fp, doc, th, at = fp[once], doc[once], th[once], at[once]
    return fp, doc, th, at, np.r_[True, fp[1:] != fp[:-1]] if len(fp) else once


def _windows(filter_, buckets: int, least: int, prefix: int):
    """Second pass: prints of the windows around suffixes that the filter has (kind 0), and repeats seen in the task (kind 1)."""

    def run(batches):
        bits = filter_.value
        held, size = [], 0

        def flush():
            fp, doc, th, at, first = _by_print(*[np.concatenate([x[k] for x in held]) for k in range(4)])
            again = np.zeros(len(fp), bool)  # windows of which the task has another
            again[:-1] |= ~first[1:]
            bucket = (mix(fp) % np.uint64(buckets)).astype(np.int64)
            pick = np.flatnonzero(first)
            pick = pick[np.argsort(bucket[pick], kind="stable")]
            sent = _batch(list(_deal(bucket[pick], fp[pick], doc[pick], th[pick], at[pick], again[pick].astype("<u1"))), 0)
            late = _batch(list(_reply(doc[~first], th[~first], at[~first], np.ones((~first).sum(), "<u1"), buckets)), 1)
            return sent, late

        for b in batches:
            for i, p_, h in zip(b["_id"].to_pylist(), b["_th"].to_pylist(), text_hashes(b["_t"])):
                if len(h) < least:
                    continue
                g = grams(h, prefix)
                chosen = minimisers(g, least - prefix + 1)
                some = np.unique(chosen)
                ok = np.zeros(len(g), bool)
                p = _places(g[some])
                ok[some] = ((bits[p >> 3] >> (7 - (p & 7)).astype(np.uint8)) & 1).all(axis=0)
                at = np.flatnonzero(ok[chosen])
                if len(at):
                    held.append((window_prints(h, least)[at], np.full(len(at), i, "<i8"), np.full(len(at), p_, "<i8"), at.astype("<u4")))
                    size += len(at)
            if size > FLUSH:
                yield from flush()
                held, size = [], 0
        if held:
            yield from flush()

    return run


def _reply(doc, th, at, late, buckets: int):
    bucket = (mix(doc.view("<u8") ^ th.view("<u8")) % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((at, th, doc, bucket))
    return _deal(bucket[order], doc[order], th[order], at[order], late[order])


def _agree(buckets: int):
    """Windows that have an equal neighbour, dealt by document; late 1 for all but the first of each print."""

    def run(batches):
        held: dict[int, list] = {}
        for b in batches:
            for k, x in zip(b["bucket"].to_pylist(), b["blob"].to_pylist()):
                held.setdefault(k, []).append(unpack(x, "<u8", "<i8", "<i8", "<u4", "<u1"))
        found = []
        for parts in held.values():
            fp, doc, th, at, again = (np.concatenate([p[k] for p in parts]) for k in range(5))
            order = np.lexsort((at, th, doc, fp))
            fp, doc, th, at, again = fp[order], doc[order], th[order], at[order], again[order].astype(bool)
            first = np.r_[True, fp[1:] != fp[:-1]]
            same = np.r_[~first[1:], False] | ~first | again
            found.append((doc[same], th[same], at[same], (~first[same]).astype("<u1")))
        if found:
            yield _batch(list(_reply(*[np.concatenate([f[k] for f in found]) for k in range(4)], buckets)))

    return run


def _union(at: np.ndarray, least: int) -> list[list[int]]:
    """Maximal runs of words that windows starting at the sorted places cover."""
    out: list[list[int]] = []
    if len(at):
        cut = np.flatnonzero(np.diff(at) > least) + 1
        for lo, hi in zip([0, *cut], [*cut, len(at)]):
            out.append([int(at[lo]), int(at[hi - 1]) + least])
    return out


def _passages(least: int):
    def run(batches):
        held: dict[int, list] = {}
        for b in batches:
            for k, x in zip(b["bucket"].to_pylist(), b["blob"].to_pylist()):
                held.setdefault(k, []).append(unpack(x, "<i8", "<i8", "<u4", "<u1"))
        for parts in held.values():
            doc, th, at, late = (np.concatenate([p[k] for p in parts]) for k in range(4))
            at = at.astype(np.int64)
            order = np.lexsort((at, th, doc))
            doc, th, at, late = doc[order], th[order], at[order], late[order]
            edge = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (th[1:] != th[:-1]), True])
            rows = [(int(doc[lo]), int(th[lo]), _union(np.unique(at[lo:hi]), least), _union(np.unique(at[lo:hi][late[lo:hi] > 0]), least)) for lo, hi in zip(edge[:-1], edge[1:])]
            spans = pa.list_(pa.list_(pa.int64()))
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], spans), pa.array([r[3] for r in rows], spans)], ["doc", "th", "repeated", "removed"])

    return run


def _place(id_col: str, text_col: str) -> list[F.Column]:
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(LAST)).alias("_id"), F.xxhash64(F.col(text_col)).alias("_th")]


def with_passages(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of docs with the spans found for its place, or nulls."""
    doc, th = _place(id_col, text_col)
    found = found.select(F.col("doc").alias("__doc"), F.col("th").alias("__th"), F.col("repeated").alias("__repeated"), F.col("removed").alias("__removed"))
    placed = docs.withColumns({"__d": doc, "__t": th})  # as columns, so that a text no one asks for isn't dealt
    return placed.join(found, (F.col("__d") == F.col("__doc")) & (F.col("__t") == F.col("__th")), "left").drop("__doc", "__th", "__d", "__t")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, prefix: int = PREFIX) -> DataFrame:
    """(doc, th, repeated, removed): for each document id (nulls as LAST) and hash of its text, the word spans of passages that repeat
    anywhere, and of those with an earlier occurrence; no row where there are none."""
    spark = docs.sparkSession
    n = partitions(spark)
    buckets = 3 * n
    base = docs.select(*_place(id_col, text_col), F.col(text_col).alias("_t"))
    schema = "bucket long, blob binary"
    sent = base.select("_t").mapInArrow(_suffixes(buckets, least, prefix), schema)
    bits = sent.repartition(n, "bucket").mapInArrow(_repeated, schema)
    got = bits.repartition(FILTER_SEGMENTS, "bucket").mapInArrow(_merge_bits, schema).collect()  # FILTER_BITS bits in all
    whole = np.zeros((FILTER_SEGMENTS, FILTER_BITS // FILTER_SEGMENTS // 8), np.uint8)
    for r in got:
        whole[r["bucket"]] = np.frombuffer(bytes(r["blob"]), np.uint8)
    filter_ = spark.sparkContext.broadcast(whole.reshape(-1))
    seen = keep(base.mapInArrow(_windows(filter_, buckets, least, prefix), f"kind int, {schema}"), "suffix_windows", "kind")
    agreed = seen.where("kind = 0").select("bucket", "blob").repartition(n, "bucket").mapInArrow(_agree(buckets), schema)
    replies = agreed.unionAll(seen.where("kind = 1").select("bucket", "blob"))
    return replies.repartition(n, "bucket").mapInArrow(_passages(least), "doc long, th long, repeated array<array<long>>, removed array<array<long>>")


def _cut(batches):
    word = re.compile(WORD)
    for b in batches:
        out = []
        for t, spans in zip(b["_t"].to_pylist(), b["removed"].to_pylist()):
            if not spans or t is None:
                out.append(t)
                continue
            places = [m.span() for m in word.finditer(t)]
            at, kept = 0, []
            for lo, hi in spans:
                kept.append(t[at : places[lo][0]])
                at = places[hi][0] if hi < len(places) else len(t)
            out.append("".join([*kept, t[at:]]))
        yield pa.record_batch([b[n] for n in b.schema.names if n not in ("_t", "removed")] + [pa.array(out, pa.string())], [n for n in b.schema.names if n not in ("_t", "removed")] + ["text"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """(id, text): the texts without passages that an earlier place has."""
    met = with_passages(docs, repeated_passages(docs, id_col, text_col, least).where(F.size("removed") > 0), id_col, text_col)
    kind = docs.schema[id_col].dataType.simpleString()
    return met.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t"), F.col("__removed").alias("removed")).mapInArrow(_cut, f"_id {kind}, text string").withColumnsRenamed({"_id": id_col, "text": text_col})


ship(__name__)
