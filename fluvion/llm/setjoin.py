"""What the exact set-similarity joins share: prefix postings, candidate pairs, verification, components.

A set is a sorted array of order keys (rare tokens first). If two sets reach the least Jaccard similarity, the first
n - ceil(t n) + 1 tokens of each have one in common, so only these prefixes are posted, as packed blobs dealt to buckets by
token. In a bucket, the entries of a token meet under the length, positional and (where signatures are given) bitmap
filters. A set with more than a few partners left in a token's run (large groups of near copies, or very common tokens)
names only those with the nearest signatures, of these the earliest, and those with the fewest rarer tokens (the likely
originals of a group); all entries of the run are kept aside. A run whose windows are far larger than itself isn't even enumerated: its entries meet
the few such originals of their size. Once those pairs are verified, most such runs are settled; the entries that aren't
meet in full in a second pass, long runs cut into blocks that meet two by two, so that no task holds a run whole. So
nothing is lost, and no group of copies makes all its pairs. An item is the 64-bit hash of its set, so exact copies are
one item from the start.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, give_back, keep, mix, pack, partitions, ship, small_side, sorted_within, unpack

#: Least similarity, as a fraction of integers, so that no rounding decides.
NUM, DEN = 3, 4
#: A set names up to MOST partners in a run; where it has more, the EARLIEST of the likeliest ones, and the run is kept aside.
MOST, EARLIEST = 4, 2
ENTRY = ("<u8", "<i8", "<i8", "<u4", "<u4", "<u4", "<u8", "<u8", "<u8", "<u8")  # key, item, doc, line, n, pos, signature
#: Sets of more tokens than the second have a parity signature of 256 bits, of more than the first 128, others 64; the longer fold
#: into the shorter.
SHORT_SET, LONG_SET = 64, 160
#: What is posted of a key: its rarity and 32 bits of hash. Tokens that share it share a run, so pairs only grow.
POSTED = np.uint64(0xFFFFFFFFFF000000)
#: Entries that a map task holds before it deals them, and that a bucket has on average.
FLUSH, BUCKET = 250_000, 400_000
#: Entries of a run's block in the second pass; a task holds two blocks, or as many entries of shorter runs.
RUN_BLOCK = 100_000
#: A run whose windows hold over WIDE partners an entry is met through HUBS entries of each band of sizes.
WIDE, HUBS = 512, 8
#: Bits of a parity signature.
PARITY = 512
#: Most sets and tokens of a block of a component, on average, when the links of its sets are counted.
BLOCK_SETS, BLOCK_TOKENS = 2_000, 1_000_000


def prefix_length(n: int) -> int:
    return n - (-(-NUM * n // DEN)) + 1


def least_overlap(a, b):
    """ceil(t / (1 + t) * (a + b))"""
    return -(-NUM * (a.astype(np.int64) + b) // (NUM + DEN))


class Poster:
    """Collects entries on a map task and deals them to buckets; an item is posted once a task."""

    def __init__(self, buckets: int):
        self.buckets, self.seen, self.parts, self.blocks, self.held = buckets, set(), [], [], 0

    def add(self, item: int, doc: int, line: int, keys: np.ndarray, sig: tuple[int, ...] = (0, 0, 0, 0)) -> Iterator[tuple[int, bytes]]:
        """keys: the whole set, sorted in the global order. The first occurrence in the task counts: feed in order."""
        if item in self.seen or not len(keys):
            return
        self.seen.add(item)
        p = prefix_length(len(keys))
        self.parts.append((keys[:p], item, doc, line, len(keys), sig))
        self.held += p
        if self.held > FLUSH:
            yield from self.flush()

    def extend(self, columns: list[np.ndarray]) -> Iterator[tuple[int, bytes]]:
        """Entries of many items at once, in the order of ENTRY."""
        self.blocks.append(columns)
        self.held += len(columns[0])
        if self.held > FLUSH:
            yield from self.flush()

    def flush(self) -> Iterator[tuple[int, bytes]]:
        if self.parts:
            sizes = np.array([len(p[0]) for p in self.parts])
            rep = lambda k, t: np.repeat(np.array([p[k] for p in self.parts], t), sizes)
            pos = np.concatenate([np.arange(s, dtype="<u4") for s in sizes])
            self.blocks.append([np.concatenate([p[0] for p in self.parts]), rep(1, "<i8"), rep(2, "<i8"), rep(3, "<u4"), rep(4, "<u4"), pos, *[np.repeat(np.array([p[5][k] for p in self.parts], "<u8"), sizes) for k in range(4)]])
        if not self.held:
            return
        columns = [np.concatenate([b[k] for b in self.blocks]) for k in range(len(ENTRY))]
        key = columns[0] = columns[0] & POSTED
        bucket = (mix(key) % np.uint64(self.buckets)).astype(np.int64)
        bits = self.buckets.bit_length()
        order = np.argsort((bucket.astype(np.uint64) << np.uint64(64 - bits)) | (key >> np.uint64(bits)))  # by bucket and, mostly, key
        columns, bucket = [c[order] for c in columns], bucket[order]
        cut = np.flatnonzero(np.diff(bucket)) + 1
        for lo, hi in zip([0, *cut], [*cut, len(bucket)]):
            yield int(bucket[lo]), pack(*[c[lo:hi] for c in columns])
        self.parts, self.blocks, self.held = [], [], 0
        if len(self.seen) > 500_000:
            self.seen.clear()


def _sorted_runs(c: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Entries by token and then size, and the number of each entry's run; of one item in a token, its first occurrence. Runs of two or more."""
    if not len(c[0]):
        return c, np.zeros(0, np.int64)
    by = np.argsort(c[0])
    key = c[0][by]
    same = key[1:] == key[:-1]
    by = by[np.r_[same, False] | np.r_[False, same]]  # tokens that only one entry has make no pair
    token = c[0][by]
    of = np.cumsum(np.r_[False, token[1:] != token[:-1]])
    by = by[sorted_within(of, c[1][by].view("<u8"))]  # stays grouped by token
    again = (c[0][by][1:] == c[0][by][:-1]) & (c[1][by][1:] == c[1][by][:-1])
    if again.any():
        several = np.flatnonzero(np.r_[again, False] | np.r_[False, again])
        x = by[several]
        by[several] = x[np.lexsort((c[5][x], c[3][x], c[2][x], c[1][x], of[several]))]  # of one place, the lower position
        again = (c[0][by][1:] == c[0][by][:-1]) & (c[1][by][1:] == c[1][by][:-1])
    by = by[np.r_[True, ~again]] if len(by) else by
    c = [x[by] for x in c]
    edge = np.flatnonzero(np.r_[True, c[0][1:] != c[0][:-1], True]) if len(by) else np.zeros(1, np.int64)
    size = np.diff(edge)
    member = np.repeat(size > 1, size)
    c = [x[member] for x in c]
    run = np.repeat(np.arange((size > 1).sum()), size[size > 1])
    order = sorted_within(run, (c[4].astype(np.uint64) << np.uint64(32)) | (c[1].view("<u8") >> np.uint64(32)))
    return [x[order] for x in c], run


def bucket_count(tokens: int, spark) -> int:
    """Buckets for the prefixes of sets with so many tokens in all: some three entries for each ten tokens."""
    return max(2 * partitions(spark), 3 * tokens // (10 * BUCKET))


def parity(s: np.ndarray) -> bytes:
    """For each of PARITY slots, whether the set has an odd number of tokens there: two signatures differ in no more bits
    than the sets do in tokens, however large these are."""
    return np.packbits((np.bincount((s >> np.uint64(64 - 9)).astype(np.int64), minlength=PARITY) & 1).astype(bool)).tobytes()


def windows(c: list[np.ndarray], run: np.ndarray, short_side: np.ndarray, long_side: np.ndarray) -> tuple[np.ndarray, ...]:
    """Places x of shorter sets, y of longer ones, and for each y where its partners start in x and how many there are.

    The length and positional filters are a range of sizes for each longer set: from t * n[j] up to what its position
    leaves; shorter sets count only where their position leaves enough against an equal one.
    """
    n, pos = c[4].astype(np.int64), c[5].astype(np.int64)
    x = np.flatnonzero(short_side & (n - pos >= least_overlap(n, n)))
    place = (run[x] << 32) | n[x]  # sorted, as runs are by size
    y = np.flatnonzero(long_side)
    low = -(-NUM * n[y] // DEN)
    # least_overlap(a, n) <= n - pos  <=>  a <= (n - pos) * (NUM + DEN) / NUM - n
    high = np.minimum(n[y], (n[y] - pos[y]) * (NUM + DEN) // NUM - n[y])
    lo = np.searchsorted(place, (run[y] << 32) | low, "left")
    hi = np.maximum(lo, np.searchsorted(place, (run[y] << 32) | np.maximum(high, 0), "right"))
    many = hi - lo
    return x, y[many > 0], lo[many > 0], many[many > 0]


def _near_enough(c: list[np.ndarray], sig: np.ndarray | None, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether the lengths, positions and signatures of two entries leave the similarity possible; of those where they do, in
    how many bits the signatures differ (0 without signatures)."""
    n, pos = c[4].astype(np.int64), c[5].astype(np.int64)
    need = least_overlap(n[i], n[j])
    ok = (n[i] - pos[i] >= need) & (n[j] - pos[j] >= need) & (c[1][i] != c[1][j])
    far = np.zeros(0, np.int64)
    if sig is not None:
        at = np.flatnonzero(ok)
        x = sig[i[at]] ^ sig[j[at]]
        if x.shape[1] == 4:
            least = np.minimum(n[i[at]], n[j[at]])
            for most, half in ((LONG_SET, 2), (SHORT_SET, 1)):
                fold = least <= most
                x[fold, :half] ^= x[fold, half : 2 * half]
                x[fold, half : 2 * half] = 0
        apart = np.bitwise_count(x).sum(axis=1, dtype=np.int64)
        ok[at] = apart <= n[i[at]] + n[j[at]] - 2 * need[at]
        far = apart[ok[at]]
    return ok, far if sig is not None else np.zeros(int(ok.sum()), np.int64)


def _signatures(c: list[np.ndarray]) -> np.ndarray | None:
    return np.stack(c[6:10], axis=1) if c[6].any() or c[7].any() else None


def window_pairs(c: list[np.ndarray], run: np.ndarray, short_side: np.ndarray, long_side: np.ndarray, sig: np.ndarray | None, at_once: int = 250_000):
    """Places (i, j) of pairs of a run that pass every filter, n[i] <= n[j], and by how many bits they differ, in chunks. The sides say which entries take part."""
    n, pos = c[4].astype(np.int64), c[5].astype(np.int64)
    x, y, lo, many = windows(c, run, short_side, long_side)
    total = np.cumsum(many)
    at = 0
    while at < len(y):
        stop = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + at_once, "right")))
        count = many[at:stop]
        j = np.repeat(y[at:stop], count)
        i = x[np.repeat(lo[at:stop] - (np.cumsum(count) - count), count) + np.arange(len(j))]
        once = (n[i] < n[j]) | (i < j) | ~(short_side[j] & long_side[i] & (n[j] - pos[j] >= least_overlap(n[i], n[j])))
        i, j = i[once], j[once]
        ok, far = _near_enough(c, sig, i, j)
        yield i[ok], j[ok], far
        at = stop


def _by_place(c: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each pair with the earlier occurrence first."""
    _, item, doc, line, *_ = c
    later = (doc[i] > doc[j]) | (doc[i] == doc[j]) & ((line[i] > line[j]) | (line[i] == line[j]) & (item[i] > item[j]))
    return np.where(later, j, i), np.where(later, i, j)


def _first_of(group: np.ndarray, most) -> np.ndarray:
    """Which places are among the first `most` of their group; equal groups stand together."""
    return np.arange(len(group)) - np.searchsorted(group, group, "left") < most


def _hub_pairs(c: list[np.ndarray], run: np.ndarray, wide: np.ndarray, sig: np.ndarray | None, at_once: int = 500_000):
    """Of entries of wide runs, places (partner, entry) with the hubs of their band of sizes, the best hubs first."""
    at = np.flatnonzero(wide)
    band = (np.log(c[4][at]) / np.log(1.15)).astype(np.int64)
    order = np.lexsort((c[1][at], c[5][at], c[3][at], c[2][at], band, run[at]))
    at, group = at[order], (run[at][order] << 16) | band[order]
    hub = at[_first_of(group, HUBS)]
    of = group[_first_of(group, HUBS)]
    lo, hi = np.searchsorted(of, group, "left"), np.searchsorted(of, group, "right")
    for k in range(0, len(at), at_once // HUBS):
        count = (hi - lo)[k : k + at_once // HUBS]
        j = np.repeat(at[k : k + at_once // HUBS], count)
        i = hub[np.repeat(lo[k : k + at_once // HUBS] - (np.cumsum(count) - count), count) + np.arange(len(j))]
        ok, _ = _near_enough(c, sig, i, j)
        i, j = i[ok], j[ok]
        # stable: hubs stay in their order
        order = np.argsort(j, kind="stable")
        i, j = i[order], j[order]
        ok = _first_of(j, EARLIEST)
        yield i[ok], j[ok]


def candidate_pairs(c: list[np.ndarray], ordered: bool = False) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """Items of pairs (earlier, later); the entries of runs in which some entry had more partners than it may name; and which
    of them had. An entry counts its shorter partners, or if ordered its earlier ones."""
    c, run = _sorted_runs(c)
    if not len(run):
        return run, run, c, run
    every, sig = np.ones(len(run), bool), _signatures(c)
    size = np.bincount(run)
    _, y, _, many = windows(c, run, every, every)
    over = np.bincount(run[y], many, len(size)) > WIDE * size
    wide = over[run]
    found = []

    def name(i, j):
        i, j = _by_place(c, i, j)
        found.append(np.unique(np.stack([c[1][i], c[1][j]]), axis=1))

    for i, j in _hub_pairs(c, run, wide, sig):
        name(i, j)
    ever = wide.copy()
    for i, j, far in window_pairs(c, run, ~wide, ~wide, sig):
        if ordered:
            i, j = _by_place(c, i, j)
        order = np.lexsort((c[1][i], c[5][i], c[3][i], c[2][i], far, j))  # of each set, the likeliest and then the earliest partners
        i, j = i[order], j[order]
        few = _first_of(j, MOST)
        over[run[j[~few]]] = True
        crowded = np.zeros(len(c[0]), bool)
        crowded[j[~few]] = True
        ever |= crowded
        ok = _first_of(j, np.where(crowded[j], EARLIEST, MOST))
        name(i[ok], j[ok])
    pairs = np.unique(np.concatenate(found, axis=1), axis=1) if found else np.zeros((2, 0), np.int64)
    kept = over[run]
    return pairs[0], pairs[1], [x[kept] for x in c], ever[kept]


def _reduce(ordered: bool):
    """Blobs sorted by bucket to pairs (kind 0), the asking entries of long runs as item and token (1), and these runs: how many
    entries, token and all entries as a blob (2). One bucket is held at a time."""

    def settle(blobs):
        parts = [unpack(x, *ENTRY) for x in blobs]
        a, b, long, asks = candidate_pairs([np.concatenate([p[k] for p in parts]) for k in range(len(ENTRY))], ordered)
        asks = asks.astype(bool)
        token, edge = long[0].view(np.int64), np.flatnonzero(np.r_[True, long[0][1:] != long[0][:-1], True]) if len(long[0]) else [0]
        runs = [pack(*[x[lo:hi] for x in long[1:]]) for lo, hi in zip(edge[:-1], edge[1:])]
        for kind, x, y, z in ((0, a, b, [None] * len(a)), (1, long[1][asks], token[asks], [None] * int(asks.sum())), (2, np.diff(edge), token[edge[:-1]], runs)):
            yield pa.record_batch([pa.array(np.full(len(x), kind, np.int32)), pa.array(x), pa.array(y), pa.array(z, pa.binary())], ["kind", "a", "b", "blob"])

    def run(batches):
        now, blobs = None, []
        for b in batches:
            for bucket, blob in zip(b["bucket"].to_pylist(), b["blob"]):
                if bucket != now and blobs:
                    yield from settle(blobs)
                    blobs = []
                now = bucket
                blobs.append(blob.as_py())
        if blobs:
            yield from settle(blobs)

    return lambda batches: give_back(run(batches))


def _entries(batches):
    """Blobs of runs to their entries."""
    names = ["a", "b", "doc", "line", "n", "pos", "s0", "s1", "s2", "s3"]
    for b in batches:
        for token, blob in zip(b["b"].to_pylist(), b["blob"]):
            x = unpack(blob.as_py(), *ENTRY[1:])
            yield pa.record_batch([pa.array(k.view(np.int64) if k.dtype.itemsize == 8 else k.astype(np.int64)) for k in (x[0], np.full(len(x[0]), token), *x[1:])], names)


def entries(runs: DataFrame) -> DataFrame:
    return runs.select("b", "blob").mapInArrow(_entries, "a long, b long, doc long, line long, n long, pos long, s0 long, s1 long, s2 long, s3 long")


def _settle(ordered: bool):
    """Entries of crowded runs again, sorted by token and pair of blocks: every pair that the filters leave and that isn't
    settled.

    ordered: a pair is owed if its later item asks; otherwise if its parts differ, and then the largest part of a run
    needs no pairs of its own.
    """

    def settle(t):
        get = lambda k: t[k].to_numpy()
        token, mine, at, to = get("b").view("<u8"), get("mine"), get("i"), get("j")
        new = np.r_[False, (token[1:] != token[:-1]) | (at[1:] != at[:-1]) | (to[1:] != to[:-1])]
        run = np.cumsum(new)
        c = [run.astype("<u8"), get("a"), get("doc"), get("line"), get("n"), get("pos"), *[get(f"s{k}").view("<u8") for k in range(4)]]
        order = np.lexsort((c[1], c[4], run))
        c, run, mine = [x[order] for x in c], run[order], mine[order]
        across = (at != to)[order]
        part, asks = get("part")[order], get("asks")[order].astype(bool)
        sig = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint64).reshape(len(order), -1)[order] if "sig" in t.column_names else _signatures(c)
        if not ordered:
            by = np.lexsort((part, run))
            new = np.r_[True, (run[by][1:] != run[by][:-1]) | (part[by][1:] != part[by][:-1])]
            size = np.diff(np.r_[np.flatnonzero(new), len(by)])
            largest = np.zeros(int(run[-1]) + 1, np.int64)
            np.maximum.at(largest, run[by][new], size)
            main = np.zeros(int(run[-1]) + 1, np.int64)
            top = size == largest[run[by][new]]
            main[run[by][new][top]] = part[by][new][top]
            asks = part != main[run]
        every = np.ones(len(run), bool)
        for short_side, long_side in ((every, asks), (asks, ~asks)):
            for i, j, _ in window_pairs(c, run, short_side, long_side, sig):
                i, j = _by_place(c, i, j)
                # one place twice (texts that share an id): either may be the later one
                same = (c[2][i] == c[2][j]) & (c[3][i] == c[3][j])
                owed = (asks[j] | (same & asks[i]) if ordered else part[i] != part[j]) & (~across[i] | (mine[i] != mine[j]))
                pairs = np.unique(np.stack([c[1][i[owed]], c[1][j[owed]]]), axis=1)
                yield pa.record_batch([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    def run_(batches):
        held, rows = [], 0
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            rows += b.num_rows
            if rows > 2 * RUN_BLOCK:
                t = pa.Table.from_batches(held).combine_chunks()
                last = [t[k][-1].as_py() for k in ("b", "i", "j")]
                tail = (t["b"].to_numpy() == last[0]) & (t["i"].to_numpy() == last[1]) & (t["j"].to_numpy() == last[2])
                cut = int(tail.argmax())  # the last group may go on
                if cut:
                    yield from settle(t.slice(0, cut).combine_chunks())
                held = t.slice(cut).to_batches()
                rows = t.num_rows - cut
        if held:
            yield from settle(pa.Table.from_batches(held).combine_chunks())

    return lambda batches: give_back(run_(batches))


def candidates(posted: DataFrame, buckets: int, ordered: bool = False) -> tuple[DataFrame, DataFrame]:
    """posted (bucket, blob) to distinct pairs (a, b), and the written table that also holds the long runs."""
    tasks = max(partitions(posted.sparkSession), buckets // 2)
    out = keep(posted.repartition(tasks, "bucket").sortWithinPartitions("bucket").mapInArrow(_reduce(ordered), "kind int, a long, b long, blob binary"), "join_found", "kind")
    return out.where("kind = 0").select("a", "b").distinct(), out


def _met(rows: DataFrame, runs: DataFrame, ordered: bool) -> DataFrame:
    """Pairs of the entries of runs (b, m: how many entries), long runs in blocks."""
    runs = runs.select(F.col("b").alias("_b"), F.ceil(F.col("m") / RUN_BLOCK).cast("int").alias("blocks"))
    dealt = rows.join(runs, rows["b"] == runs["_b"]).drop("_b").withColumn("mine", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns({"i": F.least("mine", "o"), "j": F.greatest("mine", "o")}).drop("o", "blocks")
    dealt = dealt.repartition(partitions(rows.sparkSession), "b", "i", "j").sortWithinPartitions("b", "i", "j")
    return dealt.mapInArrow(_settle(ordered), "a long, b long").distinct()


def unsettled(found: DataFrame, state: DataFrame, signatures: DataFrame) -> DataFrame:
    """Pairs that long runs still owe, those within a part being settled. state: (item, part); signatures: (item, sig), for
    every item."""
    s = state.select(F.col("item").alias("_i"), "part")
    long = entries(found.where("kind = 2"))
    rows = long.join(s, long["a"] == s["_i"], "left").select(*long.columns, F.coalesce("part", "a").alias("part"), F.lit(0).alias("asks"))
    met = signatures.join(long.select(F.col("a").alias("item")).distinct(), "item", "left_semi").dropDuplicates(["item"])
    rows = keep(rows.join(met.withColumnRenamed("item", "_i"), rows["a"] == F.col("_i")).drop("_i"), "join_long")
    runs = rows.groupBy("b").agg(F.min("part").alias("lo"), F.max("part").alias("hi"), F.count("*").alias("m")).where("lo < hi")
    return _met(rows, runs, False)


def unsettled_later(found: DataFrame, gone: DataFrame) -> DataFrame | None:
    """Pairs that long runs still owe to entries that had more earlier partners than they named and aren't gone (item); None if there are none."""
    settled = small_side(gone.select(F.col("item").alias("_g")))
    asking = keep(found.where("kind = 1").join(settled, F.col("a") == F.col("_g"), "left_anti").select("a", "b"), "join_asking")
    if not asking.limit(1).count():
        forget(asking)
        return None
    open_ = small_side(keep(asking.groupBy(F.col("b").alias("_b")).agg(F.count("*").alias("n")), "join_open"))
    rows = entries(found.where("kind = 2").join(open_, F.col("b") == F.col("_b"), "left_semi"))
    mark = asking.select(F.col("a").alias("_a"), F.col("b").alias("_b"), F.lit(1).alias("asks"))
    rows = rows.join(mark, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")), "left").drop("_a", "_b").withColumn("asks", F.coalesce("asks", F.lit(0)))
    rows = keep(rows.withColumn("part", F.col("a")), "join_long")
    return _met(rows, rows.groupBy("b").agg(F.count("*").alias("m")), True)


def binaries(column: pa.Array) -> list[np.ndarray]:
    """Views of the rows of a binary column as arrays of 64-bit numbers, without copies."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].tolist()
    data = column.buffers()[2] or b""
    return [np.frombuffer(data, "<u8", (hi - lo) // 8, lo) for lo, hi in zip(offsets, offsets[1:])]


def _verify(batches):
    for b in batches:
        keep_ = []
        for x, y in zip(binaries(b["set_a"]), binaries(b["set_b"])):
            p, q = (x, y) if len(x) <= len(y) else (y, x)
            both = int((q[np.minimum(np.searchsorted(q, p), len(q) - 1)] == p).sum())
            keep_.append(DEN * both >= NUM * (len(p) + len(q) - both))
        yield pa.record_batch([b["a"].filter(pa.array(keep_, pa.bool_())), b["b"].filter(pa.array(keep_, pa.bool_()))], ["a", "b"])


def verified(pairs: DataFrame, sets: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The pairs that reach the similarity. sets: items (item) to (item, set), a set being sorted hashes. Both joins read the
    one exchange of sets by item, so a set is dealt once and then travels with its pairs."""
    pairs = keep(pairs, "join_pairs")
    items = pairs.select(F.explode(F.array("a", "b")).alias("item")).distinct()
    got = sets(items).dropDuplicates(["item"])
    a = got.select(F.col("item").alias("_a"), F.col("set").alias("set_a"))
    b = got.select(F.col("item").alias("_b"), F.col("set").alias("set_b"))
    met = pairs.join(a, pairs["a"] == a["_a"]).drop("_a")
    met = met.join(b, met["b"] == b["_b"]).select("a", "b", "set_a", "set_b")
    links = keep(met.mapInArrow(_verify, "a long, b long"), "join_links")
    forget(pairs)
    return links


def components(edges: DataFrame) -> DataFrame:
    """(item, part): the least item of each component, by alternating large and small stars, each round a written table that
    replaces the one before. Rounds go on until nothing changes: each moves a node to a lesser neighbour, so they end."""
    e = keep(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "stars")
    seen = None
    while True:
        both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy(F.col("u").alias("_u")).agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, both["u"] == low["_u"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        low = large.groupBy(F.col("u").alias("_u")).agg(F.min("v").alias("m"))
        met = large.join(low, large["u"] == low["_u"])
        small = met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select(F.col("_u").alias("u"), F.col("m").alias("v"))).where("u <> v").distinct()
        old, e = e, keep(small, "stars")
        forget(old)
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("item"), F.col("v").alias("part")).unionAll(e.select(F.col("v").alias("item"), F.col("v").alias("part")).distinct())


def partners(sets: list[np.ndarray], second: np.ndarray | None = None, at_once: int = 2_000_000) -> np.ndarray:
    """For each set, how many others reach the least similarity; with `second`, how many of the other side.

    The overlaps are a product of two 0-1 matrices. Tokens that many sets have are multiplied as dense columns, the
    others add one for each pair of sets that has them, whichever is less work. Counts are exact up to 2^24 tokens a set.
    """
    size = np.array([len(s) for s in sets], np.int64)
    _, token = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(token, kind="stable")
    token, row = token[order], row[order]
    one = np.arange(len(sets)) if second is None else np.flatnonzero(~second)
    two = one if second is None else np.flatnonzero(second)
    place = np.zeros(len(sets), np.int64)
    place[one], place[two] = np.arange(len(one)), np.arange(len(two))
    left = np.ones(len(row), bool) if second is None else ~second[row]
    right = left if second is None else ~left
    (tx, x), (ty, y) = (token[left], place[row[left]]), (token[right], place[row[right]])
    most = int(token[-1]) + 1
    nx, ny = np.bincount(tx, minlength=most), np.bincount(ty, minlength=most)
    start = np.cumsum(ny) - ny
    dense = 256 * nx * ny >= len(one) * len(two)
    both = np.zeros((len(one), len(two)), np.float32)
    wide = np.flatnonzero(dense)
    for lo in range(0, len(wide), 1024):
        of = np.full(most, -1)
        of[wide[lo : lo + 1024]] = np.arange(len(wide[lo : lo + 1024]))
        sides = []
        for t, at, n in ((tx, x, len(one)), (ty, y, len(two))):
            m = np.zeros((n, len(wide[lo : lo + 1024])), np.float32)
            had = of[t] >= 0
            m[at[had], of[t[had]]] = 1
            sides.append(m)
        both += sides[0] @ sides[1].T
    rest = np.flatnonzero(~dense[tx] & (ny[tx] > 0))
    total = np.cumsum(ny[tx[rest]])
    k = 0
    while k < len(rest):
        stop = max(k + 1, int(np.searchsorted(total, (total[k - 1] if k else 0) + at_once, "right")))
        e = rest[k:stop]
        count = ny[tx[e]]
        j = y[np.repeat(start[tx[e]] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))]
        both += np.bincount(np.repeat(x[e], count) * len(two) + j, minlength=both.size).reshape(both.shape)
        k = stop
    out = np.zeros(len(sets), np.int64)
    for lo in range(0, len(one), 256):
        ok = (NUM + DEN) * both[lo : lo + 256].astype(np.int64) >= NUM * (size[one[lo : lo + 256], None] + size[two])
        out[one[lo : lo + 256]] += ok.sum(axis=1)
        if second is not None:
            out[two] += ok.sum(axis=0)
    return out - 1 if second is None else out  # a set is no partner of itself


def _count(batches):
    """Sets sorted by (part, i, j), a pair of blocks, to partners within it."""

    def settle(key, items, sets, mine):
        side = None if key[1] == key[2] else np.array(mine) == key[2]
        if side is None or side.any() and not side.all():
            yield pa.record_batch([pa.array(items, pa.int64()), pa.array(partners(sets, side))], ["item", "n_links"])

    key, items, sets, mine = None, [], [], []
    for b in batches:
        for part, i, j, m, item, s in zip(*[b[k].to_pylist() for k in ("part", "i", "j", "mine", "item")], b["set"]):
            if (part, i, j) != key:
                if items:
                    yield from settle(key, items, sets, mine)
                key, items, sets, mine = (part, i, j), [], [], []
            items.append(item)
            sets.append(np.frombuffer(s.as_py(), "<u8"))
            mine.append(m)
    if items:
        yield from settle(key, items, sets, mine)


def degrees(links: DataFrame, parts: DataFrame, sizes: DataFrame, sets: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(item, n_links): the exact number of links of every item of parts. links: those verified, each once; sizes: (item, n).

    All links lie within components. Where every pair of one is verified already, its items have one link less than it
    has items. The sets of the others are dealt into blocks of bounded size, each pair of blocks to one place, and
    counted there; so what a task holds is bounded, and the work is the square of a component's number of sets.
    """
    spark = links.sparkSession
    found = links.join(parts, links["a"] == parts["item"]).groupBy(F.col("part").alias("_p")).agg(F.count("*").alias("found"))
    met = parts.join(sizes, "item").groupBy(F.col("part").alias("_p")).agg(F.count("*").alias("m"), F.sum("n").alias("tokens"))
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK_SETS), F.ceil(F.col("tokens") / BLOCK_TOKENS)).cast("int")
    state = met.join(found, "_p", "left").select("_p", "m", blocks.alias("blocks"), (F.col("found") * 2 == F.col("m") * (F.col("m") - 1)).alias("whole"))
    state = keep(parts.join(state, parts["part"] == F.col("_p")).select("item", "part", "m", "blocks", "whole"), "join_degrees")
    open_ = state.where("not whole").select(F.col("item").alias("_i"), "part", "blocks", F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int").alias("mine"))
    got = sets(open_.select(F.col("_i").alias("item"))).dropDuplicates(["item"])
    dealt = got.join(open_, got["item"] == open_["_i"]).select("item", "set", "part", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("o"))
    dealt = dealt.select("item", "set", "part", "mine", F.least("mine", "o").alias("i"), F.greatest("mine", "o").alias("j"))
    dealt = dealt.repartition(partitions(spark), "part", "i", "j").sortWithinPartitions("part", "i", "j")
    counted = dealt.mapInArrow(_count, "item long, n_links long").groupBy("item").agg(F.sum("n_links").alias("n_links"))
    return state.where("whole").select("item", (F.col("m") - 1).alias("n_links")).unionAll(counted)


ship(__name__)
