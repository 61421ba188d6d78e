"""What the operators of this folder share: scratch tables, packed blobs and the frequency sketch."""

from __future__ import annotations

import atexit
import shutil
import sys
import tempfile
import types
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, and what separates words: blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"


def ship(name: str) -> None:
    """Pickle a module's functions by value, so that executors need no copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


def worker_cache(name: str) -> dict:
    """A dictionary that the tasks of a Python worker share, until another one is asked for."""
    holder = sys.modules.setdefault("_fluvion_worker_cache", types.ModuleType("_fluvion_worker_cache")).__dict__
    if name not in holder:
        pa.set_memory_pool(pa.system_memory_pool())  # gives memory back between tasks
        for other in [k for k, v in holder.items() if isinstance(v, dict) and not k.startswith("__")]:
            del holder[other]  # another operator's
    return holder.setdefault(name, {})


def scratch_root(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or a local one where that is unset (tests)."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        where = held.get() if held.isDefined() else None
    if not where:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="fluvion-")
        atexit.register(shutil.rmtree, where, True)
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/fluvion/{uuid.uuid4().hex}/{name}"


def keep(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write a table into the shared folder and read it again: lineage ends, and a lost executor loses nothing."""
    path, conf = new_path(df.sparkSession, name), df.sparkSession.conf
    writer = df.write.option("compression", "zstd")
    # once the table is written, nothing reads the shuffle files of its plan again
    cleanup = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(cleanup, "false")
    conf.set(cleanup, "true")
    try:
        (writer.partitionBy(by) if by else writer).parquet(path)
    finally:
        conf.set(cleanup, before)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables that `keep` wrote and that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._scratch)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def give_back(batches):
    """A task's batches; at its end the worker's freed memory goes back to the system, as workers outlive their tasks."""
    import ctypes

    yield from batches
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: nothing to give back by hand
        pass


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Numbers of a table that may be broadcast, 8 bytes each and some 20 MB as a hashed relation; beyond it, joins shuffle.
BROADCAST_NUMBERS = 1_000_000


def small_side(df: DataFrame, size=None) -> DataFrame:
    """A written table of numbers, marked for broadcast if a count shows that it is small enough. size: a Column, the
    numbers in a row beyond its key, where rows hold arrays."""
    if size is None:
        rows = BROADCAST_NUMBERS // len(df.columns)
        return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
    return F.broadcast(df) if (df.agg(F.sum(size + 1)).first()[0] or 0) <= BROADCAST_NUMBERS else df


def one_of_equals(rows: DataFrame, decided: DataFrame, n_col: str, key: list[str]) -> DataFrame:
    """One row of each key. n_col says how many rows a key has; only where that is over one anywhere is anything dealt by key."""
    if not decided.where(F.col(n_col) > 1).limit(1).count():
        return rows
    return rows.where(F.col(n_col) == 1).unionByName(rows.where(F.col(n_col) > 1).dropDuplicates(key))


# ---------------------------------------------------------------- hashing


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift-multiply); bijective, so it adds no collisions."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _tables() -> tuple[np.ndarray, ...]:
    """Bytes with capitals as small letters, which bytes separate words, and masks for the first k bytes of eight."""
    t = worker_cache("word_tables")
    if not t:
        low = np.arange(256, dtype=np.uint8)
        low[65:91] += 32
        space = np.zeros(256, bool)
        space[[9, 10, 11, 12, 13, 32]] = True
        mask = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
        t.update(low=low, space=space, mask=mask)
    return t["low"], t["space"], t["mask"]


def _word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64 bits for each word data[start:end]: its bytes eight at a time, each eight mixed with their place, summed and mixed
    with the length. The mixing isn't linear in the bytes, so words built from patterns don't collide more than others; words
    of up to eight bytes never collide with others of their length."""
    low, _, mask = _tables()
    if not len(start):
        return np.zeros(0, np.uint64)
    eights = np.zeros(len(data) // 8 + 2, "<u8")
    eights.view(np.uint8)[: len(data)] = low[data]
    size = end - start
    many = (size + 7) >> 3
    first = np.cumsum(many) - many
    place = np.arange(int(many.sum())) - np.repeat(first, many)
    at = np.repeat(start, many) + 8 * place
    shift = ((at & 7) << 3).astype(np.uint64)
    x = eights[at >> 3] >> shift
    x |= (eights[(at >> 3) + 1] << (np.uint64(63) - shift)) << np.uint64(1)
    x &= mask[np.minimum(np.repeat(end, many) - at, 8)]
    with np.errstate(over="ignore"):
        x = mix(x + (place.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03))
        return mix(np.add.reduceat(x, first) + size.astype(np.uint64) * np.uint64(0xA0761D6478BD642F))


def word_chunks(texts: pa.Array, most_bytes: int = 800_000):
    """Portions of a column of texts as (first row, end row, hash of each word, its row, its line), by whole-array operations.

    Words are runs of other than the six ASCII white-space characters, ASCII capitals lowered; rows and lines count from
    0, rows from the portion's first.
    """
    if not pa.types.is_string(texts.type):
        texts = texts.cast(pa.string())
    # the column's own buffers: Spark gives nulls no bytes
    offsets = (np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int32)).astype(np.int64)
    whole = np.frombuffer(texts.buffers()[2], np.uint8) if len(texts) and texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most_bytes, "right")) - 1)
        data, at = whole[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        gap = _tables()[1][data]
        edge = np.zeros(len(data) + 1, bool)
        edge[at] = True  # a text's end ends its word
        start = np.flatnonzero(~gap & (np.r_[True, gap[:-1]] | edge[:-1])) if len(data) else np.zeros(0, np.int64)
        end = np.flatnonzero(~gap & (np.r_[gap[1:], True] | edge[1:])) + 1 if len(data) else start
        h = _word_hashes(data, start, end)
        row = np.repeat(np.arange(hi - lo), np.diff(np.searchsorted(start, at)))
        feeds = np.flatnonzero(data == 10)
        before = np.repeat(np.arange(len(feeds) + 1), np.diff(np.r_[0, np.searchsorted(start, feeds), len(start)]))
        line = before - np.searchsorted(feeds, at[:-1])[row]
        yield lo, hi, h, row, line
        lo = hi


def sorted_within(group: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The order of numbers x by group and then number; groups are numbered from 0 and stand in order."""
    if not len(x):
        return np.zeros(0, np.int64)
    bits = int(group[-1]).bit_length()
    both = (group.astype(np.uint64) << np.uint64(64 - bits)) | (x >> np.uint64(bits)) if bits else x
    order = np.argsort(both)
    if bits:  # the lowest bits of x gave way; where they decide, sort by both
        both, low = both[order], x[order]
        if ((both[1:] == both[:-1]) & (low[1:] != low[:-1])).any():
            return np.lexsort((x, group))
    return order


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of n words, in order; with fewer words, of the whole run."""
    if len(h) == 0:
        return h
    k = min(n, len(h))
    out = np.zeros(len(h) - k + 1, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(k):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - k + 1 + i] + np.uint64(i + 1))
        return mix(out + np.uint64(k))


# ---------------------------------------------------------------- packed columns


def pack(*columns: np.ndarray) -> bytes:
    """Arrays of equal length as one compressed blob, byte planes apart; the first may be sorted."""
    import zstandard

    n = len(columns[0])
    planes = [np.uint32(n).tobytes()]
    for c in columns:
        planes.append(np.ascontiguousarray(c).view(np.uint8).reshape(n, -1).T.tobytes())
    return zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unpack(blob: bytes, *kinds: str) -> list[np.ndarray]:
    import zstandard

    raw = zstandard.ZstdDecompressor().decompress(blob)
    n, at, out = int(np.frombuffer(raw, np.uint32, 1)[0]), 4, []
    for kind in kinds:
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * size
    return out


def column(values: list, kind: pa.DataType) -> pa.Array:
    return pa.array(values, kind)


# ---------------------------------------------------------------- frequency sketch

#: Counters of the sketch. Its size bounds what is broadcast; a smaller one only orders tokens less well.
SLOTS = 1 << 21
SEGMENTS = 64


def sketch_rows(counts: np.ndarray) -> list[tuple[int, bytes]]:
    """What a task reports of its counters: a blob for each segment."""
    import zstandard

    parts = np.minimum(counts, np.uint32(0xFFFFFFFF)).astype("<u4").reshape(SEGMENTS, -1)
    squeeze = zstandard.ZstdCompressor(level=1)
    return [(i, squeeze.compress(p.view(np.uint8).reshape(-1, 4).T.tobytes())) for i, p in enumerate(parts) if p.any()]


def _add_segments(batches):
    import zstandard

    per = SLOTS // SEGMENTS
    sums: dict[int, np.ndarray] = {}
    for b in batches:
        for seg, blob in zip(b["bucket"].to_pylist(), b["blob"].to_pylist()):
            raw = zstandard.ZstdDecompressor().decompress(blob)
            v = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, per).T).view("<u4").reshape(-1).astype(np.uint64)
            sums[seg] = sums[seg] + v if seg in sums else v
    for seg, v in sums.items():
        # levels: 0 for up to four times the mean load plus 8, then by doublings; one byte each
        yield pa.record_batch({"bucket": pa.array([seg], pa.int64()), "blob": pa.array([np.minimum(v, 0xFFFFFFFF).astype("<u4").tobytes()], pa.binary())})


def gather_sketch(rows: DataFrame) -> np.ndarray:
    """Sums the tasks' sketches by segment; what reaches the driver has a fixed size, SLOTS counters of 4 bytes."""
    spark = rows.sparkSession
    got = rows.select("bucket", "blob").repartition(SEGMENTS, "bucket").mapInArrow(_add_segments, "bucket long, blob binary").collect()
    out = np.zeros((SEGMENTS, SLOTS // SEGMENTS), np.uint32)
    for r in got:
        out[r["bucket"]] = np.frombuffer(bytes(r["blob"]), "<u4")
    return out.reshape(-1)


def levels(counts: np.ndarray) -> np.ndarray:
    """One byte of rarity for each counter: small counts exactly, larger ones by quarter doublings."""
    c = counts.astype(np.float64)
    return np.where(c <= 32, c, 32 + 4 * np.log2(np.maximum(c, 32) / 32)).clip(0, 255).astype(np.uint8)


def order_key(h: np.ndarray, level: np.ndarray) -> np.ndarray:
    """The place of a token in the global order: rare ones first, equal ones by hash. The low byte of the hash gives way."""
    slot = (h >> np.uint64(20)).astype(np.int64) & (SLOTS - 1)
    return (level[slot].astype(np.uint64) << np.uint64(56)) | (h >> np.uint64(8))


def count_into(counts: np.ndarray, h: np.ndarray) -> None:
    slot = (h >> np.uint64(20)).astype(np.int64) & (SLOTS - 1)
    np.add.at(counts, slot, 1) if len(slot) < 64 else counts.__iadd__(np.bincount(slot, minlength=SLOTS).astype(np.uint32)) if len(slot) > SLOTS // 8 else np.add.at(counts, slot, np.uint32(1))


def crc_text(col) -> F.Column:
    return F.crc32(col.cast("string").cast("binary"))


ship(__name__)
