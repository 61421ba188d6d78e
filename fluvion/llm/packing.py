"""Best-fit packing of tokenised documents by linear grouping.

The plan is made from the histogram of piece lengths alone, so the driver holds a table of the capacity's size however
many documents there are. Large lengths, sorted, fall into groups of equal cardinality and are rounded up to the longest
of their group; a linear programme over configurations of these few sizes (column generation with a knapsack) says how
many sequences of each kind to make; the rounded-down counts are filled with actual lengths, which leaves more room than
planned; what is left, and the small lengths, go best-fit, longest first, many equal ones at a time.
Executors tokenise, rank each piece among those of its length, and look its rank up in the plan.

Cases: a null text is empty and is one end token; repeated rows are packed each; ties in length go by partition and
place; very long texts are cut, only the first piece being shorter; an empty table gives an empty table.
"""

from __future__ import annotations

import bisect
import json
import math
import re
import zlib
from array import array
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep, ship, worker_cache

CAPACITY = 2048
# fixed value: how byte-level pre-tokenizers split a text
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The fast splitter steps back over white space and gives up on very long runs of it.
LONG_SPACE = re.compile(r"\s{1000}")


# ---------------------------------------------------------------- the plan


def configuration_lp(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[list[int], float]]:
    """Fractional numbers of sequences for configurations of the sizes, by the simplex method with column generation."""
    g = len(sizes)
    basis = np.diag([float(capacity // s) for s in sizes])
    d = np.array(demand, float)
    ones = np.ones(g)
    layers = capacity // min(sizes)
    for _ in range(40 * g + 50):
        y = np.linalg.solve(basis.T, ones)
        best, choice = np.zeros(capacity + 1), []
        for _layer in range(layers):
            new, who = best.copy(), np.full(capacity + 1, -1)
            for i, s in enumerate(sizes):
                v = best[: capacity + 1 - s] + y[i]
                better = v > new[s:] + 1e-12
                new[s:][better] = v[better]
                who[s:][better] = i
            if (who < 0).all():
                break
            choice.append(who)
            best = new
        if best[capacity] <= 1 + 1e-7:
            break
        col, at = np.zeros(g), capacity
        for who in reversed(choice):
            if who[at] >= 0:
                col[who[at]] += 1
                at -= sizes[who[at]]
        x, step = np.linalg.solve(basis, d), np.linalg.solve(basis, col)
        ratio = np.where(step > 1e-9, x / np.where(step > 1e-9, step, 1), np.inf)
        k = int(np.argmin(ratio))
        if not np.isfinite(ratio[k]):
            break
        basis[:, k] = col
    x = np.linalg.solve(basis, d)
    return [(basis[:, k].round().astype(int).tolist(), float(x[k])) for k in range(g)]


class _Bins:
    """Sequences in bulk: patterns (how many, runs of (length, how often), free), by what is free."""

    def __init__(self, capacity: int):
        self.capacity, self.by_free, self.keys = capacity, defaultdict(list), []

    def add(self, n: int, runs: list[tuple[int, int]], free: int) -> None:
        if n:
            if free not in self.by_free or not self.by_free[free]:
                bisect.insort(self.keys, free)
            self.by_free[free].append((n, runs))

    def fit(self, length: int, count: int) -> None:
        """Places count pieces of one length, each in the fullest sequence that still takes it."""
        while count:
            k = bisect.bisect_left(self.keys, length)
            if k == len(self.keys):
                free, n, runs = self.capacity, -(-count // (self.capacity // length)), []
            else:
                free = self.keys[k]
                n, runs = self.by_free[free].pop()
                if not self.by_free[free]:
                    self.keys.pop(k)
            q = free // length
            whole = min(n, count // q)
            self.add(whole, [*runs, (length, q)], free - q * length)
            count -= whole * q
            n -= whole
            if n and count:
                part = min(count, q)
                self.add(1, [*runs, (length, part)], free - part * length)
                count -= part
                n -= 1
            self.add(n, runs, free) if runs else None


def make_plan(histogram: dict[int, int], capacity: int = CAPACITY, large_from: float = 1 / 4, groups: int = 8) -> tuple[np.ndarray, int]:
    """Rows (length, first rank, sequences, pieces in each, first sequence, offset), sorted; and the number of sequences."""
    bins = _Bins(capacity)
    bins.add(histogram.get(capacity, 0), [(capacity, 1)], 0)
    large = sorted(((s, n) for s, n in histogram.items() if large_from * capacity < s < capacity and n), reverse=True)
    rest = {s: n for s, n in histogram.items() if s <= large_from * capacity and n}
    if large:
        total = sum(n for _, n in large)
        each = max(1, -(-total // groups))
        queue: list[list[list[int]]] = [[]]
        room = each
        for s, n in large:  # equal cardinalities: one length may lie in several groups
            while n:
                if not room:
                    queue.append([])
                    room = each
                take = min(n, room)
                queue[-1].append([s, take])
                n, room = n - take, room - take
        merged: dict[int, list[list[int]]] = {}
        for q in queue:  # groups of one size are one size to the programme
            merged.setdefault(q[0][0], []).extend(q)
        sizes = sorted(merged, reverse=True)
        for config, x in configuration_lp(sizes, [sum(n for _, n in merged[s]) for s in sizes], capacity):
            slots = [s for s, a in zip(sizes, config) for _ in range(a)]
            n = min([int(x + 1e-6), *[sum(k for _, k in merged[s]) // a for s, a in zip(sizes, config) if a]]) if slots else 0
            if n <= 0:
                continue
            pieces = []
            for s in slots:
                runs, need = [], n
                while need:
                    take = min(need, merged[s][0][1])
                    runs.append((merged[s][0][0], take))
                    merged[s][0][1] -= take
                    need -= take
                    if not merged[s][0][1]:
                        merged[s].pop(0)
                pieces.append(runs)
            cuts = sorted({sum(k for _, k in runs[: i + 1]) for runs in pieces for i in range(len(runs))})
            before = 0
            for cut in cuts:
                lengths: dict[int, int] = defaultdict(int)
                for runs in pieces:
                    at = 0
                    for s, k in runs:
                        if at <= before < at + k:
                            lengths[s] += 1
                            break
                        at += k
                bins.add(cut - before, sorted(lengths.items(), reverse=True), capacity - sum(s * k for s, k in lengths.items()))
                before = cut
        for runs in merged.values():
            for s, k in runs:
                rest[s] = rest.get(s, 0) + k
    for s in sorted(rest, reverse=True):
        bins.fit(s, rest[s])
    rows, rank, sequence = [], defaultdict(int), 0
    for free in sorted(bins.by_free):
        for n, runs in bins.by_free[free]:
            offset = 0
            for s, q in runs:
                rows.append((s, rank[s], n, q, sequence, offset))
                rank[s] += n * q
                offset += s * q
            sequence += n
    return np.array(sorted(rows), np.int64).reshape(-1, 6), sequence


#: Where large lengths begin, and how many groups they make: the plan that needs fewest sequences is taken.
TRIALS = [(1 / 4, 8), (1 / 4, 16), (1 / 4, 40), (1 / 3, 8), (1 / 3, 24), (1 / 2, 8), (1 / 2, 32)]


def best_plan(histogram: dict[int, int], capacity: int = CAPACITY, trials=tuple(TRIALS)) -> np.ndarray:
    plans = [make_plan(histogram, capacity, *t) for t in trials]
    return min(plans, key=lambda x: x[1])[0]


# ---------------------------------------------------------------- on the executors


def byte_tokens(vocab: dict[str, int]) -> dict[bytes, int] | None:
    """A byte-level vocabulary with tokens as the bytes they stand for; None if it isn't one."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the others follow 255
    byte = {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in set(shown))}
    return None if any(c not in byte for t in vocab for c in t) else {bytes(byte[c] for c in t): i for t, i in vocab.items()}


def ids_suffice(path: str) -> bool:
    """Whether the file is a byte-level BPE that its tokens and their ids alone describe.

    Merging by the least id of what a pair makes is the same as merging by the file's list if ids rise along the list and
    every token's own bytes merge into it: a pair that makes a token spans just its bytes, whose ends were never merged
    across, and so is the pair of the list.
    """
    with open(path, encoding="utf-8") as f:
        file = json.load(f)
    model, split = file["model"], file.get("pre_tokenizer") or {}
    odd = [model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")]
    kind = [split.get(k) for k in ("type", "add_prefix_space", "use_regex")]
    if model.get("type") != "BPE" or any(odd) or kind != ["ByteLevel", False, True] or file.get("normalizer") or file.get("truncation"):
        return False
    ranks = byte_tokens(model["vocab"])
    if ranks is None:
        return False
    pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    made = [model["vocab"].get(a + b, -1) for a, b in pairs]
    order = {p: i for p, i in zip(pairs, made)}
    single = [ranks.get(bytes([b]), -1) for b in range(256)]
    if min(single) < 0 or sorted(set(made)) != made or max(single) >= min(made, default=256) or len(ranks) != 256 + len(made):
        return False
    for a, b in pairs:
        parts = list(a + b)
        while len(parts) > 1:
            i, k = min((order.get(p, math.inf), k) for k, p in enumerate(zip(parts, parts[1:])))
            if i is math.inf:
                return False
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
    return True


def _encoder(path: str, plain: bool):
    """Text to little-endian 32-bit ids, as the tokenizer's file says. plain: its tokens and ids describe it (`ids_suffice`)."""
    held = worker_cache("tokenizers")
    if path not in held:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        model = Tokenizer.from_file(path)
        fast = None
        if plain:
            import tiktoken

            with open(path, encoding="utf-8") as f:
                ranks = byte_tokens(json.load(f)["model"]["vocab"])
            fast = tiktoken.Encoding("plain", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        held[path] = (model, fast, [t.content for t in model.get_added_tokens_decoder().values()])
    model, fast, special = held[path]

    def encode(text: str) -> bytes:
        if fast and not any(s in text for s in special) and not LONG_SPACE.search(text):
            ids = fast(text)
        else:
            ids = model.encode(text, add_special_tokens=False).ids
        return np.array(array("I", ids), "<u4").tobytes()

    return encode


def _cut(path: str, capacity: int, plain: bool):
    def run(batches):
        from pyspark import TaskContext

        encode, tag, met = _encoder(path, plain), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for b in batches:
            out: dict[str, list] = {k: [] for k in ("id", "piece", "start", "length", "ids_crc32", "rank")}
            for i, text in zip(b["_id"].to_pylist(), b["_t"]):
                ids = encode(text.as_py()) + b"\0\0\0\0"
                n = len(ids) // 4
                first = n if n <= capacity else n % capacity or capacity
                at = piece = 0
                while at < n:
                    size = first if not piece else capacity
                    for k, v in zip(out, (i, piece, at, size, zlib.crc32(ids[4 * at : 4 * (at + size)]), met[size])):
                        out[k].append(v)
                    met[size] += 1
                    at, piece = at + size, piece + 1
            yield pa.record_batch([b["_id"].cast(b["_id"].type).take(pa.array([], pa.int64())) if not out["id"] else pa.array(out["id"], b["_id"].type), pa.array(out["piece"], pa.int32()), *[pa.array(out[k], pa.int64()) for k in ("start", "length", "ids_crc32", "rank")], pa.array([tag] * len(out["id"]), pa.int64())], ["_id", "piece", "start", "length", "ids_crc32", "rank", "tag"])

    return run


def _assign(plan: np.ndarray):
    def run(batches):
        key = (plan[:, 0] << 44) + plan[:, 1]
        for b in batches:
            length, rank = (b[k].to_numpy(zero_copy_only=False) for k in ("length", "rank"))
            row = plan[np.searchsorted(key, (length << 44) + rank, "right") - 1] if b.num_rows else np.zeros((0, 6), np.int64)
            i = rank - row[:, 1]
            columns = [*[b[k] for k in ("_id", "piece", "start", "length", "ids_crc32")], pa.array(row[:, 4] + i // row[:, 3] if len(row) else i), pa.array(row[:, 5] + (i % row[:, 3]) * length if len(row) else i)]
            yield pa.record_batch(columns, ["_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row for each piece of a document: what it holds, and the sequence and offset where it goes."""
    kind = docs.schema[id_col].dataType.simpleString()
    base = docs.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    pieces = keep(base.mapInArrow(_cut(tokenizer_path, capacity, ids_suffice(tokenizer_path)), f"_id {kind}, piece int, start long, length long, ids_crc32 long, rank long, tag long"), "pack_pieces")
    counts = pieces.groupBy("tag", "length").agg(F.count("*").alias("n"))
    # at most `capacity` rows reach the driver
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = best_plan(histogram, capacity)
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("tag").rowsBetween(Window.unboundedPreceding, -1))).select(F.col("tag").alias("_g"), F.col("length").alias("_n"), F.coalesce("before", F.lit(0)).alias("before"))
    ranked = pieces.join(before, (F.col("tag") == F.col("_g")) & (F.col("length") == F.col("_n"))).select("_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))
    return ranked.mapInArrow(_assign(plan), f"_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long").withColumnRenamed("_id", id_col)


ship(__name__)
