"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as a hashed word vector and the mean of its hashed character 3- to 5-gram vectors. A text is cut into
overlapping windows of words, all of which are scored; its score is that of its worst window, calibrated on the training
documents. Training is multiple-instance: a toxic document teaches by the window that looks worst, at first by the
log-odds of its words, later by the network itself. The training sample is bounded (MOST_TOXIC and MOST_CLEAN documents
of at most MOST_WORDS words, the first by a hash of their ids); everything else sees whole texts of all documents.

Cases: null or empty texts score as a window without words; repeated rows score alike; labels that are null teach
nothing, and of several labels of one id the highest holds; without labels of both classes every score is 0; an empty
table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import crc_text, give_back, ship, worker_cache

#: Bounds of the training sample.
MOST_TOXIC, MOST_CLEAN, MOST_WORDS = 1200, 2000, 800
WINDOW, STRIDE = 64, 48
#: Windows of a training step, and steps that even a small sample gets.
BATCH, LEAST_STEPS = 128, 220
BUCKETS, WORD_DIM, CHAR_DIM, HIDDEN = 1 << 15, 6, 10, 8
DIM = WORD_DIM + CHAR_DIM
EDGE = ".,;:!?|\"'()[]{}<>#*$%&-_"


def held_out(id_col: str) -> Column:
    return F.coalesce(crc_text(F.col(id_col)) % 3 == 1, F.lit(False))


def words_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def features(words: list[str], at_once: int = 20_000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word: its bucket, and its character grams' buckets, flat, with their starts."""
    parts = [_features(words[k : k + at_once]) for k in range(0, max(1, len(words)), at_once)]
    shift = np.cumsum([0, *[len(g) for _, g, _ in parts[:-1]]])
    start = [s[:-1] + k for (_, _, s), k in zip(parts, shift)]
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.concatenate([*start, [sum(len(p[1]) for p in parts)]])


def _features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    import xxhash

    bare = [w.strip(EDGE) or w for w in words]
    bucket = np.fromiter((xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass")) % BUCKETS for w in bare), np.int64, len(bare))
    raw = [b"^" + w.encode("utf-8", "surrogatepass") + b"$" for w in bare]
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    text = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
    word = np.repeat(np.arange(len(raw)), size)
    end = np.repeat(np.cumsum(size), size)
    at = np.arange(len(text))
    owner, gram = [], []
    with np.errstate(over="ignore"):
        for n in (3, 4, 5):
            if len(text) < n:
                continue
            h = np.full(len(text) - n + 1, n, np.uint64)
            for k in range(n):
                h = (h ^ text[k : len(text) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
            ok = at[: len(h)] + n <= end[: len(h)]
            owner.append(word[: len(h)][ok]), gram.append((h[ok] % np.uint64(BUCKETS)).astype(np.int64))
    owner, gram = np.concatenate(owner or [at[:0]]), np.concatenate(gram or [at[:0]])
    order = np.argsort(owner, kind="stable")
    start = np.searchsorted(owner[order], np.arange(len(raw) + 1))
    return bucket.astype(np.int32), gram[order].astype(np.int32), start


def sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


class Network:
    """Weights by name; forward keeps what backward needs."""

    def __init__(self, seed: int = 7):
        g = np.random.default_rng(seed)
        r = lambda s, *shape: (g.standard_normal(shape) * s).astype(np.float32)
        self.w = {"word": r(0.1, BUCKETS, WORD_DIM), "char": r(0.3, BUCKETS, CHAR_DIM), "att": r(0.3, 2 * HIDDEN, HIDDEN), "att_b": r(0, HIDDEN), "att_v": r(0.5, HIDDEN), "out": r(0.5, 2 * HIDDEN), "out_b": r(0, 1)}
        for d in "fb":
            self.w |= {f"in_{d}": r(0.3, DIM, 3 * HIDDEN), f"rec_{d}": r(0.3, HIDDEN, 3 * HIDDEN), f"bias_{d}": r(0, 3 * HIDDEN)}
        self.scale, self.shift = 1.0, 0.0

    def inputs(self, feats) -> np.ndarray:
        bucket, gram, start = feats
        n = np.maximum(np.diff(start), 1)
        sums = np.zeros((len(bucket), CHAR_DIM), np.float32)
        some = np.flatnonzero(np.diff(start) > 0)
        if len(some):
            sums[some] = np.add.reduceat(self.w["char"][gram], start[:-1][some])
        return np.concatenate([self.w["word"][bucket], sums / n[:, None]], axis=1)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Input parts of both directions' gates, for each word: what scoring caches."""
        return np.concatenate([x @ self.w[f"in_{d}"] + self.w[f"bias_{d}"] for d in "fb"], axis=1).astype(np.float32)

    def _gru(self, p: np.ndarray, mask: np.ndarray, d: str, trail: list | None):
        """p: time, batch, gates; mask: time, batch, 1. States by time."""
        h, u, H = np.zeros((p.shape[1], HIDDEN), np.float32), self.w[f"rec_{d}"], HIDDEN
        out = np.empty((p.shape[0], p.shape[1], HIDDEN), np.float32)
        for t in range(p.shape[0]) if d == "f" else range(p.shape[0] - 1, -1, -1):
            q = h @ u
            zr = sigmoid(p[t, :, : 2 * H] + q[:, : 2 * H])
            z, r = zr[:, :H], zr[:, H:]
            n = np.tanh(p[t, :, 2 * H :] + r * q[:, 2 * H :])
            new = n + z * (h - n)
            if trail is not None:
                trail.append((t, h, z, r, n, q[:, 2 * H :]))
            h = new if mask is None else h + mask[t] * (new - h)
            out[t] = h
        return out

    def _gru_back(self, dout, mask, d, trail, grads):
        u, H, dh = self.w[f"rec_{d}"], HIDDEN, 0.0
        dp = np.zeros((*dout.shape[:2], 3 * H), np.float32)
        for t, h, z, r, n, qn in reversed(trail):
            dh = dh + dout[t]
            dnew = dh * mask[t]
            dn = dnew * (1 - z) * (1 - n * n)
            dz = dnew * (h - n) * z * (1 - z)
            dr = dn * qn * r * (1 - r)
            dq = np.concatenate([dz, dr, dn * r], axis=1)
            dp[t] = np.concatenate([dz, dr, dn], axis=1)
            grads[f"rec_{d}"] += h.T @ dq
            dh = dh * (1 - mask[t]) + dnew * z + dq @ u.T
        return dp

    def logits(self, p: np.ndarray, size: np.ndarray, trail: dict | None = None) -> np.ndarray:
        """p: time, batch, both directions' gates; size: words of each window, at least 0."""
        T, B = p.shape[:2]
        full = bool((size == T).all())
        mask = None if full and trail is None else (np.arange(T)[:, None] < size[None, :]).astype(np.float32)[:, :, None]
        tf, tb = ([], []) if trail is not None else (None, None)
        h = np.concatenate([self._gru(p[:, :, : 3 * HIDDEN], mask, "f", tf), self._gru(p[:, :, 3 * HIDDEN :], mask, "b", tb)], axis=2)
        a = np.tanh(h @ self.w["att"] + self.w["att_b"])
        e = a @ self.w["att_v"]
        if mask is not None:
            e = np.where(mask[:, :, 0] > 0, e, -1e9)
        e = np.exp(e - e.max(axis=0))
        if mask is not None:
            e = e * mask[:, :, 0]
        alpha = e / np.maximum(e.sum(axis=0), 1e-9)
        pooled = (alpha[:, :, None] * h).sum(axis=0)
        if trail is not None:
            trail |= {"tf": tf, "tb": tb, "h": h, "a": a, "alpha": alpha, "pooled": pooled, "mask": mask}
        return pooled @ self.w["out"] + self.w["out_b"][0]

    def step(self, feats, ids: np.ndarray, size: np.ndarray, y: np.ndarray, weight: np.ndarray, adam: dict, rate: float) -> float:
        used, place = np.unique(ids, return_inverse=True)
        place = place.reshape(ids.shape)
        bucket, gram, start = feats
        count = np.diff(start)[used]
        own_start = np.r_[0, np.cumsum(count)]
        own_gram = gram[np.repeat(start[:-1][used] - own_start[:-1], count) + np.arange(own_start[-1])]
        own = (bucket[used], own_gram, own_start)
        x = self.inputs(own)
        tr: dict = {}
        logit = self.logits(self.project(x)[place], size, tr)
        p = sigmoid(logit)
        g = {k: np.zeros_like(v) for k, v in self.w.items() if k not in ("word", "char")}
        dl = ((p - y) * weight / weight.sum()).astype(np.float32)
        h, a, alpha, pooled, mask = (tr[k] for k in ("h", "a", "alpha", "pooled", "mask"))
        g["out"], g["out_b"] = dl @ pooled, np.array([dl.sum()], np.float32)
        dpool = dl[:, None] * self.w["out"]
        dalpha = (h * dpool).sum(axis=2)
        dh = alpha[:, :, None] * dpool
        de = alpha * (dalpha - (alpha * dalpha).sum(axis=0))
        da = de[:, :, None] * self.w["att_v"] * (1 - a * a)
        g["att_v"] = (a * de[:, :, None]).sum(axis=(0, 1))
        g["att"], g["att_b"] = np.tensordot(h, da, ((0, 1), (0, 1))), da.sum(axis=(0, 1))
        dh = dh + da @ self.w["att"].T
        dx_words = np.zeros((len(used), 6 * HIDDEN), np.float32)
        for k, d in enumerate("fb"):
            dp = self._gru_back(dh[:, :, k * HIDDEN : (k + 1) * HIDDEN], mask, d, tr["t" + d], g)
            flat, where = dp.reshape(-1, 3 * HIDDEN), place.reshape(-1)
            for c in range(3 * HIDDEN):
                dx_words[:, k * 3 * HIDDEN + c] = np.bincount(where, flat[:, c], len(used))
            part = dx_words[:, k * 3 * HIDDEN : (k + 1) * 3 * HIDDEN]
            g[f"in_{d}"], g[f"bias_{d}"] = x.T @ part, part.sum(axis=0)
        dx = dx_words[:, : 3 * HIDDEN] @ self.w["in_f"].T + dx_words[:, 3 * HIDDEN :] @ self.w["in_b"].T
        g["word"], g["char"] = np.zeros_like(self.w["word"]), np.zeros_like(self.w["char"])
        np.add.at(g["word"], own[0], dx[:, :WORD_DIM])
        np.add.at(g["char"], own_gram, np.repeat(dx[:, WORD_DIM:] / np.maximum(count, 1)[:, None], count, axis=0))
        adam["t"] = adam.get("t", 0) + 1
        for k, v in g.items():
            m, s = adam.setdefault(k, (np.zeros_like(v), np.zeros_like(v)))
            m *= 0.9
            m += 0.1 * v
            s *= 0.99
            s += 0.01 * v * v
            t = adam["t"]
            self.w[k] -= (rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.99**t)) + 1e-8)).astype(np.float32)
        return float((weight * (np.logaddexp(0, logit) - y * logit)).sum() / weight.sum())


def windows(n: int) -> list[tuple[int, int]]:
    """Starts and ends of the overlapping windows of n words; the last one ends the text."""
    if n <= WINDOW:
        return [(0, n)]
    starts = list(range(0, n - WINDOW, STRIDE)) + [n - WINDOW]
    return [(s, s + WINDOW) for s in starts]


class Scorer:
    """Scores texts, remembering the gates' input parts of words seen."""

    def __init__(self, net: Network, most: int = 100_000):
        self.net, self.most, self.place = net, most, {}
        self.table = np.zeros((0, 6 * HIDDEN), np.float32)
        self.filled = 0

    def rows(self, words: list[str]) -> np.ndarray:
        new = list(dict.fromkeys(w for w in words if w not in self.place)) if self.place else list(dict.fromkeys(words))
        if new and self.filled + len(new) > self.most and self.place:
            self.place.clear()
            self.filled = 0
            new = list(dict.fromkeys(words))
        if new:
            if self.filled + len(new) > len(self.table):
                grown = np.zeros((max(2 * len(self.table), self.filled + len(new), 4096), 6 * HIDDEN), np.float32)
                grown[: self.filled] = self.table[: self.filled]
                self.table = grown
            for k in range(0, len(new), 20_000):
                some = self.net.project(self.net.inputs(features(new[k : k + 20_000])))
                self.table[self.filled + k : self.filled + k + len(some)] = some
            self.place.update(zip(new, range(self.filled, self.filled + len(new))))
            self.filled += len(new)
        return np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))

    def window_logits(self, docs: list[list[str]], at_once: int = 1024) -> tuple[np.ndarray, np.ndarray, list]:
        """Logit of every window of every text, the text it belongs to, and its place."""
        ids = self.rows([w for d in docs for w in d])
        base = np.r_[0, np.cumsum([len(d) for d in docs])].astype(np.int64)
        spans = [(k, s, e) for k, d in enumerate(docs) for s, e in windows(len(d))]
        size = np.array([e - s for _, s, e in spans])
        start = np.array([base[k] + s for k, s, _ in spans])
        out = np.zeros(len(spans), np.float32)
        order = np.argsort(-size, kind="stable")
        for lo in range(0, len(order), at_once):
            pick = order[lo : lo + at_once]
            T = int(size[pick[0]])
            if not T:
                out[pick] = self.net.w["out_b"][0]
                continue
            where = start[pick][None, :] + np.minimum(np.arange(T)[:, None], np.maximum(size[pick] - 1, 0)[None, :])
            out[pick] = self.net.logits(self.table[ids[np.minimum(where, len(ids) - 1)]], size[pick])
        return out, np.array([k for k, _, _ in spans]), spans

    def scores(self, docs: list[list[str]]) -> np.ndarray:
        if not docs:
            return np.zeros(0)
        logit, owner, _ = self.window_logits(docs)
        worst = np.full(len(docs), -np.inf)
        np.maximum.at(worst, owner, logit)
        return sigmoid(self.net.scale * worst.astype(np.float64) + self.net.shift)


def _all_windows(net: Network, docs: list[list[str]]) -> tuple[np.ndarray, list]:
    scorer, logits, places = Scorer(net, 60_000), [], []
    for lo in range(0, len(docs), 200):
        v, _, spans = scorer.window_logits(docs[lo : lo + 200], 256)
        logits.append(v)
        places += [(lo + k, s, e) for k, s, e in spans]
    return np.concatenate(logits), places


def train(texts: list[str], labels: list[int], prior: float, epochs: int = 4, seed: int = 7) -> Network:
    """prior: the share of toxic documents among all labelled ones, for calibration."""
    net, rng = Network(seed), np.random.default_rng(seed)
    docs = [words_of(t) for t in texts]
    y = np.array(labels, np.float32)
    vocabulary: dict[str, int] = {}
    ids = [np.array([vocabulary.setdefault(w, len(vocabulary)) for w in d], np.int64) for d in docs]
    feats = features(list(vocabulary))
    seen = [np.bincount(np.concatenate([np.unique(i) for i, t in zip(ids, y) if t == k] or [np.zeros(0, np.int64)]).astype(np.int64), minlength=len(vocabulary)) for k in (0, 1)]
    odds = np.log((seen[1] + 0.2) / (y.sum() + 1)) - np.log((seen[0] + 0.2) / ((1 - y).sum() + 1))
    odds = np.where(seen[1] + seen[0] >= 3, odds, 0)
    spans = [windows(len(d)) for d in docs]
    worst = [max(s, key=lambda w: odds[i[w[0] : w[1]]].max(initial=-9)) for s, i in zip(spans, ids)]
    adam: dict = {}
    epochs = max(epochs, -(-LEAST_STEPS * BATCH // max(1, len(docs) + int((y == 0).sum()))))
    for epoch in range(epochs):
        items = [(k, *worst[k], 1.0) for k in range(len(docs))]
        items += [(k, *spans[k][rng.integers(len(spans[k]))], 1.0) for k in range(len(docs)) if y[k] == 0 and len(spans[k]) > 1]
        rng.shuffle(items)
        items = [(int(k), int(s), int(e), w) for k, s, e, w in items if e > s]
        for lo in range(0, len(items), BATCH):
            part = items[lo : lo + BATCH]
            size = np.array([e - s for _, s, e, _ in part])
            grid = np.zeros((size.max(), len(part)), np.int64)
            for c, (k, s, e, _) in enumerate(part):
                grid[: e - s, c] = ids[k][s:e]
                grid[e - s :, c] = ids[k][s]
            target = y[[k for k, *_ in part]]
            net.step(feats, grid, size, target, np.ones(len(part), np.float32), adam, 0.02 if epoch < epochs - 2 else 0.006)
        if epoch >= 1:
            logit, places = _all_windows(net, docs)
            best: dict[int, tuple] = {}
            for v, (k, s, e) in zip(logit, places):
                if k not in best or v > best[k][0]:
                    best[k] = (v, s, e)
            worst = [best[k][1:] for k in range(len(docs))]
    logit, places = _all_windows(net, docs)
    top = np.full(len(docs), -np.inf)
    np.maximum.at(top, [k for k, _, _ in places], logit)
    weight = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9))
    a, b = 1.0, 0.0
    for _ in range(200):  # logistic calibration by Newton steps, slightly ridged
        p = sigmoid(a * top + b)
        d, v = weight * (p - y), weight * p * (1 - p)
        h = np.array([[(v * top * top).sum() + 1, (v * top).sum()], [(v * top).sum(), v.sum() + 1e-3]])
        move = np.linalg.solve(h, [(d * top).sum() + (a - 1), d.sum()])
        a, b = a - np.clip(move[0], -0.5, 0.5), b - np.clip(move[1], -0.5, 0.5)
        if np.abs(move).max() < 1e-6:
            break
    net.scale, net.shift = float(max(a, 1e-3)), float(b)
    return net


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Network | None:
    """Learns from the labelled rows that aren't held out; the sample that reaches the driver is bounded."""
    known = labels.where(~held_out(id_col) & F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_i")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    share = known.agg(F.count("*").alias("n"), F.sum("y").alias("k")).first()
    if not share["n"] or share["k"] in (None, 0) or share["k"] == share["n"]:
        return None
    picked = None
    for value, most in ((1, MOST_TOXIC), (0, MOST_CLEAN)):
        part = known.where(F.col("y") == value).orderBy(F.xxhash64("_i"), "_i").limit(most)
        picked = part if picked is None else picked.unionAll(part)
    # at most MOST_TOXIC + MOST_CLEAN rows
    met = docs.join(F.broadcast(picked), F.col(id_col) == F.col("_i")).select("_i", F.col(text_col).alias("t"), "y")
    rows = met.where(F.size(F.split("t", r"\s+")) <= MOST_WORDS).collect()
    rows = sorted(((r["_i"], r["t"] or "", r["y"]) for r in rows))
    if len({r[2] for r in rows}) < 2:
        return None
    return train([r[1] for r in rows], [r[2] for r in rows], share["k"] / share["n"])


def _scores(model, texts: list[str | None]) -> np.ndarray:
    """Scores of a batch, some words at a time."""
    net = model.value
    held = worker_cache("toxicity")
    if held.get("id") != id(net):
        held.clear()
        held.update(id=id(net), net=net, scorer=Scorer(net) if net else None)
    out, part, words = [], [], 0
    for t in texts:
        part.append(words_of(t))
        words += len(part[-1])
        if words > 60_000:
            out.append(held["scorer"].scores(part) if net else np.zeros(len(part)))
            part, words = [], 0
    out.append(held["scorer"].scores(part) if net else np.zeros(len(part)))
    return np.concatenate(out)


def _score(model):
    def run(batches):
        for b in batches:
            yield pa.record_batch([b["_id"], pa.array(_scores(model, b["_t"].to_pylist()))], ["_id", "score"])

    return lambda batches: give_back(run(batches))


def _keep(model, text_place: int, threshold: float):
    def run(batches):
        for b in batches:
            yield b.filter(pa.array(_scores(model, b.column(text_place).to_pylist()) < threshold))

    return lambda batches: give_back(run(batches))


def reject_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of docs that score below the threshold, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col))
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return plain.mapInArrow(_keep(model, docs.columns.index(text_col), threshold), plain.schema).toDF(*docs.columns)


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score and predicted for every row of docs."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col))
    kind = docs.schema[id_col].dataType.simpleString()
    scored = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_t")).mapInArrow(_score(model), f"_id {kind}, score double")
    return scored.select(F.col("_id").alias(id_col), held_out("_id").alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


ship(__name__)
