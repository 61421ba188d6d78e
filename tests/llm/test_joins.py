"""Line dedup, n-gram join, suffix dedup, toxicity and the pipeline against brute force, with odd rows."""

import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from fluvion.llm import line_dedup, ngram_join, setjoin, suffix_dedup, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "And", *[f"w{rng.randrange(400)}" for _ in range(6)]])
    out = [None, "", " \n ", "one", "One", "a b c", "a b  c\n", "x " * 4000]
    base = [" ".join(word() for _ in range(rng.randrange(20, 160))) for _ in range(14)]
    for b in base:
        for _ in range(rng.randrange(1, 12)):
            w = b.split(" ")
            for _ in range(rng.choice([0, 1, 2, 5, 9])):
                w[rng.randrange(len(w))] = word()
            k = rng.randrange(5, 40)
            out.append("\n".join(" ".join(w[i : i + k]) for i in range(0, len(w), k)))
    out += ["\n".join([" ".join(word() for _ in range(30)), base[0], "the common line of all"]) for _ in range(12)]
    return [*out, *out[:5]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 3 % 211, t, "x", 1) for i, t in enumerate(corpus())]
    return spark.createDataFrame(rows, "doc_id long, text string, item string, part int").repartition(4)


def shingle_sets(rows):
    out = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOW))
        out[i] = frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
    return out


def brute_components(sets):
    up = {i: i for i in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b]):
                x, y = top(a), top(b)
                up[max(x, y)] = min(x, y)
    return {i: top(i) for i in ids}


def test_ngram_join(docs, monkeypatch):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    sets = shingle_sets(rows)
    want = Counter((i, len(sets[i]), c) for i, c in brute_components(sets).items())
    for most in (4, 1):  # 1: nearly every run is crowded, so the second pass does the work
        monkeypatch.setattr(setjoin, "MOST", most)
        monkeypatch.setattr(setjoin, "EARLIEST", 1)
        got = ngram_join.near_duplicates(docs).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    kept = ngram_join.keep_one(docs)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert ids == {c for i, c in brute_components(sets).items()} | {i for i in sets if not sets[i]}


def test_ngram_odd_rows(spark):
    rows = [(None, "a b c d e f g"), (None, "a b c d e f g"), (7, "A b c d e f G"), (7, "A b c d e f G"), (3, None), (3, None), (9, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter((r.doc_id, r.component_id) for r in ngram_join.near_duplicates(df).collect())
    assert got == Counter([(None, 7), (None, 7), (7, 7), (7, 7), (3, 3), (3, 3), (9, 9)])
    assert Counter(r.doc_id for r in ngram_join.keep_one(df).collect()) == Counter([7, 3, 3, 9])


def brute_lines(rows):
    seen, gone = [], defaultdict(list)
    for i, t in sorted(rows, key=lambda r: r[0]):
        for k, x in enumerate((t or "").translate(LOW).split("\n")):
            s = frozenset(WORD.findall(x))
            if s:
                if any(4 * len(s & o) >= 3 * len(s | o) for o in seen):
                    gone[i].append(k)
                seen.append(s)
    return gone


def test_line_dedup(docs, monkeypatch):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    gone = brute_lines(rows)
    for most in (4, 1):
        monkeypatch.setattr(setjoin, "MOST", most)
        monkeypatch.setattr(setjoin, "EARLIEST", 1)
        got = {r.doc: r.lines for r in line_dedup.find_duplicate_lines(docs).collect()}
        assert {k: v for k, v in got.items() if v} == gone
    out = line_dedup.dedup_lines(docs)
    assert out.columns == docs.columns
    for r in out.collect():
        t = dict(rows)[r.doc_id]
        assert r.text == (None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone[r.doc_id]))


def brute_passages(rows, n=50):
    occ, docs, seen, out = Counter(), {}, set(), {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOW))
        docs[i] = [tuple(w[k : k + n]) for k in range(len(w) - n + 1)]
        occ.update(docs[i])

    def union(a):
        spans = []
        for x in a:
            if spans and x <= spans[-1][1]:
                spans[-1][1] = x + n
            else:
                spans.append([x, x + n])
        return spans

    for i in sorted(docs):
        rep, rem = [], []
        for k, x in enumerate(docs[i]):
            rep += [k] if occ[x] > 1 else []
            rem += [k] if x in seen else []
            seen.add(x)
        if rep:
            out[i] = (union(rep), union(rem))
    return out


def test_suffix_dedup(docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = brute_passages(rows)
    got = {r.doc: (r.repeated, r.removed) for r in suffix_dedup.repeated_passages(docs).collect()}
    assert got == want and any(v[1] for v in want.values())
    cut = {r.doc_id: r.text for r in suffix_dedup.remove_repeats(docs).collect()}
    for i, t in rows:
        w = WORD.findall(t or "")
        drop = {k for lo, hi in want.get(i, ([], []))[1] for k in range(lo, hi)}
        assert WORD.findall(cut[i] or "") == [x for k, x in enumerate(w) if k not in drop]
        assert (cut[i] is None) == (t is None)


def test_toxicity(spark):
    rng = random.Random(4)
    bad, plain = ["idiot", "lowei{}"], [f"w{k}" for k in range(300)]
    rows, labels = [(10**6, None), (10**6 + 1, "")], []
    for i in range(700):
        w = [rng.choice(plain) for _ in range(rng.randrange(5, 200))]
        y = int(i % 4 == 0)
        if y:
            w[rng.randrange(len(w))] = rng.choice(bad).format(rng.choice(["ei", "un", "schaft", "eu", "chen"]))
        rows.append((i, " ".join(w)))
        labels.append((i, y if i % 50 else None, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in toxicity.score_documents(docs, spark.createDataFrame(labels, "doc_id long, toxic int, quality int")).collect()}
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values()) and len(got) == 702
    test = [got[i] for i in range(700) if got[i].held_out]
    assert sum(r.predicted == int(r.doc_id % 4 == 0) for r in test) > 0.93 * len(test)
    kept = toxicity.reject_toxic(docs, spark.createDataFrame(labels, "doc_id long, toxic int, quality int"))
    assert {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if not r.predicted}
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score_documents(docs, none).agg(F.max("score")).first()[0] == 0


def test_gradients():
    import numpy as np

    net = toxicity.Network(1)
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    words = ["ab", "idiot", "x,", "lowei"]
    feats = toxicity.features(words)
    ids, size = np.array([[0, 1], [1, 2], [3, 1]]), np.array([3, 2])
    y, weight = np.array([1.0, 0.0]), np.ones(2)

    def loss():
        l = net.logits(net.project(net.inputs(feats)).astype(np.float64)[ids], size, {})
        return float((np.logaddexp(0, l) - y * l).mean())

    adam: dict = {}
    before = {k: v.copy() for k, v in net.w.items()}
    net.step(feats, ids, size, y, weight, adam, 0.0)
    for k in ("att", "att_v", "out", "in_f", "in_b", "rec_f", "rec_b", "bias_b"):
        g = adam[k][0] * 10
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        net.w[k] = before[k].copy()
        net.w[k][at] += 1e-2
        up = loss()
        net.w[k][at] -= 2e-2
        down = loss()
        net.w[k] = before[k].copy()
        assert abs((up - down) / 2e-2 - g[at]) < 2e-2 * abs(g[at]) + 1e-5, k


def test_empty_tables(docs):
    none = docs.where("false")
    assert ngram_join.near_duplicates(none).count() == line_dedup.find_duplicate_lines(none).count() == suffix_dedup.repeated_passages(none).count() == 0
    assert ngram_join.keep_one(none).count() == line_dedup.dedup_lines(none).count() == suffix_dedup.remove_repeats(none).count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    first = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, d).collect(), docs.schema)
        assert docs.columns == first
    words = sum(len(WORD.findall(r.text or "")) for r in docs.collect())
    assert words > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, d)
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert corpus_pipeline.run(spark, d).count() == packed.count()
