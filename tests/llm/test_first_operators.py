"""Packing, PII, mixing, quality, top-k and WARC against brute force, with odd rows."""

import base64
import hashlib
import json
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fluvion.llm import mixing, packing, pii, quality, topk, warc
from fluvion.llm.queries import tokenizer_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
WORDS = "the of and river mail bosbt.42@mail8.example.com 78.239.52.36 4934796579598836 +1 (868) 555-4974 a\tb x\x0by é 𝒳 <b> #tag | a.b@c.d_e@f.g 999.1.2.3 1.2.3.4.5 12-34 5555 5555 5555 4444".split(" ")


def texts(seed=3, n=60):
    rng = random.Random(seed)
    out = [None, "", " ", "a", "\n\n", "the of and\nthe of and\nthe of and", "x" * 5000 + "@b", "word " * 9000]
    for _ in range(n):
        line = lambda: " ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 30)))
        lines = [line() for _ in range(rng.randrange(1, 6))]
        out.append("\n".join(lines + rng.sample(lines, 1)))
    return [*out, *out[-3:]]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i if i != 20 else None, t, None if i % 7 == 0 else f"s{i % 3}", "en", "clash") for i, t in enumerate(texts())]
    rows += rows[30:32]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, size string").repartition(3)


def rows_of(df):
    return [r.asDict() for r in df.collect()]


def base_brute(t):
    t = t or ""
    out = []
    for k, p in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(p, t):
            d = [int(c) for c in m[0] if c in "0123456789"]
            if k == "ip" and max(map(int, m[0].split("."))) > 255:
                continue
            if k == "card" and not (13 <= len(d) <= 19 and sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d[::-1])) % 10 == 0):
                continue
            if k == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((k, m.start(), m.end()))
    return out


def test_pii(docs):
    got = rows_of(pii.find_pii(docs))
    want = Counter()
    for r in docs.collect():
        s = base_brute(r.text)
        n = Counter(k for k, _, _ in s)
        want[r.doc_id, n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in s).encode()).hexdigest()] += 1
        assert r.text != "x" or not s
    assert Counter((g["doc_id"], g["n_email"], g["n_ip"], g["n_card"], g["n_phone"], g["base_sha256"]) for g in got) == want
    assert any(g["spans"] for g in got)


def test_pii_learns_contexts(spark):
    rows = [(i, f"please call me at +1 (555) 000-{1000 + i} tomorrow") for i in range(12)] + [(100, "please call me at 555 000 9999 tomorrow"), (101, "it was 555 000 9999 then")]
    got = {r["doc_id"]: r["spans"] for r in rows_of(pii.find_pii(spark.createDataFrame(rows, "doc_id long, text string")))}
    assert got[100] == "phone:18:30"
    assert got[0].startswith("phone:18:")


def quality_brute(t):
    w = WORD.findall(t or "")
    tri = Counter(zip(w, w[1:], w[2:]))
    mark = {i + k for i, x in enumerate(zip(w, w[1:], w[2:])) if tri[x] > 1 for k in range(3)}
    lines = [x for x in (t or "").split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t or ""), len(lines) - len(set(lines)), len(mark)


def test_quality(docs):
    got = Counter((g["doc_id"], g["n_words"], g["word_chars"], g["n_symbols"], g["n_dup_lines"], g["n_repeat_words"], g["base_failed"]) for g in rows_of(quality.quality_rules(docs)))
    want = Counter()
    for r in docs.collect():
        m = quality_brute(r.text)
        want[(r.doc_id, *m, m[0] < 50 or 100 * m[4] > 50 * m[0])] += 1
    assert got == want
    assert all(not g["kept"] for g in rows_of(quality.quality_rules(docs)) if g["base_failed"])


def test_packing(docs):
    from tokenizers import Tokenizer

    got = rows_of(packing.pack_documents(docs, tokenizer_path()))
    model = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for r in docs.collect():
        ids = [*model.encode(r.text or "", add_special_tokens=False).ids, 0]
        first = len(ids) if len(ids) <= 2048 else len(ids) % 2048 or 2048
        at = piece = 0
        while at < len(ids):
            n = first if not piece else 2048
            want[r.doc_id, piece, at, n, zlib.crc32(np.array(ids[at : at + n], "<u4").tobytes())] += 1
            at, piece = at + n, piece + 1
    assert Counter((g["doc_id"], g["piece"], g["start"], g["length"], g["ids_crc32"]) for g in got) == want
    by = defaultdict(list)
    for g in got:
        by[g["sequence_id"]].append((g["offset"], g["length"]))
    for places in by.values():
        at = 0
        for o, n in sorted(places):
            assert o == at
            at += n
        assert at <= 2048
    assert len(by) <= -(-sum(g["length"] for g in got) // 2048) + 2


def test_encoder(tmp_path):
    """The fast encoder against the tokenizer itself; files that ids alone don't describe are left to it."""
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer_path())
    assert packing.ids_suffice(tokenizer_path())
    encode, rng = packing._encoder(tokenizer_path(), True), random.Random(3)
    marks = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3400 or 0xF900 <= c < 0x20000 or c % 997 == 0)]
    texts = [" ".join(f"x{chr(c)}y {chr(c)}1{chr(c)}{chr(c)}z" for c in marks[lo : lo + 500]) for lo in range(0, len(marks), 500)]
    texts += ["", " ", "it's we'll I'M", "a<|endoftext|>b", " \n" * 200_000 + "x", "ab" * 50_000, "x" + " " * 3000, "".join(rng.choice("abcdefghij 019") for _ in range(20_000))]
    for t in texts:
        assert encode(t) == np.array(model.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
    file = json.loads(open(tokenizer_path()).read())
    for change in ({"merges": file["model"]["merges"][::-1]}, {"dropout": 0.1}, {"merges": file["model"]["merges"][1:]}):
        (tmp_path / "t.json").write_text(json.dumps(file | {"model": file["model"] | change}))
        assert not packing.ids_suffice(str(tmp_path / "t.json"))


def test_packing_plans():
    rng = random.Random(5)
    for _ in range(30):
        h = {rng.randrange(1, 2049): rng.randrange(1, 400) for _ in range(rng.randrange(1, 60))}
        plan, n = packing.make_plan(h)
        used, room = Counter(), Counter()
        for s, r, k, q, b, _ in plan.tolist():
            assert r == used[s]
            used[s] += k * q
            for i in range(k):
                room[b + i] += s * q
        assert used == h and max(room.values()) <= 2048 and set(room) == set(range(n))
    assert len(packing.best_plan({})) == 0


def test_mixing(docs, spark):
    got = rows_of(mixing.mix_sources(docs, block=8))
    assert Counter(tuple(sorted(g.items(), key=str)) for g in got) == Counter(tuple(sorted(g.items(), key=str)) for g in rows_of(mixing.mix_sources(docs.repartition(5), block=8)))
    assert Counter((g["doc_id"], g["size"]) for g in got) == Counter((r.doc_id, len(WORD.findall(r.text or ""))) for r in docs.collect())
    by = defaultdict(list)
    for g in got:
        by[g["source"]].append(g)
        assert g["taken"] in (0, g["size"], 2 * g["size"])
    total = sum(g["size"] for g in got)
    assert abs(sum(v[0]["target"] for v in by.values()) - 1.5 * total) < 1e-6 * total
    for v in by.values():
        assert v[0]["source_size"] == sum(g["size"] for g in v)
        assert abs(sum(g["taken"] for g in v) - v[0]["target"]) <= max(g["size"] for g in v)


def test_flight_balances():
    rng = np.random.default_rng(2)
    p, size = rng.random(500), rng.integers(0, 900, 500).astype(float)
    out = mixing.flight(p, size, rng.random(500))
    assert abs((out * size).sum() - (p * size).sum()) < 1e-3 and abs(out.sum() - p.sum()) < 1e-6
    assert ((out > 1e-9) & (out < 1 - 1e-9)).sum() <= 2


def test_top_k(spark):
    rng = np.random.default_rng(4)
    vecs = [[float(x) for x in rng.normal(0, 0.2, 8).astype("f4")] for _ in range(230)]
    rows = [(i, v, i) for i, v in enumerate(vecs)] + [(300 + i, vecs[0], 0) for i in range(7)] + [(50, vecs[3], 1), (400, None, 1), (450, [1.0, None] + [0.0] * 6, 1), (500, [float("nan")] * 8, 1), (550, [float("inf")] * 8, 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int").repartition(3)
    results = [Counter((r.query_id, r.rank, r.vec_id, r.score) for r in topk.top_k(df, F.col("vec_id") % 50 == 0, **sizes).collect()) for sizes in ({}, {"block": 40, "batch": 3})]
    good = [(i, np.floor(256 * np.array(v, "f4").astype(float)).astype(int)) for i, v, _ in rows if v and None not in v and np.isfinite(v).all()]
    want = Counter()
    for a, (i, q) in enumerate(good):
        if i % 50 == 0:
            best = sorted((-int(q @ v), j) for b, (j, v) in enumerate(good) if a != b)[:5]
            want.update((i, k + 1, j, -s) for k, (s, j) in enumerate(best))
    assert results == [want, want]


def test_impact_index():
    """Dense, sparse, heavy-tailed, empty and unequally long vectors; a proof before all segments are read."""
    rng = np.random.default_rng(6)
    for trial in range(40):
        n, d, dq = rng.integers(1, 300), rng.integers(1, 12), rng.integers(0, 14)
        v = np.floor(256 * rng.standard_t(1 if trial % 2 else 8, (n, d)) * (rng.random((n, d)) < 0.6)).astype(np.int64)
        q = np.floor(256 * rng.standard_t(2, (9, dq))).astype(np.int64) * (np.arange(9)[:, None] > 0)
        row, ident, q_row = rng.permutation(n), rng.integers(0, n, n), rng.integers(0, 2 * n, 9)
        qi, vi, score = topk.ImpactIndex(v, row, ident).search(q, q_row, 5)
        m = min(d, dq)
        for j in range(9):
            best = sorted((-int(q[j, :m] @ v[i, :m]), ident[i], row[i]) for i in range(n) if row[i] != q_row[j])[:5]
            assert [(-s, ident[i], row[i]) for s, i in zip(score[qi == j], vi[qi == j])] == best
    v = rng.integers(-3, 4, (4000, 16))
    v[:40] *= 200
    index = topk.ImpactIndex(v, np.arange(4000), np.arange(4000))
    index.start[index.impact < 64] = index.end[index.impact < 64] = 10**9  # reading these would fail
    index.search(rng.integers(-9, 10, (7, 16)), np.full(7, -1), 5)


def test_warc(spark):
    rows = [(i, f"http://h{i % 3}.example.com/p/{i}?q={i % 5}", f"<p>{i % 9}é</p>", "x") for i in range(40)] + [(41, None, "<p>1é</p>", "x"), (42, "::bad", None, "x"), (43, "http://a/b", "", "x"), (None, "http://a/b", "y", "x"), (5, "http://h2.example.com/p/5?q=0", "<p>5é</p>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, row string").repartition(3)
    archive = warc.write_archive(pages)
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read_archive(spark, archive).collect()]
    best = {}
    for i, _, h, _ in rows:
        best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    assert Counter(x[:3] for x in got) == Counter((i, len((h or "").encode()), digest(h)) for i, _, h, _ in rows)
    assert Counter(x[2] for x in got if x[3] == "response") == Counter(digest(h) for h in best)
    for i, _, d, kind, to in got:
        m = next(v for h, v in best.items() if digest(h) == d)
        assert (to is None and i == (m if m >= 0 else None)) if kind == "response" else to == m
    found = warc.look_up(spark, archive, spark.createDataFrame([("http://H1.example.com/p/4?q=4",), ("http://nowhere/",)], "url string")).collect()
    assert [r.page_id for r in found] == [4]


def test_empty_tables(spark, docs):
    none = docs.where("false")
    for out in (pii.find_pii(none), quality.quality_rules(none), packing.pack_documents(none, tokenizer_path()), mixing.mix_sources(none)):
        assert out.count() == 0
    assert topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.col("vec_id") % 50 == 0).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_archive(spark, warc.write_archive(pages)).count() == 0
