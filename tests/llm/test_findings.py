"""What a review found missing, each against brute force or by hand."""

import random
from collections import Counter

from fluvion.llm import line_dedup, ngram_join, pii, queries, setjoin, suffix_dedup

from .test_joins import brute_components, brute_lines, corpus, shingle_sets


def test_ngram_counts_every_link(spark, monkeypatch):
    rng = random.Random(8)
    word = lambda: f"v{rng.randrange(900)}"
    base, chain = [[word() for _ in range(90)] for _ in range(2)]
    texts = corpus()
    for _ in range(70):  # near copies, linked each to most others
        w = base[: rng.randrange(80, 91)]
        w[rng.randrange(len(w))] = word()
        texts.append(" ".join(w))
    for _ in range(30):  # a chain: each linked to those next to it only
        chain = [*chain[6:], *[word() for _ in range(6)]]
        texts.append(" ".join(chain))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    sets = shingle_sets(enumerate(texts))
    near = lambda a, b: a != b and 4 * len(a & b) >= 3 * len(a | b)
    every = {s for s in sets.values() if s}
    degree = {s: sum(near(s, o) for o in every) for s in every}
    assert max(degree.values()) > 50
    for block in (2000, 9):  # 9: components of many blocks
        monkeypatch.setattr(setjoin, "BLOCK_SETS", block, raising=False)
        got = {r.doc_id: r.n_links for r in ngram_join.near_duplicates(docs).collect()}
        assert got == {i: degree.get(s, 0) for i, s in sets.items()}


def test_pii_learns_from_one_word(spark):
    long = "z" * 70
    texts = [f"reach us {w} +49 171 55501{i:02d} today" for w in ("Fax", "phone", long) for i in range(30)]
    new = ["tel 0171 5550199 fax 0171 5550198", "Phone 555-0199", f"Phone {long} 0171 5550196", f"{long} 0171 5550195 now", "0171 5550194"]
    docs = spark.createDataFrame(list(enumerate(texts + new)), "doc_id long, text string")
    got = {r.doc_id: (r.spans, r.n_new) for r in pii.find_pii(docs).collect()}
    assert [got[len(texts) + k] for k in range(len(new))] == [("phone:21:33", 1), ("phone:6:14", 1), ("phone:77:89", 1), ("phone:71:83", 1), ("", 0)]
    assert all(got[i][1] == 0 for i in range(len(texts)))


def test_pii_keeps_whole_words_in_linear_time(spark):
    row = spark.createDataFrame([("a" * 400_000 + " " + "b" * 400_000 + " 12345678 " + "c" * 100,)], "text string")
    t = row.select(pii._tokens(row["text"])[0].alias("t")).first().t
    assert (t.hit, t.left, t.right) == ("12345678", "a" * 400_000 + " " + "b" * 400_000, "c" * 100)


def test_lines_by_place(spark):
    """Different texts under one id, or under none, keep what only they have."""
    one = "alpha beta gamma delta epsilon"
    rows = [(7, f"{one}\nonly the first text has this line"), (7, f"{one}\nnothing like it stands in the second"), (None, "a line of the first row without id"), (None, "other words in that row\n" + one), (3, one)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(r.text for r in line_dedup.dedup_lines(docs).collect())
    assert got == Counter([one, "only the first text has this line", "nothing like it stands in the second", "a line of the first row without id", "other words in that row"])
    found = line_dedup.with_lines(docs, line_dedup.find_duplicate_lines(docs))
    assert Counter((r.doc_id, r["__n"], tuple(r["__lines"])) for r in found.collect()) == Counter([(7, 2, (0,)), (7, 2, (0,)), (None, 1, ()), (None, 2, (1,)), (3, 1, ())])


def test_patterned_words(spark):
    """Words built by doubling, of equal letters at equal counts, are different words."""
    a = "".join("ab"[k.bit_count() & 1] for k in range(4096))
    b = a.translate(str.maketrans("ab", "ba"))
    docs = spark.createDataFrame([(1, a), (2, b), (3, a)], "doc_id long, text string")
    assert {r.doc: r.lines for r in line_dedup.find_duplicate_lines(docs).collect()} == {1: [], 2: [], 3: [0]}
    assert {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs).collect()} == {1: 1, 2: 2, 3: 1}


def test_wide_runs_and_blocks(spark, monkeypatch):
    """Every run met through hubs, and in the second pass cut into small blocks: the same result."""
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(60)}"
    base = [word() for _ in range(30)]
    rows = []
    for i in range(60):
        w = list(base) if i % 3 else [word() for _ in range(30)]
        for _ in range(rng.randrange(6)):
            w[rng.randrange(30)] = word()
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    gone = brute_lines(rows)
    want = brute_components(shingle_sets(rows))
    for wide, block in ((0, 7), (512, 7), (512, 100_000)):
        monkeypatch.setattr(setjoin, "WIDE", wide)
        monkeypatch.setattr(setjoin, "RUN_BLOCK", block)
        monkeypatch.setattr(setjoin, "MOST", 1)
        monkeypatch.setattr(setjoin, "EARLIEST", 1)
        assert {r.doc: r.lines for r in line_dedup.find_duplicate_lines(docs).collect() if r.lines} == gone
        assert {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs).collect()} == want


def test_passages_by_place(spark, tmp_path):
    """A short text that shares its id with a long one has none of its passages; rows without id have their own."""
    long = " ".join(f"w{k}" for k in range(60))
    rows = [(7, long), (7, "two words"), (None, "x " + long), (None, "y z"), (9, "short")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = Counter((r.doc_id, r.n_repeated, r.n_removed, r.removed) for r in queries.op9_suffix_dedup(spark, str(tmp_path)).collect())
    assert got == Counter([(7, 60, 0, ""), (7, 0, 0, ""), (None, 60, 60, "1:61"), (None, 0, 0, ""), (9, 0, 0, "")])
    assert Counter(r.text for r in suffix_dedup.remove_repeats(docs).collect()) == Counter([long, "two words", "x ", "y z", "short"])
    assert sum(r.n_removed for r in queries.op4_line_dedup(spark, str(tmp_path)).collect()) == 1
