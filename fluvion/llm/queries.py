"""The queries of this folder's operators, one for each, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import line_dedup, mixing, ngram_join, packing, pii, quality, suffix_dedup, topk, toxicity, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, lines with words, and the numbers (from 0) of the lines that go, for every document."""
    docs = _table(spark, sf_dir, "documents")
    out = line_dedup.with_lines(docs.select("doc_id", "text"), line_dedup.find_duplicate_lines(docs))
    gone = F.coalesce("__lines", F.array().cast("array<long>"))
    return out.select("doc_id", F.coalesce("__n", F.lit(0)).cast("long").alias("n_lines"), F.size(gone).cast("long").alias("n_removed"), F.array_join(gone, ",").alias("removed_lines"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "n_links")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    return quality.quality_rules(_table(spark, sf_dir, "documents")).select(*columns)


def op8_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every document: words in passages of 50 and more that repeat anywhere, words with an earlier occurrence, and
    both as word spans (from 0, end exclusive)."""
    docs = _table(spark, sf_dir, "documents")
    out = suffix_dedup.with_passages(docs.select("doc_id", "text"), suffix_dedup.repeated_passages(docs))

    def words(name: str):
        return F.coalesce(F.aggregate(name, F.lit(0).cast("long"), lambda a, s: a + s[1] - s[0]), F.lit(0).cast("long"))

    def spans(name: str):
        return F.coalesce(F.array_join(F.transform(name, lambda s: F.concat_ws(":", s[0].cast("string"), s[1].cast("string"))), ","), F.lit(""))

    return out.select("doc_id", words("__repeated").alias("n_repeated"), words("__removed").alias("n_removed"), spans("__repeated").alias("repeated"), spans("__removed").alias("removed"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.write_archive(_table(spark, sf_dir, "pages"))
    return warc.read_archive(spark, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_pii": op2_pii,
    "op3_toxicity": op3_toxicity,
    "op4_line_dedup": op4_line_dedup,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_mixing": op6_mixing,
    "op7_quality_rules": op7_quality_rules,
    "op8_exact_top_k": op8_exact_top_k,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_warc": op10_warc,
}

_STOP = ", ".join(f"'{w}'" for w in dict.fromkeys(quality.STOP_WORDS))

ORACLE_SQL: dict[str, str] = {
    "op7_quality_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
p AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM w WHERE len(w) >= 3),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS n FROM p),
r AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM g, (VALUES (0), (1), (2)) o(k) WHERE n > 1 GROUP BY 1),
m AS (SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
 CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(len(l) AS BIGINT) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
 len(list_filter(l, lambda x: regexp_matches(x, '(\.\.\.|…) *$'))) AS ell, len(list_filter(l, lambda x: regexp_matches(x, '^ *[-*•]'))) AS bul, len(list_intersect(w, [{_STOP}])) AS stop
 FROM w LEFT JOIN r ON r.doc_id = w.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
 NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND n_words <= 200000 AND word_chars >= 2 * n_words AND word_chars <= 14 * n_words AND 100 * n_symbols <= 10 * n_words AND stop >= 2
 AND 100 * n_dup_lines <= 30 * n_lines AND 100 * ell <= 30 * n_lines AND 100 * bul <= 90 * n_lines AS kept FROM m""",
    "op8_exact_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s) WHERE n <= 5""",
}
