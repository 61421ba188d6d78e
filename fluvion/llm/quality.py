"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Cases: a null or empty text has no words and fails the length rule; rows are judged one by one, so repeated
rows get equal answers; an empty table gives an empty table; other columns of the input are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters that separate words, and the symbols that are counted.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
SPLIT = r"[\x20\x09-\x0D]+"

# Common function words of the four languages that the rules know.
STOP_WORDS = [
    "the", "be", "to", "of", "and", "that", "have", "with", "is", "in", "for", "it", "as", "by", "on", "are", "this",
    "le", "la", "les", "de", "des", "du", "et", "en", "un", "une", "que", "qui", "dans", "pour", "par", "sur", "au",
    "der", "die", "das", "und", "den", "dem", "ein", "von", "zu", "mit", "ist", "im", "nicht", "auf",
    "el", "los", "las", "del", "y", "una", "por", "con", "para", "se", "su",
]


@dataclass(frozen=True)
class Rule:
    """measure/base must lie within [low, high]; base None means the measure itself."""

    name: str
    measure: str
    base: str | None
    low: float | None
    high: float | None
    scale: int = 1


#: The production table. Ratios are compared as integers: scale * measure against bound * base.
RULES = (
    Rule("length_words", "n_words", None, 50, 200_000),
    Rule("mean_word_length", "word_chars", "n_words", 2, 14),
    Rule("symbol_ratio", "n_symbols", "n_words", None, 10, 100),
    Rule("stop_words", "n_stop_words", None, 2, None),
    Rule("duplicate_lines", "n_dup_lines", "n_lines", None, 30, 100),
    Rule("repeated_words", "n_repeat_words", "n_words", None, 50, 100),
    Rule("ellipsis_lines", "n_ellipsis_lines", "n_lines", None, 30, 100),
    Rule("bullet_lines", "n_bullet_lines", "n_lines", None, 90, 100),
)


def compile_rule(r: Rule) -> Column:
    """True where a document breaks the rule. A base of 0 breaks no ratio rule."""
    value = F.col(r.measure).cast("long") * r.scale
    base = F.lit(1) if r.base is None else F.col(r.base)
    broken = F.lit(False)
    if r.low is not None:
        broken = broken | (value < base * F.lit(r.low))
    if r.high is not None:
        broken = broken | (value > base * F.lit(r.high))
    return broken


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every measure that rules may name, by built-in functions alone.

    n_repeat_words: runs of three words are hashed to 64 bits with their places and sorted; equal neighbours mark their
    places, and places marked count up to the next mark, three at most. Sorting keeps long texts at n log n.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col), text.alias("_t"))
    split = base.select(
        id_col,
        "_t",
        F.filter(F.split("_t", SPLIT, -1), lambda w: w != "").alias("_w"),
        F.filter(F.split("_t", "\n", -1), lambda x: F.length(F.translate(x, SPACE_CHARS, "")) > 0).alias("_l"),
    )
    hashed = split.withColumn(
        "_h",
        F.when(
            F.size("_w") >= 3,
            F.transform(
                F.slice(F.col("_w"), F.lit(1), F.greatest(F.size("_w") - 2, F.lit(0))),
                lambda w, i: F.xxhash64(w, F.get(F.col("_w"), i + 1), F.get(F.col("_w"), i + 2)),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    )
    counted = hashed.select(
        id_col,
        F.size("_w").cast("long").alias("n_words"),
        F.length(F.translate("_t", SPACE_CHARS, "")).cast("long").alias("word_chars"),
        (F.length("_t") - F.length(F.translate("_t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("_l").cast("long").alias("n_lines"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        F.size(F.filter("_l", lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))).cast("long").alias("n_ellipsis_lines"),
        F.size(F.filter("_l", lambda x: F.ltrim(x).rlike("^[-*•]"))).cast("long").alias("n_bullet_lines"),
        F.when(F.arrays_overlap(F.col("_w"), F.array(*map(F.lit, STOP_WORDS))), F.size(F.array_intersect(F.col("_w"), F.array(*map(F.lit, STOP_WORDS))))).otherwise(F.lit(0)).cast("long").alias("n_stop_words"),
        F.when(
            F.size(F.array_distinct("_h")) < F.size("_h"),
            F.sort_array(F.transform("_h", lambda x, i: F.struct(x.alias("h"), i.alias("i")))),
        ).alias("_s"),
    )
    marked = counted.withColumn(
        "_p",
        F.sort_array(
            F.transform(
                F.filter(
                    "_s",
                    lambda x, j: F.coalesce(x["h"] == F.get(F.col("_s"), j + 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(F.col("_s"), j - 1)["h"], F.lit(False)),
                ),
                lambda x: x["i"],
            )
        ),
    ).drop("_s")
    gap = F.transform("_p", lambda x, j: F.least(F.lit(3), F.coalesce(F.get(F.col("_p"), j + 1) - x, F.lit(3))))
    return marked.withColumn("n_repeat_words", F.coalesce(F.aggregate(gap, F.lit(0).cast("long"), lambda a, x: a + x), F.lit(0)).cast("long")).drop("_p")


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The measures, base_failed, kept and the names of the broken rules, one row for each row of docs."""
    m = measures(docs, id_col, text_col)
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    broken = F.array_compact(F.array(*[F.when(compile_rule(r), F.lit(r.name)) for r in rules]))
    out = m.withColumns({"base_failed": base_failed, "broken_rules": broken})
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("broken_rules") == 0))
