"""Personal data: fixed patterns as seeds, then bootstrapped contextual extraction, all in DataFrame functions.

Seeds (e-mail addresses, IPv4 addresses, card numbers, phone numbers) are found in every whole text. Tokens that look
like identifiers are the instances; the words around them are lexical patterns. Over the graph of patterns and
instances, pre-aggregated to one edge for each pair, a pattern's confidence is the share of its instances that are
believed to be of a kind, and an instance's score is one minus the product of its patterns' doubts. After a few rounds,
instances of confident patterns become new spans where no seed lies.

Cases: null or empty texts have no spans; repeated rows get equal answers; several rows may share a doc_id or have none;
an empty table gives an empty table; columns other than the id and the text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import keep

KINDS = ("email", "ip", "card", "phone")
# Runs are tried from their first character only (look-behind, or where the last match ended) and never given back:
# the same matches as the plain patterns, in linear time on long runs.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: A token with a digit or an at sign, and groups of digits that follow it.
TOKEN = r"(?<!\S)(?=\S*[0-9@])\S++(?:\x20[0-9().-]++)*+"
#: Cheap tests that hold wherever the pattern can match.
GUARDS = {"email": ("@", None), "ip": (None, r"[0-9]\.[0-9]"), "card": (None, r"[0-9](?:[\x20-]?[0-9]){12}"), "phone": ("+", None)}


def spans(text: Column, pattern: str) -> Column:
    """Start, end (code points) and text of each match, by lengths of what lies between matches."""
    zipped = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"))
    nothing = F.array().cast("array<struct<start:int,end:int,hit:string>>")
    walked = F.aggregate(
        F.filter(zipped, lambda x: x["hit"].isNotNull()),
        F.struct(F.lit(0).alias("at"), nothing.alias("found")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("at"),
            F.concat(
                acc["found"],
                F.array(
                    F.struct(
                        (acc["at"] + F.length(x["gap"])).alias("start"),
                        (acc["at"] + F.length(x["gap"]) + F.length(x["hit"])).alias("end"),
                        x["hit"].alias("hit"),
                    )
                ),
            ).alias("found"),
        ),
    )
    return walked["found"]


def luhn(digits: Column) -> Column:
    r = F.reverse(digits)

    def digit(i: Column) -> Column:
        d = F.substring(r, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(r)), F.lit(0), lambda a, i: a + digit(i)) % 10 == 0


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(hit, r"\."), lambda p: F.coalesce(p.try_cast("int") <= 255, F.lit(False)))
    if kind == "card":
        return F.length(_digits(hit)).between(13, 19) & F.coalesce(luhn(_digits(hit)), F.lit(False))
    if kind == "phone":
        return F.length(_digits(hit)).between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    pattern = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}[kind]
    holds, like = GUARDS[kind]
    guard = text.contains(holds) if holds else text.rlike(like)
    none = F.array().cast("array<struct<start:int,end:int,hit:string>>")
    found = F.filter(spans(text, pattern), lambda s: _valid(kind, s["hit"]))
    return F.when(guard, found).otherwise(none)


def _instances(scanned: DataFrame) -> DataFrame:
    """One row for each identifier-like token: its place, its seed kind if a seed lies in it, its patterns."""
    rows = scanned.where(F.size("tokens") > 0).select("_id", "_th", "email", "ip", "card", "phone", F.explode("tokens").alias("t"))
    inside = lambda k: F.exists(F.col(k), lambda s: (s["start"] < F.col("t")["end"]) & (s["end"] > F.col("t")["start"]))
    kind = F.coalesce(*[F.when(inside(k), F.lit(k)) for k in KINDS])
    return rows.select("_id", "_th", F.col("t.start").alias("start"), F.col("t.end").alias("end"), F.col("t.hit").alias("token"), "t.left", "t.right", kind.alias("seed"))


def _tokens(text: Column) -> Column:
    """Identifier-like tokens with up to two words before and one after, as far as the text between tokens has them.

    Words are whole, however long. The text before is read backwards from the token, so no pattern is tried at every place.
    """
    found = spans(text, TOKEN)
    gaps = F.split(text, TOKEN, -1)
    none = F.array().cast("array<struct<start:int,end:int,hit:string,left:string,right:string>>")
    cut = F.transform(
        F.arrays_zip(found.alias("s"), F.slice(gaps, F.lit(1), F.size(found)).alias("before"), F.slice(gaps, F.lit(2), F.size(found)).alias("after")),
        lambda x: F.struct(
            x["s"]["start"].alias("start"),
            x["s"]["end"].alias("end"),
            x["s"]["hit"].alias("hit"),
            F.lower(F.reverse(F.regexp_extract(F.reverse(x["before"]), r"^\s*+(\S++(?:\s++\S++)?)", 1))).alias("left"),
            F.lower(F.regexp_extract(x["after"], r"^\s*+(\S++)", 1)).alias("right"),
        ),
    )
    return F.when(text.rlike("[0-9@]"), cut).otherwise(none)


def _fits(kind: str, token: Column) -> Column:
    """The least that a new identifier of a kind must look like."""
    n = F.length(_digits(token))
    if kind == "email":
        return token.rlike(r"^\S+@\S+$")
    return {"ip": token.rlike(r"^[0-9]{1,3}([.,:-][0-9]{1,3}){3}"), "card": n.between(12, 19), "phone": n.between(7, 15)}[kind]


def bootstrap(instances: DataFrame, rounds: int = 3, least_support: int = 3, least_confidence: float = 0.8, least_score: float = 0.9) -> DataFrame:
    """New spans: tokens that are no seeds, whose patterns the rounds came to trust. One row each, with its kind.

    The graph has one edge for each pattern and token, with its count; hot patterns and hot tokens are summed before
    any shuffle. Rounds read a written table, so lineage stays short and a lost executor costs one round.
    """
    last = F.regexp_replace("left", r"^\S++\s++", "")  # of the two words, or the only one
    pattern = F.explode(
        F.array_compact(
            F.array(
                F.when(F.col("left").rlike(r"\s"), F.concat(F.lit("L:"), F.col("left"))),
                F.when(F.col("left") != "", F.concat(F.lit("l:"), last)),
                F.when((F.col("left") != "") & (F.col("right") != ""), F.concat(F.lit("B:"), last, F.lit("_"), F.col("right"))),
            )
        )
    ).alias("pattern")
    edges = keep(instances.select(pattern, "token", "seed").groupBy("pattern", "token").agg(F.count("*").alias("n"), F.min("seed").alias("seed")), "pii_edges")
    kinds = F.array(*map(F.lit, KINDS))
    scores = None
    for _ in range(rounds):
        believed = edges.select("pattern", "token", F.col("seed").alias("kind"), F.when(F.col("seed").isNotNull(), 1.0).alias("score")).where("seed is not null")
        if scores is not None:
            believed = believed.unionByName(edges.where("seed is null").join(scores, "token").select("pattern", "token", "kind", "score"))
        size = edges.groupBy("pattern").agg(F.count("*").alias("all"))
        trusted = (
            believed.groupBy("pattern", "kind")
            .agg(F.sum("score").alias("mass"))
            .join(size, "pattern")
            .select("pattern", "kind", (F.col("mass") / F.col("all")).alias("confidence"), "mass")
            .where((F.col("mass") >= least_support) & (F.col("confidence") >= least_confidence))
        )
        scores = keep(
            edges.where("seed is null")
            .join(trusted, "pattern")
            .groupBy("token", "kind")
            .agg((1 - F.exp(F.sum(F.log1p(-F.least(F.col("confidence"), F.lit(0.999)))))).alias("score"))
            .where((F.col("score") >= least_score) & F.coalesce(*[F.when(F.col("kind") == k, _fits(k, F.col("token"))) for k in KINDS], F.lit(False))),
            "pii_scores",
        )
    best = scores.groupBy("token").agg(F.max_by("kind", F.struct("score", -F.array_position(kinds, F.col("kind")))).alias("kind"))
    return instances.where("seed is null").join(best, "token").select("_id", "_th", "kind", "start", "end")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """One row for each row of docs: counts and spans of the seeds, and all spans with those that bootstrapping found."""
    t = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(F.col(id_col).alias("_id"), t.alias("_t"), F.xxhash64(t).alias("_th"))
    scanned = keep(base.select("_id", "_th", *[base_spans(F.col("_t"), k).alias(k) for k in KINDS], _tokens(F.col("_t")).alias("tokens")), "pii_scan")
    new = bootstrap(_instances(scanned), **settings)
    per_doc = new.groupBy("_id", "_th").agg(F.collect_set(F.struct("kind", "start", "end")).alias("extra")).withColumnsRenamed({"_id": "_i2", "_th": "_t2"})
    joined = scanned.drop("tokens").join(per_doc, F.col("_id").eqNullSafe(F.col("_i2")) & (F.col("_th") == F.col("_t2")), "left")
    none = F.array().cast("array<struct<kind:string,start:int,end:int>>")
    extra = F.coalesce("extra", none)

    def said(k: str):
        return lambda s: F.concat_ws(":", F.lit(k), s["start"].cast("string"), s["end"].cast("string"))

    def every(k: str) -> Column:
        more = F.transform(F.filter(extra, lambda s: s["kind"] == k), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
        return F.sort_array(F.array_union(F.transform(F.col(k), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))), more))

    return joined.select(
        F.col("_id").alias(id_col),
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(F.concat_ws(",", *[F.transform(k, said(k)) for k in KINDS]), 256).alias("base_sha256"),
        F.concat_ws(",", *[F.transform(every(k), said(k)) for k in KINDS]).alias("spans"),
        F.size(extra).cast("long").alias("n_new"),
    )
