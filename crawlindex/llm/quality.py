"""Quality rules on built-in functions alone: fixed text counts, and the
likelihood ratio of hashed n-grams between trusted and raw text.

Every document's words and word pairs fall into BUCKETS hash buckets. Counts of
all raw documents and of trusted ones give two multinomials; a document's
score is the sum of its n-grams' log ratios, divided by their number. The
bucket weights are a table of fixed size, so they go into the plan as a literal.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 16
TRUSTED_ROWS = 20_000  # trusted documents the target is fitted on, at most
PRIOR = 12.0  # n-grams of either multinomial assumed in advance, per bucket
SHORT = 20.0  # n-grams of ratio 0 added to every document, against chance
THRESHOLD = -0.1  # documents with a lower score are rejected
MIN_WORDS = 10
WINDOW = 5
MAX_REPEAT_PERCENT = 20


def words(text: str | Column) -> Column:
    """Runs of anything but ASCII white space. Null text has none."""
    text = F.col(text) if isinstance(text, str) else text
    pieces = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.filter(pieces, lambda w: w != "")


def _ngrams(words: Column) -> Column:
    """Buckets of the words and of the pairs of neighbours."""
    single = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))
    pairs = F.transform(
        words,
        lambda w, i: F.pmod(F.xxhash64(w, F.get(words, i + 1)), F.lit(BUCKETS)).cast("int"),
    )
    return F.concat(single, F.slice(pairs, 1, F.greatest(F.size(words) - 1, F.lit(0))))


def ngram_weights(docs: DataFrame, labels: DataFrame) -> list[float]:
    """log(trusted / raw) for each bucket; 0 where nothing tells.

    Raw counts take in all of `docs`. The trusted ones are those labelled of
    good quality and not toxic, TRUSTED_ROWS of them at most, by a hash of the
    id; this bounds the broadcast list of ids. Without any, all weights are 0.
    """
    trusted = (
        labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL")
        .select("doc_id")
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRUSTED_ROWS)
        .withColumn("trusted", F.lit(1))
    )
    grams = (
        docs.select("doc_id", words("text").alias("words"))
        .join(F.broadcast(trusted), "doc_id", "left")
        .select("trusted", F.explode(_ngrams(F.col("words"))).alias("bucket"))
    )
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("trusted").alias("good"))
    raw, good = [0] * BUCKETS, [0] * BUCKETS
    for row in counts.collect():  # BUCKETS rows at most
        raw[row["bucket"]], good[row["bucket"]] = row["raw"], row["good"] or 0
    share = sum(good) / max(1, sum(raw))
    return [
        round(math.log((g + PRIOR) / (r * share + PRIOR)), 4) if share else 0.0
        for r, g in zip(raw, good, strict=True)
    ]


def likelihood_ratio(words: Column, weights: list[float]) -> Column:
    """Mean log ratio of the n-grams; 0 for no words."""
    table = F.expr(f"cast(split('{','.join(map(str, weights))}', ',') AS array<double>)")
    grams = _ngrams(words)
    total = F.aggregate(grams, F.lit(0.0), lambda acc, g: acc + F.get(table, g))
    return total / (F.greatest(2 * F.size(words) - 1, F.lit(0)) + SHORT)


def _repeated(words: Column) -> Column:
    """Number of words in windows that occur twice or more.

    Windows are sorted by hash; those equal to a neighbour stay, by position.
    Each then adds the words up to the next one's start, WINDOW at most.
    """
    last = F.size(words) - WINDOW
    windows = F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.struct(
                F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]).alias("h"),
                i.alias("i"),
            ),
        ),
    )
    return F.sort_array(windows)


def text_counts(docs: DataFrame, *keep: Column | str) -> DataFrame:
    """The kept columns with words, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words and base_failed. Null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(
        F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    )
    first = docs.select(
        *keep,
        words("text").alias("words"),
        (F.length(text) - F.length(F.regexp_replace(text, r"[#*$%&|<>]+", ""))).alias("n_symbols"),
        lines.alias("lines"),
    )
    kept = [c for c in first.columns if c not in ("words", "lines", "n_symbols")]
    second = first.select(
        *kept,
        "words",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated(F.col("words")).alias("windows"),
    )
    starts = F.filter(
        F.transform(
            "windows",
            lambda w, k: F.when(
                (w["h"] == F.get(F.col("windows"), k - 1)["h"])
                | (w["h"] == F.get(F.col("windows"), k + 1)["h"]),
                w["i"],
            ),
        ),
        lambda i: i.isNotNull(),
    )
    third = second.select("*", F.sort_array(starts).alias("starts")).drop("windows")
    covered = F.aggregate(
        F.transform(
            "starts",
            lambda i, k: F.least(
                F.lit(WINDOW), F.coalesce(F.get(F.col("starts"), k + 1) - i, F.lit(WINDOW))
            ),
        ),
        F.lit(0),
        lambda acc, n: acc + n,
    )
    fourth = third.select("*", F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")
    )
    return fourth.drop("starts").withColumn("base_failed", failed)


def quality_rules(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of `docs`: the counts, base_failed, score and kept.

    A document is kept if the base rules pass it and its likelihood ratio
    reaches THRESHOLD. Null and empty texts have no words and fail. Repeated
    rows and null ids give rows of their own; empty tables give no rows, and
    empty labels pass whatever the base rules pass.
    """
    weights = ngram_weights(docs, labels)
    counts = text_counts(docs, "doc_id")
    scored = counts.withColumn("score", likelihood_ratio(F.col("words"), weights))
    return scored.drop("words").withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= THRESHOLD)
    )


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that the rules keep, as they are."""
    weights = ngram_weights(docs, labels)
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("__row")
    counts = text_counts(docs, row)
    ratio = likelihood_ratio(F.col("words"), weights)
    # A random number beside the verdict keeps the optimizer from moving the
    # filter down and so working out all counts anew for each use of them.
    judged = counts.select(
        "__row",
        (~F.col("base_failed") & (ratio >= THRESHOLD)).alias("kept"),
        F.rand(0).alias("number"),
    )
    return judged.where("kept AND number >= 0").select("__row.*")
