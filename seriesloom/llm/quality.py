"""Quality rules: base counts, then a log-likelihood ratio of hashed word n-grams.

Word unigrams and bigrams are hashed to `BUCKETS` buckets. Two multinomials with add-one
smoothing are counted over them: one from trusted documents (labelled quality 1), one from
all documents. A document's score is the mean log ratio over its n-grams, and it is kept
if that reaches a threshold fixed by the labelled documents: the one that separates good
from bad labels best among those that keep `KEEP_SHARE` of the good ones.

Everything runs as DataFrame expressions; nothing leaves the JVM.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seriesloom.llm.base import cut_lineage, register, table
from seriesloom.llm.substrings import stored

BUCKETS = 10_000
#: Share of the trusted documents that the threshold keeps at least.
KEEP_SHARE = 0.995
#: Scores are compared in steps of this size.
STEP = 0.001

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


def with_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """__words (no empty ones) and __hashes of the whole text; a null text has none."""
    words = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "[ \\t-\\r]+"), lambda w: w != "")
    return docs.withColumn("__words", words).withColumn(
        "__hashes", F.transform("__words", lambda w: F.xxhash64(w))
    )


def _windows(n: int, fn) -> Column:
    """fn(i) for each window of n words; an empty array for shorter texts."""
    size = F.size("__hashes")
    return F.when(
        size >= n, F.transform(F.sequence(F.lit(0), size - n), fn)
    ).otherwise(F.array().cast("array<bigint>"))


def _word(i, k: int) -> Column:
    return F.get(F.col("__hashes"), i + k if k else i)


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed."""
    body = F.coalesce(F.col(text), F.lit(""))
    symbols = sum(
        (F.length(body) - F.length(F.replace(body, F.lit(c))) for c in SYMBOLS), F.lit(0)
    )
    lines = F.filter(F.split(body, "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    docs = (
        docs.withColumn("__lines", lines)
        .withColumn("__five", _windows(5, lambda i: F.xxhash64(*(_word(i, k) for k in range(5)))))
        .withColumn("__again", F.size("__five") > F.size(F.array_distinct("__five")))
    )
    # Only texts with a repeated window pay for the sort that finds the places.
    pairs = F.sort_array(
        F.transform("__five", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    )
    docs = docs.withColumn("__pairs", F.when(F.col("__again"), pairs))
    at = lambda k: F.get(F.col("__pairs"), k)
    twice = lambda k: (
        F.coalesce(at(k)["h"] == at(k - 1)["h"], F.lit(False))
        | F.coalesce(at(k)["h"] == at(k + 1)["h"], F.lit(False))
    )
    places = F.sort_array(
        F.transform(
            F.filter(F.sequence(F.lit(0), F.size("__pairs") - 1), twice), lambda k: at(k)["i"]
        )
    )
    docs = docs.withColumn("__places", F.when(F.col("__again"), places))
    covered = F.aggregate(
        F.sequence(F.lit(0), F.size("__places") - 1),
        F.lit(0).cast("long"),
        lambda n, k: n
        + F.coalesce(
            F.least(F.lit(5), F.get(F.col("__places"), k + 1) - F.get(F.col("__places"), k)),
            F.lit(5),
        ),
    )
    long = lambda c: c.cast("long")
    docs = docs.withColumns(
        {
            "n_words": long(F.size("__words")),
            "word_chars": long(F.length(F.array_join("__words", ""))),
            "n_symbols": long(symbols),
            "n_dup_lines": long(F.size("__lines") - F.size(F.array_distinct("__lines"))),
            "n_repeat_words": F.when(F.col("__again"), covered).otherwise(F.lit(0).cast("long")),
        }
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return docs.withColumn("base_failed", failed).drop(
        "__lines", "__five", "__again", "__pairs", "__places"
    )


def with_grams(docs: DataFrame) -> DataFrame:
    """__grams: bucket numbers of the unigrams and bigrams."""
    bucket = lambda *c: F.pmod(F.xxhash64(*c), F.lit(BUCKETS)).cast("int")
    two = F.when(
        F.size("__hashes") > 1,
        F.transform(
            F.sequence(F.lit(0), F.size("__hashes") - 2), lambda i: bucket(_word(i, 0), _word(i, 1))
        ),
    ).otherwise(F.array().cast("array<int>"))
    return docs.withColumn("__grams", F.concat(F.transform("__hashes", lambda h: bucket(h)), two))


def fit_labels(labels: DataFrame) -> DataFrame:
    """doc_id, trusted, model: every labelled document.

    model is 1 for the half (by a hash of the id) that the target model counts; the other half
    sets the threshold, which is thus met by documents that the model has not seen.

    Good means quality 1 and not toxic; a document with contradictory labels is not good.
    """
    good = (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0)
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.min(good.cast("int")).alias("trusted"))
        .withColumn("model", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int"))
    )


def _gram_counts(docs: DataFrame, name: str) -> DataFrame:
    """b, `name`: how often each bucket stands in `docs`."""
    # The plain explode would infer a filter on the n-grams and push it, with all that
    # they are made of, below the columns that share that work.
    return (
        with_grams(with_words(docs))
        .select(F.explode_outer("__grams").alias("b"))
        .where(F.col("b").isNotNull())
        .groupBy("b")
        .agg(F.count(F.lit(1)).alias(name))
    )


def fit_ratio(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """One row: __ratio, the log ratio of each bucket; raw counts are over all rows of `docs`."""
    target = labelled.where((F.col("model") == 1) & (F.col("trusted") == 1))
    raw, good = _gram_counts(docs, "raw"), _gram_counts(target, "good")
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("b"))
    full = every.join(raw, "b", "left").join(good, "b", "left").select(
        "b", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("raw", "good"))
    )
    # At most BUCKETS pairs meet here.
    listed = full.agg(
        F.sort_array(F.collect_list(F.struct("b", "raw", "good"))).alias("c"),
        F.sum("raw").alias("raw"),
        F.sum("good").alias("good"),
    )
    smooth = lambda n, total: (n + 1) / (total + BUCKETS)
    return listed.select(
        F.transform(
            "c",
            lambda x: F.log(smooth(x["good"], F.col("good")) / smooth(x["raw"], F.col("raw"))),
        ).alias("__ratio")
    )


def score(docs: DataFrame, ratio: DataFrame) -> DataFrame:
    """score: mean log ratio of the n-grams; 0 for a text without words."""
    values = ratio.first()["__ratio"]  # BUCKETS numbers
    model = F.lit(np.array(values))
    total = F.aggregate("__grams", F.lit(0.0), lambda s, b: s + F.get(model, b))
    return (
        with_grams(docs)
        .withColumn(
            "score",
            F.when(F.size("__grams") > 0, total / F.size("__grams")).otherwise(F.lit(0.0)),
        )
        .drop("__grams")
    )


def fit_threshold(scored: DataFrame) -> float:
    """The step that separates best among those that keep KEEP_SHARE of the good documents."""
    bins = (
        scored.groupBy(F.floor(F.col("score") / STEP).alias("bin"))
        .agg(F.sum("trusted").alias("good"), F.count(F.lit(1)).alias("n"))
        .orderBy("bin")
        .collect()  # one row a step: means of log ratios span some 50,000 steps at most
    )
    good = sum(r["good"] for r in bins)
    bad = sum(r["n"] for r in bins) - good
    best, cut, lost, gone = 0.0, float("-inf"), 0, 0
    for r in bins:
        gain = gone / max(bad, 1) - lost / max(good, 1)
        if gain > best and lost <= (1 - KEEP_SHARE) * good:
            best, cut = gain, r["bin"] * STEP
        lost += r["good"]
        gone += r["n"] - r["good"]
    return cut


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """`docs` with the base counts, base_failed, score and kept.

    Null and empty texts have no words and fail; repeated rows are judged each; without
    labels the two models agree and only the base rules decide; an empty table gives an
    empty result. Names that begin with "__" are reserved, and own columns of the names
    added here are replaced.
    """
    narrow = docs.select("doc_id", "text")
    # Stored, as the model and the threshold read it. The labels grow with the documents, so
    # they meet in a shuffle at any size.
    labelled = stored(narrow.join(cut_lineage(fit_labels(labels)).hint("merge"), "doc_id"))
    ratio = cut_lineage(fit_ratio(narrow, labelled))
    cut = fit_threshold(score(with_words(labelled.where("model = 0")), ratio))
    out = score(base_counts(with_words(docs)), ratio).drop("__words", "__hashes")
    # As in the fit, scores count by whole steps.
    good = F.lit(True) if cut == float("-inf") else F.floor(F.col("score") / STEP) >= round(cut / STEP)
    return out.withColumn("kept", ~F.col("base_failed") & good)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of `docs` that `judge` keeps, with their own columns."""
    own = {c: f"__own{k}" for k, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    # The row number stops the filter from being pushed below the columns that share work.
    out = judge(docs.withColumnsRenamed(own), labels).withColumn("__at", F.monotonically_increasing_id())
    out = out.where(F.col("kept") & (F.col("__at") >= 0))
    return out.select(*(F.col(own.get(c, c)).alias(c) for c in docs.columns))


@register("op5_quality")
def op5_quality(spark, sf_dir):
    """Counts and verdict for every document."""
    out = judge(
        table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    )
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "score",
    )
