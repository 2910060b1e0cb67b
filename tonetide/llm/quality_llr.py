"""Quality rules and a hashed n-gram log-likelihood ratio.

Native: every step is a DataFrame expression. Words and pairs of neighbouring words
fall into BUCKETS by hash. Two multinomials over the buckets, one of trusted
documents and one of the whole corpus, give each bucket the logarithm of their
ratio; a document scores the mean over its n-grams, so length doesn't matter, and
is kept if it doesn't score below a threshold, always the same for every document.
The buckets are a table of one row whatever the corpus holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonetide.functions import once
from tonetide.llm.common import SPACES, WORD, keep

BUCKETS = 10_000
# Added to every bucket's raw count, so that none is impossible.
PRIOR = 1.0
# N-grams of the raw corpus that the trusted ones are mixed with: with little trusted
# text all ratios stay near one.
BACKED = 10.0 * BUCKETS
# Mean log-likelihood ratio below which a document is rejected.
THRESHOLD = -0.06
# Trusted documents used at most, those with the smallest hashes.
TRUSTED_ROWS = 20_000
RUN = 5
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20


def _words(text: Column) -> Column:
    return F.coalesce(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _buckets(h: str) -> str:
    """SQL for the buckets of all words and pairs of words of the array ``h``."""
    pairs = f"zip_with(slice({h}, 1, size({h}) - 1), slice({h}, 2, size({h}) - 1), (a, b) -> xxhash64(a, b))"
    pairs = f"CASE WHEN size({h}) > 1 THEN {pairs} ELSE CAST(array() AS ARRAY<BIGINT>) END"
    return f"transform(concat({h}, {pairs}), x -> CAST(pmod(x, {BUCKETS}) AS INT))"


def bucket_weights(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """One row: ``weights``, the log-ratio of the two multinomials for every bucket.

    ``trusted`` holds ``doc_id`` of trusted documents, at most TRUSTED_ROWS rows.
    """
    marked = docs.join(
        F.broadcast(trusted.select("doc_id", F.lit(1).alias("_trusted"))), "doc_id", "left"
    )
    grams = marked.select(
        F.coalesce("_trusted", F.lit(0)).alias("t"), once(_hashes(_words(F.col("text")))).alias("h")
    ).select("t", F.explode(F.expr(_buckets("h"))).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("t").alias("target"))
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    full = every.join(counts, "bucket", "left").select(
        "bucket",
        (F.coalesce("raw", F.lit(0)) + PRIOR).alias("raw"),
        F.coalesce("target", F.lit(0)).cast("double").alias("target"),
    )
    share = "(x.raw / total.raw)"
    listed = full.agg(
        F.array_sort(F.collect_list(F.struct("bucket", "raw", "target"))).alias("c"),
        F.struct(F.sum("raw").alias("raw"), F.sum("target").alias("target")).alias("total"),
    )
    return listed.select(
        F.expr(
            f"transform(c, x -> ln((x.target + {BACKED}D * {share}) / (total.target + {BACKED}D))"
            f" - ln({share}))"
        ).alias("weights")
    )


def _repeat_words(w: str) -> str:
    """SQL: how many words stand in runs of RUN words that occur twice or more.

    ``w`` holds the hash of the run at each position. Sorted with their positions,
    equal runs are neighbours; the words under all such positions are then counted
    from left to right.
    """
    positions = f"""transform(array(array_sort(transform({w}, (h, i) -> named_struct('h', h, 'i', i)))),
        s -> array_sort(transform(
            filter(sequence(0, size(s) - 1),
                   j -> s[j].h <=> get(s, j - 1).h OR s[j].h <=> get(s, j + 1).h),
            j -> s[j].i)))[0]"""
    return f"""CASE WHEN size(array_distinct({w})) < size({w}) THEN
        aggregate({positions}, named_struct('n', 0L, 'end', 0),
            (t, p) -> named_struct('n', t.n + p + {RUN} - greatest(t.end, p), 'end', p + {RUN}),
            t -> t.n) ELSE 0L END"""


def judge(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Counts, ``base_failed``, ``score`` and ``kept`` for every row of ``docs``.

    ``docs`` needs ``doc_id`` and ``text``, ``trusted`` column ``doc_id``. A null or
    blank text has no words and fails the base rules. Rows are judged one by one,
    so repeated rows and null ids need no rule. Without trusted rows or documents,
    all n-grams weigh nearly the same. Other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    picked = (
        trusted.select("doc_id")
        .where("doc_id IS NOT NULL")
        .distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(TRUSTED_ROWS)
    )
    weights = keep(bucket_weights(docs, picked), "weights").scalar()
    runs = ", ".join(f"get(h, i + {k})" for k in range(1, RUN))
    text = F.coalesce("text", F.lit(""))
    full_lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, SPACES, "") != "")
    rows = (
        docs.select("doc_id", "text", once(_hashes(_words(F.col("text")))).alias("h"))
        .select(
            "doc_id",
            F.size("h").cast("long").alias("n_words"),
            F.length(F.translate(text, SPACES, "")).cast("long").alias("word_chars"),
            (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            once(full_lines).alias("lines"),
            "h",
        )
        .select(
            "doc_id",
            "n_words",
            "word_chars",
            "n_symbols",
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            once(
                F.expr(
                    f"CASE WHEN size(h) >= {RUN} THEN transform(slice(h, 1, size(h) - {RUN - 1}), "
                    f"(x, i) -> xxhash64(x, {runs})) ELSE CAST(array() AS ARRAY<BIGINT>) END"
                )
            ).alias("runs"),
            "h",
            once(F.expr(_buckets("h"))).alias("b"),
        )
    )
    total = F.aggregate("b", F.lit(0.0), lambda s, x: s + F.get(F.col("_weights"), x))
    scored = rows.withColumn("_weights", weights).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.expr(_repeat_words("runs")).alias("n_repeat_words"),
        F.when(F.size("b") > 0, total / F.size("b")).alias("score"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")
    )
    return scored.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & F.coalesce(F.col("score") >= threshold, F.lit(False))
    )
