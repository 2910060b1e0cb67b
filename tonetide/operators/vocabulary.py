"""Counting keys, ranking them, filtering by a list, cleaning codes."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonetide.functions import clean_theme, has_digit, once, strip_comma, strip_commas, tokens
from tonetide.functions.themes import PREFIX_TOKENS

Vocabulary = Iterable[str] | DataFrame

# A join side of at most this many rows by construction is broadcast outright;
# anything else is left to the sizes adaptive execution measures.
BROADCAST_ROWS = 100_000


def key_counts(df: DataFrame, key: str, count_name: str) -> DataFrame:
    """How often each key occurs."""
    return df.groupBy(key).agg(F.count("*").alias(count_name))


def distinct_themes(documents: DataFrame) -> DataFrame:
    """Every theme code that occurs, once."""
    return documents.select(F.explode("themes").alias("theme")).distinct()


def filter_to_vocab(df: DataFrame, col: str, vocab: Vocabulary) -> DataFrame:
    """Rows whose ``col`` is in the list.

    A Python list becomes a literal set the scan can use; a DataFrame (its first
    column) becomes a semi join.
    """
    if isinstance(vocab, DataFrame):
        keys = vocab.select(F.col(vocab.columns[0]).alias(col))
        return df.join(keys, col, "left_semi")
    return df.where(F.col(col).isin(*sorted(set(vocab))))


def top_k(counts: DataFrame, key: str, count_col: str, k: int) -> DataFrame:
    """Keys of rank ``k`` or better by descending count, ties sharing a rank.

    The empty key takes its rank and is then left out, so ``k`` bounds ranks, not
    rows. Ranks are worked out on the distinct counts rather than on the keys: at
    most ``k`` of those matter, so however many keys tie, only ``k`` rows ever meet
    in one task and the keys themselves stay where they are.
    """
    levels = (
        counts.groupBy(count_col)
        .agg(F.count("*").alias("keys_at_level"))
        .orderBy(F.desc(count_col))
        .limit(k)
    )
    above = Window.orderBy(F.desc(count_col)).rowsBetween(Window.unboundedPreceding, -1)
    ranks = levels.select(
        count_col,
        (F.coalesce(F.sum("keys_at_level").over(above), F.lit(0)) + 1).alias("rank"),
    ).where(F.col("rank") <= k)
    if k <= BROADCAST_ROWS:
        ranks = F.broadcast(ranks)
    # Pinned so that the filter stays above the join. Pushed into the counting, it
    # would make the two readers of `counts` differ and scan the input twice.
    ranked = counts.join(ranks, count_col).select(
        once(F.struct(key, count_col, "rank")).alias("row")
    )
    return ranked.select("row.*").where(F.col(key) != "")


def clean_codes(codes: DataFrame, taxonomy: Vocabulary | None) -> DataFrame:
    """Add ``theme``, the cleaned form of column ``code``.

    A taxonomy given as a DataFrame is joined to the leading tokens instead of
    being written into the plan, so it may be of any size.
    """
    if taxonomy is None:
        return codes.withColumn("theme", F.col("code"))
    if not isinstance(taxonomy, DataFrame):
        return codes.withColumn("theme", clean_theme(F.col("code"), taxonomy))

    words = taxonomy.select(F.col(taxonomy.columns[0]).alias("word")).distinct()
    lead = [f"lead{i}" for i in range(PREFIX_TOKENS)]
    marked = codes.withColumns(
        {name: strip_comma(F.get(tokens(F.col("code")), F.lit(i))) for i, name in enumerate(lead)}
    )
    for name in lead:
        hits = words.select(F.col("word").alias(name), F.lit(True).alias(f"{name}_listed"))
        marked = marked.join(hits, name, "left")
    dropped = F.array(
        *[F.coalesce(F.col(f"{name}_listed"), has_digit(F.col(name))) for name in lead]
    )
    kept = F.filter(
        tokens(F.col("code")),
        lambda token, i: (i >= PREFIX_TOKENS) | ~F.get(dropped, i),
    )
    theme = F.when(
        F.contains("code", F.lit("_")), F.array_join(strip_commas(kept), "_")
    ).otherwise(strip_comma(F.col("code")))
    return marked.select(*codes.columns, theme.alias("theme"))
