"""The three lists the tone jobs need, derived from the documents."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonetide.functions import first_two, has_digit, strip_commas, token_count, tokens
from tonetide.operators.vocabulary import (
    Vocabulary,
    clean_codes,
    distinct_themes,
    key_counts,
    top_k,
)
from tonetide.schemas import TAXONOMY_MIN_COUNT, TOP_SOURCES, TOP_THEMES


def taxonomy_words(
    documents: DataFrame,
    min_count: int = TAXONOMY_MIN_COUNT,
    extra: Iterable[str] = (),
) -> DataFrame:
    """Words that lead at least ``min_count`` distinct theme codes.

    Codes of one token and words holding a digit do not count. Words in ``extra``
    join the list with count 0 unless they made it on their own.
    """
    parts = distinct_themes(documents).select(strip_commas(tokens(F.col("theme"))).alias("parts"))
    words = (
        parts.where(token_count(F.col("parts")) > 1)
        .select(F.explode(first_two(F.col("parts"))).alias("first_two_themes"))
        .where(~has_digit(F.col("first_two_themes")))
    )
    found = key_counts(words, "first_two_themes", "count").where(F.col("count") >= min_count)
    extra = list(extra)
    if not extra:
        return found
    by_hand = documents.sparkSession.createDataFrame(
        [(word, 0) for word in extra], "first_two_themes STRING, count BIGINT"
    )
    return (
        found.unionByName(by_hand)
        .groupBy("first_two_themes")
        .agg(F.max("count").alias("count"))
    )


def theme_counts(documents: DataFrame, taxonomy: Vocabulary | None) -> DataFrame:
    """How often each cleaned theme occurs.

    Codes are counted first and cleaned after: there are few distinct codes, and
    cleaning is the costly part.
    """
    codes = key_counts(documents.select(F.explode("themes").alias("code")), "code", "occurrences")
    return (
        clean_codes(codes, taxonomy).groupBy("theme").agg(F.sum("occurrences").alias("num_mentions"))
    )


def top_themes(
    documents: DataFrame, taxonomy: Vocabulary | None, k: int = TOP_THEMES
) -> DataFrame:
    """Cleaned themes up to rank ``k`` by how often they occur."""
    return top_k(theme_counts(documents, taxonomy), "theme", "num_mentions", k)


def top_sources(documents: DataFrame, k: int = TOP_SOURCES) -> DataFrame:
    """Sources up to rank ``k`` by their number of documents."""
    return top_k(key_counts(documents, "src_common_name", "count"), "src_common_name", "count", k)
