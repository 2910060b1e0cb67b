"""Vocabulary lists: taxonomy words, top themes, top sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Longest list that is written into a plan as literals. Longer ones stay
# DataFrames and are joined.
LITERAL_LIMIT = 10_000


# Words come back as they were: blanks around them count, quotes are doubled.
_FORM = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def read_vocab(spark: SparkSession, path: str, key_col: str) -> DataFrame:
    """The key column of a CSV list with a header, whatever columns stand around it."""
    return spark.read.csv(path, **_FORM).select(key_col).dropna()


def write_vocab(df: DataFrame, path: str) -> None:
    """Write a list as CSV with a header, one file unless the list is large."""
    df.hint("rebalance").write.mode("overwrite").csv(path, quoteAll=True, **_FORM)


def small_list(df: DataFrame, limit: int = LITERAL_LIMIT) -> list[str] | DataFrame:
    """The single column of ``df`` as a list if it has at most ``limit`` rows.

    Never fetches more than ``limit + 1`` rows; a longer list comes back as the
    DataFrame it was, and every operator takes either form.
    """
    head = df.take(limit + 1)
    return df if len(head) > limit else [row[0] for row in head]
