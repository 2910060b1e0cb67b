"""Result tables kept up batch by batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonetide.operators import theme_tones, tone_stats
from tonetide.operators.vocabulary import Vocabulary, filter_to_vocab
from tonetide.schemas import STATS_COLUMNS, THEME_DAY_KEYS, THEME_DAY_SOURCE_KEYS
from tonetide.sources.ledger import add_batch, read_ledger
from tonetide.sources.lines import read_mentions
from tonetide.sources.tables import write_stats


def ledger_stats(rows: DataFrame, sources: Vocabulary | None = None, by_source: bool = False) -> DataFrame:
    """A result table from rows of the ledger."""
    keys = THEME_DAY_KEYS
    names = ["theme"]
    if by_source:
        keys, names = THEME_DAY_SOURCE_KEYS, ["theme", "src_common_name"]
        if sources is not None:
            rows = filter_to_vocab(rows, "src_common_name", sources)
    return tone_stats(rows, keys, weight="weight").select(*names, *STATS_COLUMNS, "time")


def add_mention_files(
    spark: SparkSession,
    ledger: str,
    files: Sequence[str],
    documents: DataFrame,
    taxonomy: Vocabulary,
    themes: Vocabulary,
    theme_day: str | None = None,
    theme_day_source: str | None = None,
    sources: Vocabulary | None = None,
) -> list[str]:
    """Take mention files in and bring the tables of the touched days up to date.

    Files that are in already are skipped. The tables are written from whole days of the
    ledger, so four files of a quarter of an hour give what one file of the hour gives.
    Returns the days that changed. Run again after a failure, it goes on: files that made
    it into the ledger only have their tables rewritten when other files touch the day;
    :func:`refresh_tables` writes them for given days.
    """
    days = add_batch(
        spark,
        ledger,
        files,
        lambda new: theme_tones(read_mentions(spark, new), documents, taxonomy, themes),
    )
    refresh_tables(spark, ledger, days, theme_day, theme_day_source, sources)
    return days


def refresh_tables(
    spark: SparkSession,
    ledger: str,
    days: Sequence[str],
    theme_day: str | None = None,
    theme_day_source: str | None = None,
    sources: Vocabulary | None = None,
) -> None:
    """Write the given days of the result tables from the ledger."""
    if not days:
        return
    rows = read_ledger(spark, ledger, days)
    if theme_day:
        write_stats(ledger_stats(rows), theme_day)
    if theme_day_source:
        write_stats(ledger_stats(rows.where(F.col("src_common_name").isNotNull()), sources, True), theme_day_source)
