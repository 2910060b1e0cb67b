"""Tone per theme and time, over all sources or per source."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tonetide.operators import theme_tones, tone_stats, tone_stats_multi
from tonetide.operators.vocabulary import Vocabulary
from tonetide.schemas import STATS_COLUMNS, THEME_DAY_KEYS, THEME_DAY_SOURCE_KEYS


def theme_tone(
    mentions: DataFrame,
    documents: DataFrame,
    taxonomy: Vocabulary | None = None,
    themes: Vocabulary | None = None,
    few_documents: bool = False,
) -> DataFrame:
    """Statistics per theme and time, at whatever grain the mentions were read.

    Without ``taxonomy`` the raw codes are the themes; without ``themes`` all of
    them are kept. ``few_documents`` as in :func:`theme_tones`.
    """
    rows = theme_tones(
        mentions, documents, taxonomy, themes, by_source=False, few_documents=few_documents
    )
    stats = tone_stats(rows, THEME_DAY_KEYS, weight="weight")
    return stats.select("theme", *STATS_COLUMNS, "time")


def theme_day_tone(
    mentions: DataFrame, documents: DataFrame, taxonomy: Vocabulary, themes: Vocabulary
) -> DataFrame:
    """Statistics per theme and day over all sources, themes cleaned and selected."""
    return theme_tone(mentions, documents, taxonomy, themes)


def theme_day_source_tone(
    mentions: DataFrame,
    documents: DataFrame,
    taxonomy: Vocabulary,
    themes: Vocabulary,
    sources: Vocabulary,
) -> DataFrame:
    """Statistics per theme, day and selected source."""
    rows = theme_tones(mentions, documents, taxonomy, themes, sources)
    stats = tone_stats(rows, THEME_DAY_SOURCE_KEYS, weight="weight")
    return stats.select("theme", "src_common_name", *STATS_COLUMNS, "time")


def tone_tables(
    mentions: DataFrame,
    documents: DataFrame,
    taxonomy: Vocabulary,
    themes: Vocabulary,
    sources: Vocabulary,
    few_documents: bool = False,
) -> DataFrame:
    """Both result tables in one pass, told apart by ``grain``."""
    rows = theme_tones(mentions, documents, taxonomy, themes, few_documents=few_documents)
    return tone_stats_multi(rows, sources, weight="weight")
