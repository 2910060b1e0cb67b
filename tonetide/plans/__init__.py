"""Whole jobs."""

from tonetide.plans.increments import add_mention_files, ledger_stats, refresh_tables
from tonetide.plans.rebuild import (
    learn_sources,
    learn_taxonomy,
    learn_themes,
    run_all,
    write_theme_tone,
)
from tonetide.plans.tone_jobs import (
    theme_day_source_tone,
    theme_day_tone,
    theme_tone,
    tone_tables,
)
from tonetide.plans.vocab_jobs import taxonomy_words, top_sources, top_themes

__all__ = [
    "add_mention_files",
    "learn_sources",
    "learn_taxonomy",
    "learn_themes",
    "ledger_stats",
    "refresh_tables",
    "run_all",
    "taxonomy_words",
    "theme_day_source_tone",
    "theme_day_tone",
    "theme_tone",
    "tone_tables",
    "top_sources",
    "top_themes",
    "write_theme_tone",
]
