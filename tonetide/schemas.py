"""Layout of the feeds and of the result tables.

The numbers and names below are fixed values: they describe files and tables
that exist outside this repository.
"""

from __future__ import annotations

# -- fixed values: feed layouts (field count, 0-based positions) ---------------

MENTION_WIDTH = 16
MENTION_FIELDS = {
    "event_id": 0,
    "event_time_date": 1,
    "mention_time_date": 2,
    "mention_src_name": 4,
    "mention_id": 5,
    "mention_doc_tone": 13,
}

DOCUMENT_WIDTH = 27
DOCUMENT_FIELDS = {
    "src_common_name": 3,
    "doc_id": 4,
    "themes": 7,
}

# -- fixed values: which fields a job insists on being non-empty ---------------

MENTION_REQUIRED = ("mention_time_date", "mention_id", "mention_doc_tone")
MENTION_REQUIRED_WIDE = (
    "event_id",
    "event_time_date",
    "mention_time_date",
    "mention_src_name",
    "mention_id",
    "mention_doc_tone",
)
DOCUMENT_REQUIRED = ("src_common_name", "doc_id", "themes")
DOCUMENT_REQUIRED_THEMES = ("themes",)
DOCUMENT_REQUIRED_SOURCE = ("src_common_name",)

# -- fixed values: tone histogram and quantiles --------------------------------

HISTOGRAM_LOW = -10
HISTOGRAM_HIGH = 10
HISTOGRAM_BINS = 10
QUANTILE_PROBS = (0.0, 0.25, 0.5, 0.75, 1.0)

# -- fixed values: vocabulary cuts and the words added to the taxonomy by hand -

TAXONOMY_MIN_COUNT = 10
TOP_THEMES = 1000
TOP_SOURCES = 100
MANUAL_TAXONOMY_WORDS = (
    "USPEC_POLITICS_GENERAL1",
    "USPEC",
    "CRISISLEXREC",
    "PUBLIC_SECTOR_MANAGEMENT",
    "GENERAL_GOVERNMENT",
    "IMPLIED",
    "PARTY",
)

# -- keys of the result tables -------------------------------------------------

THEME_DAY_KEYS = ("theme", "time")
THEME_DAY_SOURCE_KEYS = ("theme", "time", "src_common_name")

# Value columns of a result table, in the order they are written.
STATS_COLUMNS = ("num_mentions", "avg", "quantiles", "bin_vals")

THEME_DAY_DDL = (
    "theme STRING, num_mentions BIGINT, avg DOUBLE, "
    "quantiles ARRAY<FLOAT>, bin_vals ARRAY<BIGINT>, time TIMESTAMP"
)
THEME_DAY_SOURCE_DDL = "src_common_name STRING, " + THEME_DAY_DDL
