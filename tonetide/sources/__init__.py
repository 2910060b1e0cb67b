"""Feed lines, vocabulary lists and result tables."""

from tonetide.sources.lines import (
    parse_documents,
    parse_mentions,
    read_documents,
    read_mentions,
    register_views,
    rejected_lines,
    time_glob,
)
from tonetide.sources.tables import (
    check_stats,
    jdbc_rows,
    jdbc_settings,
    read_stats,
    write_jdbc,
    write_stats,
)
from tonetide.sources.vocab import read_vocab, small_list, write_vocab

__all__ = [
    "check_stats",
    "jdbc_rows",
    "jdbc_settings",
    "parse_documents",
    "parse_mentions",
    "read_documents",
    "read_mentions",
    "read_stats",
    "read_vocab",
    "register_views",
    "rejected_lines",
    "small_list",
    "time_glob",
    "write_jdbc",
    "write_stats",
    "write_vocab",
]
