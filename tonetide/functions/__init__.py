"""Column expressions: everything here is evaluated inside the JVM."""

from tonetide.functions.once import once
from tonetide.functions.predicates import all_non_empty, has_digit, has_width, is_number, to_double
from tonetide.functions.themes import (
    clean_theme,
    clean_themes,
    first_two,
    strip_comma,
    strip_commas,
    theme_list,
    token_count,
    tokens,
)
from tonetide.functions.times import GRAINS, day_ts, second_ts
from tonetide.functions.tones import histogram_bins, ordered_bits, tone_histogram, tone_quantiles

__all__ = [
    "GRAINS",
    "all_non_empty",
    "clean_theme",
    "clean_themes",
    "day_ts",
    "first_two",
    "has_digit",
    "has_width",
    "histogram_bins",
    "is_number",
    "once",
    "ordered_bits",
    "second_ts",
    "strip_comma",
    "strip_commas",
    "theme_list",
    "to_double",
    "token_count",
    "tokens",
    "tone_histogram",
    "tone_quantiles",
]
