"""Theme codes: lists of codes, their tokens, and cleaning with a taxonomy.

A code is a chain of tokens joined by ``_``; a token may carry a comma and an
offset. Its first two tokens may name the taxonomy the code comes from, which
says nothing to a reader and is cleaned away.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonetide.functions.predicates import has_digit

# Taxonomy words appear among this many leading tokens only.
PREFIX_TOKENS = 2


def theme_list(col: Column) -> Column:
    """Codes of a ``;``-terminated list; whatever follows the last ``;`` is dropped."""
    codes = F.split(col, ";")
    return F.slice(codes, 1, F.size(codes) - 1)


def strip_comma(col: Column) -> Column:
    """The text before the first comma."""
    return F.substring_index(col, ",", 1)


def strip_commas(arr: Column) -> Column:
    """:func:`strip_comma` on every element."""
    return F.transform(arr, strip_comma)


def tokens(code: Column) -> Column:
    """Tokens of a code, commas still in place."""
    return F.split(code, "_")


def token_count(arr: Column) -> Column:
    """Number of elements."""
    return F.size(arr)


def first_two(arr: Column) -> Column:
    """The leading tokens, at most two."""
    return F.slice(arr, 1, PREFIX_TOKENS)


def is_prefix_word(token: Column, taxonomy: Iterable[str]) -> Column:
    """A leading token to clean away: a taxonomy word, or one holding a digit."""
    return token.isin(*sorted(set(taxonomy))) | has_digit(token)


def clean_theme(code: Column, taxonomy: Iterable[str]) -> Column:
    """The code without commas and without leading taxonomy words.

    A code of one token is kept even if it is a taxonomy word. The result may be
    the empty string.
    """
    words = sorted(set(taxonomy))
    kept = F.filter(
        tokens(code),
        lambda token, i: (i >= PREFIX_TOKENS) | ~is_prefix_word(strip_comma(token), words),
    )
    return F.when(F.contains(code, F.lit("_")), F.array_join(strip_commas(kept), "_")).otherwise(
        strip_comma(code)
    )


def clean_themes(arr: Column, taxonomy: Iterable[str]) -> Column:
    """:func:`clean_theme` on every code; repeated results are kept."""
    words = sorted(set(taxonomy))
    return F.transform(arr, lambda code: clean_theme(code, words))
