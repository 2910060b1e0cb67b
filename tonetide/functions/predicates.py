"""Row predicates used while reading the feeds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a number: decimal or exponent notation, or a spelled-out
# infinity / nan, with blanks around it. Spark's own cast also takes a trailing
# "d" or "f", which is not a number in the feed.
_NUMBER = (
    r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity|nan))\s*$"
)


def has_width(fields: Column, n: int) -> Column:
    """The line was cut into exactly ``n`` fields."""
    return F.size(fields) == n


def all_non_empty(*cols: Column) -> Column:
    """Every column differs from the empty string; blanks count as content."""
    return reduce(lambda a, b: a & b, [c != "" for c in cols], F.lit(True))


def is_number(col: Column) -> Column:
    """The text reads as a floating point number."""
    return col.rlike(_NUMBER) & col.try_cast("double").isNotNull()


def to_double(col: Column) -> Column:
    """The number in the text, NULL where :func:`is_number` says no."""
    return F.when(col.rlike(_NUMBER), col.try_cast("double"))


def has_digit(col: Column) -> Column:
    """The text holds a decimal digit."""
    return col.rlike("[0-9]")
