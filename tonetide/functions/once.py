"""Evaluate an expression once per row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(expr: Column) -> Column:
    """``expr`` as the output of a one-element generator.

    Catalyst folds a projected expression into every filter and projection that
    reads it, so an expensive one (splitting a long line, cleaning a theme list)
    would run once per reader. The output of a generator is never folded.
    """
    return F.explode(F.array(expr))
