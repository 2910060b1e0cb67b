"""Aggregate expressions over a tone column.

``tone_quantiles`` keeps one counter per distinct tone and group, so use it where
groups are known to be modest. :func:`tonetide.operators.tone_stats` gives the
same numbers with hot groups split over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tonetide.schemas import HISTOGRAM_BINS, HISTOGRAM_HIGH, HISTOGRAM_LOW, QUANTILE_PROBS


def tone_quantiles(
    col: Column,
    probs: Sequence[float] = QUANTILE_PROBS,
    accuracy: int | None = None,
    weight: Column | None = None,
) -> Column:
    """Quantiles of a group as ``array<float>``, linearly interpolated.

    A group holding NaN has only NaN quantiles. With ``accuracy`` the answer is
    approximate and the state per group bounded; ``weight`` (exact only) says how
    often a row counts.
    """
    if accuracy is not None:
        if weight is not None:
            raise ValueError("approximate quantiles take no weight")
        values = F.percentile_approx(col, list(probs), accuracy)
    else:
        values = F.percentile(col, list(probs), F.lit(1) if weight is None else weight)
    all_nan = F.array(*[F.lit(float("nan"))] * len(probs))
    return F.when(F.max(F.isnan(col)), all_nan).otherwise(values).cast("array<float>")


def histogram_bins(
    col: Column,
    lo: float = HISTOGRAM_LOW,
    hi: float = HISTOGRAM_HIGH,
    bins: int = HISTOGRAM_BINS,
    close_last: bool = False,
) -> list[Column]:
    """One condition per histogram cell: below, ``bins`` half-open cells, above.

    A tone equal to ``hi`` belongs to no cell unless ``close_last``; NaN never does.
    """
    step = (hi - lo) / bins
    edges = [lo + i * step for i in range(bins + 1)]
    inner = [(col >= a) & (col < b) for a, b in zip(edges, edges[1:])]
    if close_last:
        inner[-1] = (col >= edges[-2]) & (col <= hi)
    # NaN sorts above every number in Spark, hence the guard.
    return [col < lo, *inner, (col > hi) & ~F.isnan(col)]


def tone_histogram(
    col: Column,
    lo: float = HISTOGRAM_LOW,
    hi: float = HISTOGRAM_HIGH,
    bins: int = HISTOGRAM_BINS,
    close_last: bool = False,
    weight: Column | None = None,
) -> Column:
    """Counts per histogram cell of a group.

    ``array<bigint>``, since one cell of a hot group may pass 32 bits.
    """
    cells = histogram_bins(col, lo, hi, bins, close_last)
    one = F.lit(1) if weight is None else weight
    counts = [F.sum(F.when(cell, one).otherwise(0)) for cell in cells]
    return F.array(*counts)


def ordered_bits(col: Column) -> Column:
    """The bits of a double as a ``bigint`` that sorts like the doubles do.

    Both zeros are 0, negative numbers are negative, infinities lie outermost; NaN and
    NULL give NULL. Exponent and mantissa come from arithmetic that is exact: powers of
    two, quotients by them, and a logarithm that is put right where it is off by one.
    """
    size = F.abs(col)
    guess = F.greatest(F.floor(F.log2(size)).cast("int"), F.lit(-1022))
    part = size / F.pow(F.lit(2.0), guess)
    exponent = F.greatest(
        guess + F.when(part >= 2, 1).when((part < 1) & (guess > -1022), -1).otherwise(0), F.lit(-1022)
    )
    mantissa = size / F.pow(F.lit(2.0), exponent)
    normal = mantissa >= 1
    whole = F.lit(1 << 52)
    bits = F.when(normal, (exponent + 1023).cast("long") * whole).otherwise(F.lit(0).cast("long")) + (
        F.when(normal, mantissa - 1).otherwise(mantissa) * F.lit(float(1 << 52))
    ).cast("long")
    bits = (
        F.when(size == 0, F.lit(0).cast("long"))
        .when(size == float("inf"), F.lit(2047 << 52))
        .otherwise(bits)
    )
    return F.when(F.isnan(col), F.lit(None)).otherwise(F.when(col < 0, -bits).otherwise(bits))
