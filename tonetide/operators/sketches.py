"""Approximate quantiles from stored, mergeable states.

A state per group holds the number of mentions, the sum of their tones, the histogram
and a KLL sketch of the tones. Its size is bounded by the sketch's ``k``, not by the
group. States of any days (or sources, or batches) merge into one, so a table of daily
states answers for every range of days without the tones.

The rank of an estimated quantile is off by a share of all mentions that shrinks with
``k``: about 1.3% for the default of 200, with 99% confidence, however many states were
merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonetide.functions import tone_histogram
from tonetide.schemas import HISTOGRAM_BINS, QUANTILE_PROBS, STATS_COLUMNS, THEME_DAY_KEYS

SKETCH_K = 200
# Share of the mentions by which the rank of a quantile may be off, at k = 200.
RANK_ERROR = 0.0165

STATE_COLUMNS = ("num_mentions", "tone_sum", "bin_vals", "has_nan", "tone_sketch")


def tone_states(
    df: DataFrame,
    keys: Sequence[str] = THEME_DAY_KEYS,
    tone: str = "mention_doc_tone",
    weight: str | None = None,
    k: int = SKETCH_K,
) -> DataFrame:
    """One state per group, combined on the map side.

    A row of weight w enters the sketch w times, and not at all with a weight below 1.
    NaN has no rank: it is noted and makes every quantile NaN, as in the exact tables.
    """
    copies = F.lit(1) if weight is None else F.col(weight)
    rows = df.select(*keys, F.col(tone).alias("_tone"), copies.cast("long").alias("_n"))
    if weight is not None:
        rows = rows.where("_n > 0").select(*keys, "_tone", F.explode(F.expr("sequence(1L, _n)")))
    sketched = F.when(~F.isnan("_tone"), F.col("_tone"))
    return rows.groupBy(*keys).agg(
        F.count("*").alias("num_mentions"),
        F.sum("_tone").alias("tone_sum"),
        tone_histogram(F.col("_tone")).alias("bin_vals"),
        F.max(F.isnan("_tone")).alias("has_nan"),
        F.kll_sketch_agg_double(sketched, F.lit(k)).alias("tone_sketch"),
    )


def merge_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """States of coarser groups: of several days, sources or batches."""
    cells = [F.sum(F.get("bin_vals", F.lit(i))) for i in range(HISTOGRAM_BINS + 2)]
    return states.groupBy(*keys).agg(
        F.sum("num_mentions").alias("num_mentions"),
        F.sum("tone_sum").alias("tone_sum"),
        F.array(*cells).alias("bin_vals"),
        F.max("has_nan").alias("has_nan"),
        F.kll_merge_agg_double("tone_sketch").alias("tone_sketch"),
    )


def sketch_quantiles(
    sketch: Column, has_nan: Column, probs: Sequence[float] = QUANTILE_PROBS
) -> Column:
    """The quantiles a sketch estimates, as ``array<float>``; NULL for a sketch of nothing."""
    found = F.array(*[F.kll_sketch_get_quantile_double(sketch, F.lit(float(p))) for p in probs])
    nan = F.array(*[F.lit(float("nan"))] * len(probs))
    return (
        F.when(has_nan, nan)
        .when(F.kll_sketch_get_n_double(sketch) > 0, found)
        .cast("array<float>")
    )


def state_stats(states: DataFrame, probs: Sequence[float] = QUANTILE_PROBS) -> DataFrame:
    """The columns of a result table from states; only ``quantiles`` are estimates."""
    keys = [c for c in states.columns if c not in STATE_COLUMNS]
    return states.withColumns(
        {
            "avg": F.col("tone_sum") / F.col("num_mentions"),
            "quantiles": sketch_quantiles(F.col("tone_sketch"), F.col("has_nan"), probs),
        }
    ).select(*keys, *STATS_COLUMNS)
