"""Reads a dashboard makes over a result table."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tonetide.schemas import HISTOGRAM_BINS, THEME_DAY_KEYS

Moment = str | datetime


def _slice(
    stats: DataFrame, theme: str, start: Moment | None, end: Moment | None
) -> DataFrame:
    rows = stats.where(F.col("theme") == theme)
    # The day column of a stored table is derived from the time; naming it too
    # lets the scan skip whole days.
    for bound, time_rule, date_rule in (
        (start, lambda c, b: c >= b, lambda c, b: c >= b),
        (end, lambda c, b: c < b, lambda c, b: c <= b),
    ):
        if bound is not None:
            moment = F.lit(bound).cast("timestamp")
            rows = rows.where(time_rule(F.col("time"), moment))
            if "date" in stats.columns:
                rows = rows.where(date_rule(F.col("date"), F.to_date(moment)))
    return rows


def tone_evolution(
    stats: DataFrame, theme: str, start: Moment | None = None, end: Moment | None = None
) -> DataFrame:
    """Statistics of one theme from ``start`` up to but not at ``end``, newest first."""
    return _slice(stats, theme, start, end).orderBy(F.desc("time"))


def tone_distribution(
    stats: DataFrame,
    theme: str,
    start: Moment | None = None,
    end: Moment | None = None,
    cells: int = HISTOGRAM_BINS + 2,
) -> DataFrame:
    """Histogram of ``cells`` cells of one theme per source, summed over a time range."""
    cells = [F.sum(F.get("bin_vals", F.lit(i))) for i in range(cells)]
    return (
        _slice(stats, theme, start, end)
        .groupBy("src_common_name")
        .agg(
            F.sum("num_mentions").alias("num_mentions"),
            F.array(*cells).alias("bin_vals"),
        )
    )


def latest_tone(stats: DataFrame, keys: Sequence[str] = THEME_DAY_KEYS[:1]) -> DataFrame:
    """The newest row of every key."""
    newest = Window.partitionBy(*keys).orderBy(F.desc("time"))
    return (
        stats.withColumn("_age", F.row_number().over(newest)).where(F.col("_age") == 1).drop("_age")
    )


def latest_stored(stats: DataFrame, themes: Iterable[str]) -> DataFrame:
    """The newest row of each wanted theme in a stored table of themes and days.

    Days are read from the newest on, one, then two, then four at a time, until every
    theme is found; older days are not opened. What reaches the driver is the listing,
    which Spark keeps there anyway, and at most the themes asked for.
    """
    days = {re.search(r"/date=([\d-]+)/", file).group(1) for file in stats.inputFiles()}
    days = sorted(days, reverse=True)
    left, parts, at, width = set(themes), [], 0, 1
    while left and at < len(days):
        rows = stats.where(F.col("date").isin([F.lit(d).cast("date") for d in days[at : at + width]]))
        rows = rows.where(F.col("theme").isin(*sorted(left)))
        found = {row["theme"] for row in rows.select("theme").distinct().collect()}
        if found:
            parts.append(latest_tone(rows.where(F.col("theme").isin(*sorted(found))), ["theme"]))
            left -= found
        at, width = at + width, 2 * width
    return reduce(DataFrame.unionByName, parts) if parts else stats.limit(0)
