"""Count, average, exact quantiles and histogram of tones per group.

Everything starts from the distinct tones of each group with their weights. That
table is built with map-side combining, shuffled on group *and* tone, and written to
the shared folder, so the input is read once whatever reads the tones afterwards, a
group holding a third of all rows is spread over the cluster, and equal tones have
already become one row.

Count, average and histogram combine freely from there. So do the quantiles of a group
of at most ``leaf`` distinct tones: its tones meet in one aggregation state. Those of
all larger groups are found by radix selection (:func:`select_ranks`), of however many
groups and whatever their size. The results do not depend on ``leaf``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonetide.functions import histogram_bins, ordered_bits, tone_quantiles
from tonetide.operators.sketches import state_stats, tone_states
from tonetide.operators.vocabulary import BROADCAST_ROWS, Vocabulary
from tonetide.schemas import QUANTILE_PROBS, STATS_COLUMNS, THEME_DAY_KEYS
from tonetide.session import written

# Distinct tones that may meet in one state; a state takes about 50 bytes for each.
LEAF = 20_000

# A key of 64 bits is taken apart in four rounds.
_DIGIT_BITS = 16


def collect_tones(
    df: DataFrame,
    keys: Sequence[str],
    tone: str = "mention_doc_tone",
    weight: str | None = None,
) -> DataFrame:
    """All tones of every group, as one row per distinct tone with its count.

    Holds what a list of tones per group would hold, without gathering a group in
    one row.
    """
    count = F.count("*") if weight is None else F.sum(weight)
    return df.groupBy(*keys, tone).agg(count.alias("num_mentions"))


def tone_stats(
    df: DataFrame,
    keys: Sequence[str] = THEME_DAY_KEYS,
    tone: str = "mention_doc_tone",
    weight: str | None = None,
    probs: Sequence[float] = QUANTILE_PROBS,
    leaf: int = LEAF,
    close_last: bool = False,
    accuracy: int | None = None,
) -> DataFrame:
    """``num_mentions``, ``avg``, ``quantiles`` and ``bin_vals`` per group.

    ``weight`` names a column saying how many mentions a row stands for;
    ``close_last`` counts the upper end of the histogram into its last cell. The input
    is read when this is called, the result when it is used.

    With ``accuracy``, the k of :func:`tonetide.operators.sketches.tone_states`, the
    quantiles are estimates from a sketch, and everything is one aggregation.
    """
    keys = list(keys)
    if accuracy is not None:
        return state_stats(tone_states(df, keys, tone, weight, accuracy), probs)
    values = written(_values(df, keys, tone, weight), "tones")
    counts = values.groupBy(*keys).agg(F.count("*").alias("_distinct"))
    return _stats(values, counts, keys, probs, leaf, close_last)


def _values(df: DataFrame, keys: list[str], tone: str, weight: str | None) -> DataFrame:
    return collect_tones(df, keys, tone, weight).withColumnsRenamed(
        {tone: "_tone", "num_mentions": "_n"}
    )


def _stats(
    values: DataFrame,
    counts: DataFrame,
    keys: list[str],
    probs: Sequence[float],
    leaf: int,
    close_last: bool = False,
) -> DataFrame:
    """The statistics of distinct tones ``_tone`` with weights ``_n``.

    ``counts`` says how many distinct tones a group may have (``_distinct``).
    """
    totals = _totals(close_last)
    columns = [*keys, *STATS_COLUMNS]
    quantiles = tone_quantiles(F.col("_tone"), probs, weight=F.col("_n")).alias("quantiles")
    large = written(counts.where(F.col("_distinct") > leaf), "large_groups")
    number = large.count()

    def in_one_state(rows: DataFrame) -> DataFrame:
        # Bounded groups of distinct tones: nothing is left to combine before the shuffle.
        return rows.repartition(*keys).groupBy(*keys).agg(*totals, quantiles).select(*columns)

    if not number:
        return in_one_state(values)
    small = _matching(values, large, keys, number, "left_anti")
    big = written(
        _matching(values, large, keys, number, "left_semi").withColumn(
            "_key", ordered_bits(F.col("_tone"))
        ),
        "large_tones",
    )
    ranked = F.sum(F.when(F.col("_key").isNotNull(), F.col("_n")))
    sums = written(
        big.groupBy(*keys).agg(
            *totals, F.max(F.isnan("_tone")).alias("_nan"), (ranked - 1).alias("_last")
        ),
        "totals",
    )
    picked = select_ranks(big, _wanted(sums, keys, probs), keys)
    of_large = _interpolated(sums, picked, keys, probs, number)
    return in_one_state(small).unionByName(of_large.select(*columns))


def _matching(rows: DataFrame, groups: DataFrame, on: list[str], number: int, how: str) -> DataFrame:
    """Join to a table of ``number`` rows, null-safe, as a group may be keyed by NULL."""
    right = groups.withColumnsRenamed({c: f"_group_{c}" for c in on})
    if number <= BROADCAST_ROWS:
        right = F.broadcast(right)
    same = [F.col(c).eqNullSafe(F.col(f"_group_{c}")) for c in on]
    return rows.join(right, same, how).drop(*[f"_group_{c}" for c in on])


def _totals(close_last: bool) -> list[Column]:
    n = F.col("_n")
    cells = [
        F.sum(F.when(cell, n).otherwise(0))
        for cell in histogram_bins(F.col("_tone"), close_last=close_last)
    ]
    return [
        F.sum(n).alias("num_mentions"),
        (F.sum(F.col("_tone") * n) / F.sum(n)).alias("avg"),
        F.array(*cells).alias("bin_vals"),
    ]


def _wanted(sums: DataFrame, keys: list[str], probs: Sequence[float]) -> DataFrame:
    """The ranks a quantile lies between, counted from 0, as two slots for each."""
    places = [
        F.struct(
            F.lit(2 * i + j).alias("_slot"),
            side(F.col("_last") * F.lit(float(p))).cast("long").alias("_rank"),
        )
        for i, p in enumerate(probs)
        for j, side in enumerate((F.floor, F.ceil))
    ]
    # NaN has no place among the keys; a group that holds it needs no ranks.
    return sums.where("_last >= 0 AND NOT coalesce(_nan, false)").select(
        *keys, F.inline(F.array(*places))
    )


# Walks the sorted cells of one range up to the one that holds a rank.
_FIND_CELLS = """transform(_slots, s -> aggregate(_cells,
    named_struct('slot', s._slot, 'rank', s._rank, 'digit', 0L, 'lo', 0D, 'hi', 0D, 'hit', false),
    (a, c) -> CASE
        WHEN a.hit THEN a
        WHEN a.rank < c._n THEN named_struct('slot', a.slot, 'rank', a.rank, 'digit', c._digit,
                                             'lo', c._lo, 'hi', c._hi, 'hit', true)
        ELSE named_struct('slot', a.slot, 'rank', a.rank - c._n, 'digit', a.digit,
                          'lo', a.lo, 'hi', a.hi, 'hit', false) END))"""


def select_ranks(values: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """The tones at wanted ranks of each group: ``keys``, ``_slot``, ``_found``.

    ``values`` has a weight ``_n`` per ``_tone`` and its ``_key`` of 64 bits, in the same
    order; ``wanted`` has a ``_rank`` for each ``_slot``. A round weighs the cells of the
    next 16 bits, with map-side combining, finds the cell that holds each rank, and goes on
    within those cells alone. A range has at most 2**16 cells whatever the size of its
    group. A cell with one tone needs no further round, and the fourth has no other.
    """
    rows = values.where("_key IS NOT NULL")
    wanted = written(wanted.withColumn("_prefix", F.lit(0).cast("long")), "ranks")
    on = [*keys, "_prefix"]
    found = []
    for shift in range(64 - _DIGIT_BITS, -1, -_DIGIT_BITS):
        number = wanted.count()
        if not number:
            break
        slots = wanted.groupBy(*on).agg(F.collect_list(F.struct("_slot", "_rank")).alias("_slots"))
        if shift + _DIGIT_BITS == 64:
            level = rows.withColumn("_prefix", F.lit(0).cast("long"))
        else:
            level = rows.withColumn("_prefix", F.shiftright("_key", shift + _DIGIT_BITS))
            level = _matching(level, slots.select(*on), on, number, "left_semi")
        cells = (
            level.groupBy(*on, F.shiftright("_key", shift).alias("_digit"))
            .agg(F.sum("_n").alias("_n"), F.min("_tone").alias("_lo"), F.max("_tone").alias("_hi"))
            .groupBy(*on)
            .agg(F.array_sort(F.collect_list(F.struct("_digit", "_n", "_lo", "_hi"))).alias("_cells"))
        )
        hits = written(
            _matching(cells, slots, on, number, "inner").select(*keys, F.inline(F.expr(_FIND_CELLS))),
            "cells",
        )
        single = F.col("lo") == F.col("hi")
        found.append(hits.where(single).select(*keys, F.col("slot").alias("_slot"), F.col("lo").alias("_found")))
        wanted = hits.where(~single).select(
            *keys,
            F.col("slot").alias("_slot"),
            F.col("rank").alias("_rank"),
            F.col("digit").alias("_prefix"),
        )
    picked = found[0] if found else wanted.select(*keys, "_slot", F.lit(0.0).alias("_found"))
    for part in found[1:]:
        picked = picked.unionByName(part)
    return picked


def _interpolated(
    sums: DataFrame, picked: DataFrame, keys: list[str], probs: Sequence[float], number: int
) -> DataFrame:
    """``sums`` with the array of quantiles."""
    sides = [
        F.max(F.when(F.col("_slot") == i, F.col("_found"))).alias(f"_side{i}")
        for i in range(2 * len(probs))
    ]
    rows = _matching(sums, picked.groupBy(*keys).agg(*sides), keys, number, "left")
    values = []
    for i, p in enumerate(probs):
        low, high = F.col(f"_side{2 * i}"), F.col(f"_side{2 * i + 1}")
        place = F.col("_last") * F.lit(float(p))
        between = (F.ceil(place) - place) * low + (place - F.floor(place)) * high
        values.append(F.when(low == high, low).otherwise(between))
    nan = F.array(*[F.lit(float("nan"))] * len(probs))
    return rows.withColumn(
        "quantiles",
        F.when(F.col("_nan"), nan)
        .when(F.col("_last") >= 0, F.array(*values))
        .cast("array<float>"),
    )


def tone_stats_multi(
    df: DataFrame,
    sources: Vocabulary | None = None,
    tone: str = "mention_doc_tone",
    weight: str | None = None,
    probs: Sequence[float] = QUANTILE_PROBS,
    leaf: int = LEAF,
    close_last: bool = False,
) -> DataFrame:
    """Both grains of the statistics in one pass over the input.

    ``grain`` tells the rows apart: ``theme_day`` covers all sources and has no
    source name, ``theme_day_source`` has one row per source, limited to
    ``sources`` if given. The input is counted at the fine grain alone, with one state
    for all sources outside the list; the coarse grain is rolled up from those counts.
    """
    source = F.col("src_common_name")
    if isinstance(sources, DataFrame):
        listed = sources.select(
            F.col(sources.columns[0]).alias("src_common_name"), F.lit(True).alias("_listed")
        ).distinct()
        df = df.join(listed, "src_common_name", "left")
        wanted = F.coalesce(F.col("_listed"), F.lit(False))
    elif sources is not None:
        wanted = F.coalesce(source.isin(*sorted(set(sources))), F.lit(False))
    else:
        wanted = F.lit(True)
    carried = [tone] if weight is None else [tone, weight]
    rows = df.select(
        *THEME_DAY_KEYS, wanted.alias("_wanted"), F.when(wanted, source).alias("src"), *carried
    )
    fine_keys = [*THEME_DAY_KEYS, "_wanted", "src"]
    values = written(_values(rows, fine_keys, tone, weight), "tones")
    options = (probs, leaf, close_last)

    # Rows of the fine grain are at least the distinct tones of the coarse one.
    rolled_up = values.groupBy(*THEME_DAY_KEYS, "_tone").agg(F.sum("_n").alias("_n"))
    counts = values.groupBy(*THEME_DAY_KEYS).agg(F.count("*").alias("_distinct"))
    coarse = _stats(rolled_up, counts, list(THEME_DAY_KEYS), *options)

    single = values.where("_wanted")
    by_source = [*THEME_DAY_KEYS, "src"]
    counts = single.groupBy(*by_source).agg(F.count("*").alias("_distinct"))
    fine = _stats(single, counts, by_source, *options)
    return (
        coarse.withColumn("src", F.lit(None).cast("string"))
        .withColumn("grain", F.lit("theme_day"))
        .unionByName(fine.withColumn("grain", F.lit("theme_day_source")))
        .select("grain", *THEME_DAY_KEYS, F.col("src").alias("src_common_name"), *STATS_COLUMNS)
    )
