"""Merged sketch states against exact statistics."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tonetide.operators import merge_states, state_stats, tone_states, tone_stats
from tonetide.operators.sketches import RANK_ERROR

PROBS = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    out = [("a", day, rng.gauss(0, 5)) for day in range(10) for _ in range(400 * (day + 1))]
    out += [("b", day, rng.choice([0.0, 1.0, 2.5])) for day in range(10) for _ in range(50)]
    return out


@pytest.fixture(scope="module")
def states(spark, rows):
    df = spark.createDataFrame(rows, "theme string, day int, mention_doc_tone double").repartition(8)
    return tone_states(df, ["theme", "day"]).cache()


@pytest.mark.parametrize("days", [(0, 10), (3, 7), (9, 10)])
def test_ranks_over_a_range_of_days(states, rows, days):
    chosen = states.where((F.col("day") >= days[0]) & (F.col("day") < days[1]))
    for r in state_stats(merge_states(chosen, ["theme"]), PROBS).collect():
        tones = np.sort([t for theme, day, t in rows if theme == r.theme and days[0] <= day < days[1]])
        assert r.num_mentions == len(tones) and r.avg == pytest.approx(tones.mean())
        single = tones.astype("float32")
        for p, q in zip(PROBS, r.quantiles, strict=True):
            assert (single < q).mean() <= p + RANK_ERROR
            assert (single <= q).mean() >= p - RANK_ERROR
        assert r.quantiles[0] == single[0] and r.quantiles[-1] == single[-1]


def test_other_columns_equal_the_exact_ones(spark, rows):
    df = spark.createDataFrame(rows, "theme string, time int, mention_doc_tone double")
    exact = {(r.theme, r.time): r for r in tone_stats(df).collect()}
    for r in tone_stats(df, accuracy=400).collect():
        other = exact[r.theme, r.time]
        assert (r.num_mentions, r.bin_vals) == (other.num_mentions, other.bin_vals)
        assert r.avg == pytest.approx(other.avg)


def test_weights_nan_and_nothing(spark):
    rows = [("a", 1.0, 3), ("a", 5.0, 1), ("a", 9.0, 0), ("n", math.nan, 1), ("n", 1.0, 1), ("e", None, 2)]
    df = spark.createDataFrame(rows, "k string, mention_doc_tone double, w bigint")
    got = {r.k: r for r in state_stats(tone_states(df, ["k"], weight="w"), (0.0, 0.5, 1.0)).collect()}
    assert got["a"].num_mentions == 4 and got["a"].quantiles == [1.0, 1.0, 5.0]
    assert all(math.isnan(q) for q in got["n"].quantiles)
    assert got["e"].num_mentions == 2 and got["e"].quantiles is None


def test_state_is_bounded(states):
    size = merge_states(states, ["theme"]).select(F.max(F.octet_length("tone_sketch"))).first()[0]
    assert size < 20_000
