"""Statistics per group against NumPy, in one state and by selection."""

from __future__ import annotations

import math
import random
import struct
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tonetide.functions import ordered_bits
from tonetide.operators import collect_tones, stats, tone_stats, tone_stats_multi

PROBS = [0, 0.25, 0.5, 0.75, 1]


def histogram(tones):
    cells = [0] * 12
    for tone in tones:
        if tone < -10:
            cells[0] += 1
        elif tone > 10:
            cells[11] += 1
        elif tone < 10:
            cells[1 + math.floor((tone + 10) / 2)] += 1
    return cells


def expected(rows):
    groups = defaultdict(list)
    for *key, tone, weight in rows:
        groups[tuple(key)] += [tone] * weight
    return {
        key: (
            len(tones),
            pytest.approx(np.mean(tones), abs=1e-9),
            np.quantile(tones, PROBS).astype("float32").tolist(),
            histogram(tones),
        )
        for key, tones in groups.items()
    }


def measured(df, keys):
    rows = df.collect()
    assert len({tuple(row[k] for k in keys) for row in rows}) == len(rows)
    return {
        tuple(row[k] for k in keys): (row.num_mentions, row.avg, row.quantiles, row.bin_vals)
        for row in rows
    }


@pytest.fixture(scope="module")
def tones():
    """One group with a third of all rows, one with a single tone, many small ones."""
    rng = random.Random(11)
    rows = [("hot", rng.choice([0.0, 10.0, round(rng.uniform(-12, 12), 3)]), 1) for _ in range(3000)]
    rows += [("same", 2.5, 1)] * 2000
    rows += [
        (f"g{rng.randint(0, 300)}", round(rng.gauss(0, 6), 3), rng.randint(1, 4))
        for _ in range(2000)
    ]
    rows += [("heavy", -3.0, 100_000), ("heavy", 4.0, 1), (None, 1.0, 1), (None, 2.0, 2)]
    return rows


@pytest.fixture(scope="module")
def frame(spark, tones):
    return spark.createDataFrame(tones, "k string, mention_doc_tone double, w bigint").repartition(
        8
    )


# From every group in one state to every group selected bit by bit.
@pytest.mark.parametrize("leaf", [1_000_000, 100, 3, 0])
def test_exact_whatever_the_leaf(frame, tones, leaf):
    got = measured(tone_stats(frame, ["k"], weight="w", leaf=leaf), ["k"])
    assert got == expected(tones)


def test_exact_without_broadcasts(frame, tones, monkeypatch):
    monkeypatch.setattr(stats, "BROADCAST_ROWS", 0)
    got = measured(tone_stats(frame, ["k"], weight="w", leaf=2), ["k"])
    assert got == expected(tones)


def test_ordered_bits_are_those_of_the_double(spark):
    rng = random.Random(4)
    values = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308,
              1.7976931348623157e308, -1.7976931348623157e308, math.inf, -math.inf, 1.0, 2.0, 10.0]
    values += [math.ldexp(1, e) for e in range(-1074, 1024, 7)]
    for e in range(-1074, 1024, 5):
        values += [math.nextafter(math.ldexp(1, e), math.inf), math.nextafter(math.ldexp(1, e), 0)]
    values += [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(2000)]
    values += [rng.uniform(-12, 12) for _ in range(500)]
    values = [x for x in values if not math.isnan(x)]
    df = spark.createDataFrame([(x,) for x in values], "x double")
    for x, bits in df.select("x", ordered_bits(F.col("x"))).collect():
        raw = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
        assert bits == (-raw if x < 0 else raw), x
    none = spark.createDataFrame([(math.nan,), (None,)], "x double")
    assert [r[0] for r in none.select(ordered_bits(F.col("x"))).collect()] == [None, None]


def test_neighbouring_doubles_take_every_round(spark):
    """Tones that differ in the last bits alone, and far ones that differ in the first."""
    x = 3.7
    rows = []
    for i in range(200):
        rows += [("near", x, 1 + i % 3), ("far", math.ldexp(-1 if i % 2 else 1, i - 100), 1)]
        x = math.nextafter(x, math.inf)
    df = spark.createDataFrame(rows, "k string, mention_doc_tone double, w bigint")
    wanted = expected([r for r in rows if r[0] == "near"])
    got = measured(tone_stats(df, ["k"], weight="w", leaf=5), ["k"])
    assert got[("near",)] == wanted[("near",)]
    far = sorted(r[1] for r in rows if r[0] == "far")
    assert got[("far",)][2] == pytest.approx(np.quantile(far, PROBS).astype("float32").tolist())


def test_null_tones_are_counted_and_have_no_rank(spark):
    rows = [("a", None), ("a", 1.0), ("a", 3.0), ("b", None)]
    df = spark.createDataFrame(rows, "k string, mention_doc_tone double")
    for leaf in (100, 0):
        got = {r.k: r for r in tone_stats(df, ["k"], leaf=leaf, probs=[0, 0.5, 1]).collect()}
        assert got["a"].num_mentions == 3 and got["a"].quantiles == [1.0, 2.0, 3.0]
        assert got["b"].num_mentions == 1 and got["b"].quantiles is None


def test_upper_end_can_be_counted(spark):
    df = spark.createDataFrame([("a", 10.0), ("a", 1.0)], "k string, mention_doc_tone double")
    assert sum(tone_stats(df, ["k"]).first().bin_vals) == 1
    assert sum(tone_stats(df, ["k"], close_last=True).first().bin_vals) == 2


@pytest.mark.parametrize("leaf", [1_000_000, 0])
def test_nan_and_infinity(spark, leaf):
    rows = [("nan", math.nan), ("nan", 1.0), ("nan", 11.0), ("inf", math.inf), ("inf", 1.0)]
    df = spark.createDataFrame(rows, "k string, mention_doc_tone double")
    got = measured(tone_stats(df, ["k"], leaf=leaf), ["k"])
    count, avg, quantiles, cells = got[("nan",)]
    assert count == 3 and math.isnan(avg) and all(math.isnan(q) for q in quantiles)
    assert sum(cells) == 2
    assert got[("inf",)][2] == [1.0, math.inf, math.inf, math.inf, math.inf]
    assert got[("inf",)][3] == histogram([1.0, math.inf])


def test_other_probabilities(spark):
    df = spark.range(101).select(F.lit(1).alias("k"), F.col("id").cast("double").alias("x"))
    row = tone_stats(df, ["k"], tone="x", probs=[0.1, 0.905]).first()
    assert row.quantiles == pytest.approx([10, 90.5])


def test_collect_tones_is_the_multiset(frame, tones):
    got = {(r.k, r.mention_doc_tone): r.num_mentions for r in
           collect_tones(frame, ["k"], weight="w").collect()}
    want = defaultdict(int)
    for key, tone, weight in tones:
        want[(key, tone)] += weight
    assert got == want


@pytest.mark.parametrize("leaf", [1_000_000, 2])
@pytest.mark.parametrize("form", ["none", "list", "frame"])
def test_two_grains(spark, leaf, form):
    rng = random.Random(5)
    rows = [
        (rng.choice("ab"), rng.choice(["s1", "s2", ""]), float(rng.randint(-12, 12)))
        for _ in range(300)
    ]
    df = spark.createDataFrame(
        rows, "theme string, src_common_name string, mention_doc_tone double"
    ).withColumn("time", F.lit("2020-01-01").cast("timestamp"))
    wanted = {"s1", ""}
    sources = {
        "none": None,
        "list": sorted(wanted),
        "frame": spark.createDataFrame([("s1",), ("",), ("s1",)], "name string"),
    }[form]
    got = measured(
        tone_stats_multi(df, sources, leaf=leaf), ["grain", "theme", "src_common_name"]
    )
    want = expected([("theme_day", t, None, tone, 1) for t, s, tone in rows])
    want |= expected(
        [
            ("theme_day_source", t, s, tone, 1)
            for t, s, tone in rows
            if sources is None or s in wanted
        ]
    )
    assert got == want


def test_bins_and_counts_add_up(spark, sf_dir):
    from tonetide import driver_views as v

    rows = v.ev(spark, sf_dir)
    result = tone_stats(rows).withColumn(
        "binned", F.aggregate("bin_vals", F.lit(0).cast("bigint"), lambda a, b: a + b)
    )
    ten = rows.where("mention_doc_tone = 10").groupBy("theme", "time").count()
    odd = result.join(ten, ["theme", "time"], "left").where(
        "binned + coalesce(count, 0) <> num_mentions OR avg < quantiles[0] - 1e-4"
        " OR avg > quantiles[4] + 1e-4"
    )
    assert odd.count() == 0
