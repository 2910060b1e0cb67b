"""Golden rows for the column functions."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tonetide import functions as fn

TAXONOMY = ["WB", "TAX", "FNCACT"]


def apply(spark, values, build, kind="string"):
    """Evaluate an expression over column ``x`` of the given values, in order."""
    df = spark.createDataFrame(list(enumerate(values)), f"i int, x {kind}")
    rows = df.select("i", build(F.col("x")).alias("y")).collect()
    return [row.y for row in sorted(rows, key=lambda row: row.i)]


@pytest.mark.parametrize("tax", [TAXONOMY, []])
def test_clean_theme_without_taxonomy_words_in_the_way(spark, tax):
    codes = ["LEADER,123", "A_B_C,9", "A,1_B", "A_B_WB_9", "", "A__B", "_", "_B", "A_"]
    want = ["LEADER", "A_B_C", "A_B", "A_B_WB_9", "", "A__B", "_", "_B", "A_"]
    assert apply(spark, codes, lambda c: fn.clean_theme(c, tax)) == want


def test_clean_theme_with_taxonomy(spark):
    cases = {
        "WB_567_CLIMATE_CHANGE": "CLIMATE_CHANGE",
        "TAX_FNCACT_LEADER": "LEADER",
        "TAX_FNCACT": "",
        "TAX": "TAX",
        "TAX,7": "TAX",
        "A1": "A1",
        "A1_B": "B",
        "TAX,1_B": "B",
        "WB_A_TAX_1": "A_TAX_1",
    }
    got = apply(spark, list(cases), lambda c: fn.clean_theme(c, TAXONOMY))
    assert got == list(cases.values())


def test_clean_themes_keeps_repeats(spark):
    got = apply(
        spark,
        ["WB_A;A;TAX_A;"],
        lambda c: fn.clean_themes(fn.theme_list(c), TAXONOMY),
    )
    assert got == [["A", "A", "A"]]


def _clean_plainly(code):
    parts = [part.partition(",")[0] for part in code.split("_")]
    if len(parts) == 1:
        return parts[0]
    lead = [p for p in parts[:2] if p not in TAXONOMY and not any("0" <= c <= "9" for c in p)]
    return "_".join(lead + parts[2:])


def test_clean_theme_on_random_codes(spark):
    rng = random.Random(7)
    pieces = ["WB", "TAX", "A", "B2", "", ",", ",9", "_", "FNCACT", "3", "C,D"]
    codes = ["".join(rng.choices(pieces, k=rng.randint(0, 7))) for _ in range(3000)]
    got = apply(spark, codes, lambda c: fn.clean_theme(c, TAXONOMY))
    assert got == [_clean_plainly(code) for code in codes]


def test_theme_list(spark):
    got = apply(spark, ["A;B;", "A;B", "A", ";;", "", ";"], fn.theme_list)
    assert got == [["A", "B"], ["A"], [], ["", ""], [], [""]]


def test_tokens(spark):
    codes = ["A", "A_B", "A_B_C", ""]
    assert apply(spark, codes, lambda c: fn.first_two(fn.tokens(c))) == [
        ["A"],
        ["A", "B"],
        ["A", "B"],
        [""],
    ]
    assert apply(spark, codes, lambda c: fn.token_count(fn.tokens(c))) == [1, 2, 3, 1]


def test_commas(spark):
    assert apply(spark, ["a,b", "a", ",", "a,b,c", ""], fn.strip_comma) == ["a", "a", "", "a", ""]
    assert apply(
        spark, ["a,1_b_,c"], lambda c: fn.strip_commas(fn.tokens(c))
    ) == [["a", "b", ""]]


def test_times(spark):
    texts = ["20180720063015", "2018139925", "20180720", "201807", "", "2018072006301599", "x" * 14]
    show = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    assert apply(spark, texts, lambda c: show(fn.second_ts(c))) == [
        "2018-07-20 06:30:15",
        None,
        None,
        None,
        None,
        "2018-07-20 06:30:15",
        None,
    ]
    assert apply(spark, texts, lambda c: show(fn.day_ts(c))) == [
        "2018-07-20 00:00:00",
        None,
        "2018-07-20 00:00:00",
        None,
        None,
        "2018-07-20 00:00:00",
        None,
    ]


def test_numbers(spark):
    good = ["1", "-4.25", " 1 ", "1.", ".5", "1e3", "nan", "inf", "-Infinity", "+3", "\t2", "NaN"]
    bad = ["", "abc", "0x10", "1.0d", "1f", ".", "1_0", "--1", "1 2", "e3", "1e", "1L", "-nan"]
    assert all(apply(spark, good, fn.is_number))
    assert not any(apply(spark, bad, fn.is_number))
    assert apply(spark, bad, fn.to_double) == [None] * len(bad)
    values = apply(spark, good, fn.to_double)
    want = [float(text) for text in good]
    assert [v if v == v else "nan" for v in values] == [w if w == w else "nan" for w in want]


def test_predicates(spark):
    assert apply(spark, ["A1", "A", "", "1"], fn.has_digit) == [True, False, False, True]
    df = spark.createDataFrame([("a", "b"), ("", "b"), (" ", "b"), ("a", "")], "x string, y string")
    kept = df.where(fn.all_non_empty(F.col("x"), F.col("y"))).collect()
    assert [tuple(r) for r in kept] == [("a", "b"), (" ", "b")]
    assert apply(
        spark, ["a\tb", "a\t\t", "a"], lambda c: fn.has_width(F.split(c, "\t"), 3)
    ) == [False, True, False]


def _cells(*filled):
    cells = [0] * 12
    for cell in filled:
        cells[cell] += 1
    return cells


@pytest.mark.parametrize(
    ("tones", "want"),
    [
        ([-10.01], _cells(0)),
        ([-10.0], _cells(1)),
        ([-8.0, 0.0], _cells(2, 6)),
        ([9.99], _cells(10)),
        ([10.0], _cells()),
        ([10.01, math.inf], _cells(11, 11)),
        ([math.nan], _cells()),
        ([-math.inf], _cells(0)),
    ],
)
def test_histogram(spark, tones, want):
    df = spark.createDataFrame([(t,) for t in tones], "x double")
    assert df.select(fn.tone_histogram(F.col("x"))).first()[0] == want


def test_histogram_closed_at_the_top(spark):
    df = spark.createDataFrame([(10.0,), (9.0,)], "x double")
    got = df.select(fn.tone_histogram(F.col("x"), close_last=True)).first()[0]
    assert got == _cells(10, 10)


def test_histogram_with_other_edges(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (9.0,)], "x double")
    got = df.select(fn.tone_histogram(F.col("x"), lo=0, hi=2, bins=2)).first()[0]
    assert got == [0, 1, 1, 1]


@pytest.mark.parametrize(
    ("tones", "want"),
    [
        ([1.0, 2.0, 3.0, 4.0], [1, 1.75, 2.5, 3.25, 4]),
        ([-10.0, 10.0], [-10, -5, 0, 5, 10]),
        ([3.5], [3.5] * 5),
    ],
)
def test_quantiles(spark, tones, want):
    df = spark.createDataFrame([(t,) for t in tones], "x double")
    assert df.select(fn.tone_quantiles(F.col("x"))).first()[0] == want


def test_quantiles_of_nan_weighted_and_approximate(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 1), (math.nan, 1)], "x double, n int")
    assert all(math.isnan(q) for q in df.select(fn.tone_quantiles(F.col("x"))).first()[0])
    plain = df.where("not isnan(x)")
    weighted = plain.select(fn.tone_quantiles(F.col("x"), weight=F.col("n"))).first()[0]
    assert weighted == np.quantile([1, 1, 1, 2], [0, 0.25, 0.5, 0.75, 1]).tolist()
    rough = spark.range(1000).select(
        fn.tone_quantiles(F.col("id").cast("double"), [0.5], accuracy=100)
    )
    assert abs(rough.first()[0][0] - 500) <= 10
    with pytest.raises(ValueError):
        fn.tone_quantiles(F.col("x"), accuracy=10, weight=F.col("n"))
