"""Every query against its SQL twin, row for row."""

from __future__ import annotations

import math
import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from tonetide import driver_views as v
from tonetide.operators import theme_tones

# Those of the subpackage for training data have tests of their own.
_OWN = [name for name in contract.queries() if not re.match(r"op\d+_|pipeline$", name)]
QUERIES = {name: contract.queries()[name] for name in _OWN}
ORACLES = {k: q for k, q in contract.oracle_sql().items() if k in QUERIES}
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    expected = duck.execute(ORACLES[name])
    columns = [d[0] for d in expected.description]
    assert sorted(result.columns) == sorted(columns)
    got = _bag(result.columns, result.collect())
    want = _bag(columns, expected.fetchall())
    assert sum(got.values()) > 0
    assert got == want


@pytest.mark.parametrize("name", ["theme_day_source_tone", "tone_tables_from_lines"])
def test_matches_oracle_without_broadcast(spark, duck, sf_dir, name):
    """As with documents too large to broadcast: both sides collapse and shuffle."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        rows = theme_tones(v.ment(spark, sf_dir), v.docs(spark, sf_dir), v.TAXONOMY, v.THEMES)
        assert "SortMergeJoin" in rows._jdf.queryExecution().executedPlan().toString()
        test_matches_oracle(spark, duck, sf_dir, name)
    finally:
        spark.conf.set(key, before)


def test_entry(spark):
    assert contract.entry(spark).count() > 0
