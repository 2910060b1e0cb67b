"""What the plans must and must not contain."""

from __future__ import annotations

import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import stage_metrics
from tonetide import driver_views as v
from tonetide import plans
from tonetide.operators import collect_tones, theme_tones
from tonetide.sources import parse_mentions

QUERIES = {k: q for k, q in contract.queries().items() if not re.match(r"op\d+_|pipeline$", k)}


def planned(df):
    """The plan before anything has run."""
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df):
    """The final adaptive plan, after running it."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_stays_in_the_jvm_and_crosses_nothing(spark, sf_dir, name):
    plan = planned(QUERIES[name](spark, sf_dir))
    for node in ("Python", "ArrowEval", "CartesianProduct", "BroadcastNestedLoopJoin", "RDDScan"):
        assert node not in plan


def tones_of(spark, sf_dir, **options):
    """What the tone jobs read, before their statistics."""
    rows = theme_tones(v.ment(spark, sf_dir), v.docs(spark, sf_dir), v.TAXONOMY, v.THEMES, **options)
    return collect_tones(rows, ["theme", "time"], weight="weight")


@pytest.fixture(scope="module")
def metrics(sf_dir, tmp_path_factory):
    """Rows read and shuffled by each query, from Spark's event log."""
    names = ["theme_day_tone", "theme_day_source_tone", "tone_tables_from_lines", "tone_evolution",
             "theme_second_tone_raw", "tone_multi_grain", "tone_quantiles_split", "tone_distribution",
             "top_themes", "top_sources"]
    return stage_metrics.run(names, sf_dir, tmp_path_factory.mktemp("events"))


@pytest.mark.parametrize(
    ("name", "tables"),
    [
        ("theme_day_tone", ["lineitem", "part"]),
        ("theme_day_source_tone", ["lineitem", "part"]),
        ("tone_evolution", ["lineitem", "part"]),
        ("tone_distribution", ["lineitem", "part"]),
        ("tone_tables_from_lines", ["lineitem", "part"]),
        ("theme_second_tone_raw", ["lineitem", "part"]),
        ("tone_multi_grain", ["events"]),
        # Every group is large here.
        ("tone_quantiles_split", ["events"]),
        ("top_themes", ["part"]),
        ("top_sources", ["part"]),
    ],
)
def test_inputs_are_read_once(metrics, sf_dir, name, tables):
    for table in tables:
        rows = pq.read_metadata(f"{sf_dir}/{table}.parquet").num_rows
        assert 0 < metrics[name].read[table] <= rows
    assert set(tables) == set(metrics[name].read) - {"intermediate"}


def test_coarse_grain_adds_no_rows_to_the_shuffle_of_the_input(metrics, spark, sf_dir):
    rows = v.ev(spark, sf_dir)
    fine = rows.groupBy("theme", "time", "src_common_name", "mention_doc_tone").count().count()
    shuffled = metrics["tone_multi_grain"].shuffled["events"]
    assert fine <= shuffled <= rows.count()


def test_only_needed_columns_are_read(spark, sf_dir):
    plan = planned(tones_of(spark, sf_dir))
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", plan))
    columns = {part.split(":")[0] for schema in schemas for part in schema.split(",")}
    assert columns == {
        "l_partkey",
        "l_quantity",
        "l_shipdate",
        "l_linenumber",
        "p_partkey",
        "p_name",
        "p_brand",
        "p_type",
    }


def test_source_filter_reaches_the_scan(spark, sf_dir):
    plan = planned(tones_of(spark, sf_dir, sources=v.SOURCES))
    assert re.search(r"PushedFilters: \[[^\]]*In\(p_brand, \[Brand#1,Brand#2\]\)", plan)


def test_lines_are_split_once(spark, tmp_path):
    spark.sql("SELECT 'x' AS value").write.text(str(tmp_path / "t"))
    plan = planned(parse_mentions(spark.read.text(str(tmp_path / "t"))))
    assert plan.count("split(") == 1


def test_themes_are_narrowed_before_the_join(spark, sf_dir):
    plan = planned(tones_of(spark, sf_dir))
    below_join = plan[plan.index("Join") :]
    assert "filter(transform(" in below_join
    assert plan.index("Join") < plan.index("array_join(")


def test_ranking_gathers_levels_not_keys(spark, sf_dir):
    plan = executed(plans.top_sources(v.doc_src(spark, sf_dir), 5))
    window = plan[plan.index("Window") :]
    assert "TakeOrderedAndProject(limit=5" in window
    assert "Window" not in window[window.index("TakeOrderedAndProject") :]


def test_newest_row_is_picked_before_the_shuffle(spark, sf_dir):
    plan = planned(QUERIES["latest_tone"](spark, sf_dir))
    assert plan.count("WindowGroupLimit") == 2


def test_aggregates_combine_before_the_shuffle(spark, sf_dir):
    plan = planned(v.ev(spark, sf_dir).groupBy("theme").agg(F.count("*")))
    assert "partial_count" in plan
    plan = planned(tones_of(spark, sf_dir))
    assert "partial_count" in plan and "partial_sum" in plan and "collect_list(mention" not in plan
