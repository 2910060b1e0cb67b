"""Result tables and the reads over them."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonetide.operators import latest_stored, latest_tone, tone_distribution, tone_evolution
from tonetide.schemas import THEME_DAY_KEYS, THEME_DAY_SOURCE_DDL, THEME_DAY_SOURCE_KEYS
from tonetide.sources import (
    check_stats,
    jdbc_rows,
    jdbc_settings,
    read_stats,
    write_jdbc,
    write_stats,
)


def row(theme, day, source="s", n=1, avg=0.0, cell=1):
    cells = [0] * 12
    cells[cell] = n
    return (source, theme, n, avg, [avg] * 5, cells, datetime(2020, 1, day))


@pytest.fixture
def stats(spark):
    rows = [
        row("A", 1),
        row("A", 2, n=3, avg=1.0),
        row("A", 2, "t", n=2, cell=5),
        row("A", 3, "t", n=4, cell=5),
        row("B", 2),
    ]
    return spark.createDataFrame(rows, THEME_DAY_SOURCE_DDL)


def test_writing_again_changes_nothing(spark, stats, tmp_path):
    path = str(tmp_path / "table")
    write_stats(stats, path)
    write_stats(stats, path)
    assert read_stats(spark, path).count() == 5
    write_stats(stats.where("day(time) = 2 AND theme = 'B'"), path)
    left = read_stats(spark, path)
    assert sorted((r.theme, r.time.day) for r in left.collect()) == [("A", 1), ("A", 3), ("B", 2)]
    assert left.drop("date").schema == stats.select(left.drop("date").columns).schema
    assert {p.name for p in (tmp_path / "table").glob("date=*")} == {
        "date=2020-01-01",
        "date=2020-01-02",
        "date=2020-01-03",
    }


def test_range_reads_prune_days(spark, stats, tmp_path):
    path = str(tmp_path / "table")
    write_stats(stats, path)
    df = tone_evolution(read_stats(spark, path), "A", "2020-01-02", "2020-01-03")
    plan = df._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].split("PushedFilters")[0]
    assert "date" in filters and "2020-01-02" in filters
    assert sorted(r.src_common_name for r in df.collect()) == ["s", "t"]


def test_clean_table_has_no_violations(stats):
    assert check_stats(stats, THEME_DAY_SOURCE_KEYS).count() == 0


def test_violations(spark, stats):
    dirty = stats.union(
        spark.createDataFrame(
            [row("A", 1), row("C", 1, n=0), row("D", 1), row("D", 1, n=-1)], THEME_DAY_SOURCE_DDL
        )
    ).withColumn("avg", F.when(F.col("theme") != "B", F.col("avg")))
    got = {(r.theme, r.time.day, r.rule, r.rows) for r in
           check_stats(dirty, THEME_DAY_SOURCE_KEYS).collect()}
    assert got == {
        ("A", 1, "duplicate", 2),
        ("B", 2, "null", 1),
        ("C", 1, "not_positive", 1),
        ("D", 1, "not_positive", 1),
        ("D", 1, "duplicate", 2),
    }
    by_day = check_stats(stats, THEME_DAY_KEYS).collect()
    assert [(r.theme, r.time.day, r.rows) for r in by_day] == [("A", 2, 2)]


def test_jdbc_rows_take_any_width_and_cut_nothing(spark):
    rows = spark.sql(
        "SELECT 'A' AS theme, 1 AS num_mentions, 1D AS avg, array(1, 2, 3, 4, 5, 6, 7) AS quantiles, "
        "array(1, 2) AS bin_vals"
    )
    flat = jdbc_rows(rows, flatten=True, quantiles=7, cells=2).first()
    assert [flat[f"q{i}"] for i in range(7)] == [1, 2, 3, 4, 5, 6, 7] and flat.b1 == 2
    with pytest.raises(Exception, match="has not 5 elements"):
        jdbc_rows(rows, flatten=True, cells=2).collect()


def test_jdbc_rows(stats):
    plain = jdbc_rows(stats)
    assert dict(plain.dtypes)["num_mentions"] == "int"
    flat = jdbc_rows(stats, flatten=True)
    assert not any("array" in kind for _, kind in flat.dtypes)
    first = flat.where("day(time) = 3").first()
    assert (first.q4, first.b5, first.b0) == (0.0, 4, 0)


def test_jdbc_writer_passes_caller_options(stats, monkeypatch):
    """No database is started; only what the writer is told is checked."""
    seen = {}

    class Writer:
        def format(self, name):
            seen["format"] = name
            return self

        def options(self, **options):
            seen.update(options)
            return self

        def mode(self, name):
            seen["mode"] = name
            return self

        def save(self):
            seen["saved"] = True

    monkeypatch.setattr(type(stats), "write", property(lambda self: Writer()))
    assert isinstance(stats, DataFrame)
    write_jdbc(stats, "jdbc:x", "t", stringtype="unspecified", numPartitions="4")
    assert seen == {
        "format": "jdbc",
        "url": "jdbc:x",
        "dbtable": "t",
        "stringtype": "unspecified",
        "numPartitions": "4",
        "mode": "append",
        "saved": True,
    }


def test_jdbc_settings(tmp_path):
    path = tmp_path / "db.ini"
    path.write_text(
        "[postgresql]\nurl = jdbc:postgresql://host/db\nDatabase = db\nschema = s\n"
        "username = u\npassword = p%\ndriver = org.postgresql.Driver\ntable = s.t\n"
    )
    assert jdbc_settings(str(path)) == {
        "url": "jdbc:postgresql://host/db",
        "user": "u",
        "password": "p%",
        "driver": "org.postgresql.Driver",
        "table": "s.t",
    }


def test_evolution(stats):
    rows = tone_evolution(stats, "A").collect()
    assert [r.time.day for r in rows] == [3, 2, 2, 1]
    part = tone_evolution(stats, "A", datetime(2020, 1, 2), "2020-01-03").collect()
    assert [r.time.day for r in part] == [2, 2]


def test_distribution(stats):
    got = {r.src_common_name: (r.num_mentions, r.bin_vals) for r in
           tone_distribution(stats, "A", "2020-01-02").collect()}
    assert got == {"s": (3, [0, 3] + [0] * 10), "t": (6, [0] * 5 + [6] + [0] * 6)}


def test_latest(stats):
    got = {(r.theme, r.src_common_name, r.time.day) for r in
           latest_tone(stats, ["theme", "src_common_name"]).collect()}
    assert got == {("A", "s", 2), ("A", "t", 3), ("B", "s", 2)}
    assert latest_tone(stats).count() == 2


def test_latest_of_a_stored_table_reads_from_its_end(spark, tmp_path):
    rows = [row(theme, day) for day in range(1, 29) for theme in ("OLD", "NEW") if theme == "NEW" or day < 27]
    rows.append(row("GONE", 3))
    stats = spark.createDataFrame(rows, THEME_DAY_SOURCE_DDL).drop("src_common_name")
    write_stats(stats, str(tmp_path / "t"))
    stored = read_stats(spark, str(tmp_path / "t"))

    some = latest_stored(stored, ["GONE", "NEVER"])
    assert [(r.theme, r.time.day) for r in some.collect()] == [("GONE", 3)]
    assert latest_stored(stored, ["NEVER"]).count() == 0

    # Days that no longer can be read show which are: first the last, then two, then four.
    def spoil(*days):
        for day in days:
            for file in (tmp_path / "t" / f"date=2020-01-{day:02}").glob("*.parquet"):
                file.write_bytes(b"spoilt")
            for file in (tmp_path / "t" / f"date=2020-01-{day:02}").glob(".*.crc"):
                file.unlink()

    spoil(*range(1, 26))
    both = latest_stored(stored, ["NEW", "OLD"])
    assert sorted((r.theme, r.time.day) for r in both.collect()) == [("NEW", 28), ("OLD", 26)]
    with pytest.raises(Exception, match="FAILED_READ_FILE|spoilt|not a Parquet file"):
        latest_stored(stored, ["GONE"]).collect()
    spoil(26, 27)
    newest = latest_stored(stored, ["NEW"])
    assert [(r.theme, r.time.day) for r in newest.collect()] == [("NEW", 28)]
