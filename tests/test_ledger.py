"""Tables kept up batch by batch, against one run over everything."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tonetide import plans
from tonetide.operators import theme_tones
from tonetide.schemas import MENTION_FIELDS, MENTION_WIDTH
from tonetide.sources import read_mentions, read_stats
from tonetide.sources.ledger import add_batch, batch_files, read_ledger


def mention(time, doc, tone):
    fields = [""] * MENTION_WIDTH
    fields[MENTION_FIELDS["mention_time_date"]] = time
    fields[MENTION_FIELDS["mention_id"]] = doc
    fields[MENTION_FIELDS["mention_doc_tone"]] = str(tone)
    return "\t".join(fields)


@pytest.fixture
def feed(tmp_path):
    """Four quarters of an hour before midnight and after, and the hour as one file."""
    quarters, lines = [], []
    for i, clock in enumerate(("20200101233000", "20200101234500", "20200102000000", "20200102001500")):
        part = [mention(clock, f"d{j % 3}", (i + j) / 4) for j in range(20)]
        (tmp_path / f"q{i}.csv").write_text("\n".join(part) + "\n")
        quarters.append(str(tmp_path / f"q{i}.csv"))
        lines += part
    (tmp_path / "hour.csv").write_text("\n".join(lines) + "\n")
    return quarters, str(tmp_path / "hour.csv")


@pytest.fixture
def documents(spark):
    rows = [("d0", "s0", ["A", "B"]), ("d1", "s1", ["A"]), ("d2", "s0", ["C"])]
    return spark.createDataFrame(rows, "doc_id string, src_common_name string, themes array<string>")


def bag(df):
    return sorted(str(sorted(row.asDict().items())) for row in df.collect())


def test_quarters_equal_the_hour(spark, tmp_path, feed, documents):
    quarters, hour = feed
    themes = ["A", "C"]
    paths = [str(tmp_path / name) for name in ("ledger", "by_day", "by_source")]
    changed = [
        plans.add_mention_files(spark, paths[0], [q], documents, [], themes, *paths[1:], ["s0"])
        for q in quarters
    ]
    assert changed == [["2020-01-01"]] * 2 + [["2020-01-02"]] * 2
    mentions = read_mentions(spark, hour)
    whole = plans.theme_day_tone(mentions, documents, [], themes)
    assert bag(read_stats(spark, paths[1]).drop("date").select(whole.columns)) == bag(whole)
    whole = plans.theme_day_source_tone(mentions, documents, [], themes, ["s0"])
    assert bag(read_stats(spark, paths[2]).drop("date").select(whole.columns)) == bag(whole)


def test_a_file_counts_once_and_days_are_swapped_whole(spark, tmp_path, feed, documents):
    quarters, _ = feed
    path = str(tmp_path / "ledger")

    def tones(files):
        return theme_tones(read_mentions(spark, files), documents, [], ["A"])

    assert read_ledger(spark, path).count() == 0
    assert add_batch(spark, path, quarters[:2], tones) == ["2020-01-01"]
    first = bag(read_ledger(spark, path))
    assert add_batch(spark, path, [quarters[0], quarters[1]], tones) == []
    assert bag(read_ledger(spark, path)) == first
    old = read_ledger(spark, path)
    # The later file brings a new day and leaves the other alone, known files or not.
    assert add_batch(spark, path, quarters[1:3], tones) == ["2020-01-02"]
    assert bag(read_ledger(spark, path, ["2020-01-01"])) == first == bag(old)
    # Two of three documents have the theme: 14 of a file's 20 mentions.
    assert read_ledger(spark, path).agg(F.sum("weight")).first()[0] == 3 * 14
    assert {r.file for r in batch_files(spark, path).collect()} == set(quarters[:3])


def test_a_batch_that_dies_leaves_nothing(spark, tmp_path, feed, documents):
    quarters, _ = feed
    path = str(tmp_path / "ledger")

    def tones(files):
        return theme_tones(read_mentions(spark, files), documents, [], ["A"])

    add_batch(spark, path, quarters[:1], tones)
    before = bag(read_ledger(spark, path))

    def broken(files):
        return tones(files).withColumn("weight", F.raise_error(F.lit("lost")).cast("bigint"))

    with pytest.raises(Exception, match="lost"):
        add_batch(spark, path, quarters[1:2], broken)
    assert bag(read_ledger(spark, path)) == before
    assert add_batch(spark, path, quarters[1:2], tones) == ["2020-01-01"]
