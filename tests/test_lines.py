"""Feed lines: parsing, rejects, text round trip."""

from __future__ import annotations

import fnmatch
import random
import re
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tonetide.schemas import (
    DOCUMENT_REQUIRED_SOURCE,
    DOCUMENT_REQUIRED_THEMES,
    MENTION_REQUIRED_WIDE,
)
from tonetide.sources import (
    parse_documents,
    parse_mentions,
    read_documents,
    read_mentions,
    register_views,
    rejected_lines,
    time_glob,
)


def mention(width=16, **fields):
    cells = ["x"] * width
    given = {"m0": "e1", "m1": "20180719", "m2": "20180720063015", "m4": "src", "m5": "url", "m13": "1.5"}
    for name, value in (given | fields).items():
        position = int(name[1:])
        if position < width:
            cells[position] = value
    return "\t".join(cells)


def document(width=27, **fields):
    cells = ["x"] * width
    given = {"d3": "src", "d4": "url", "d7": "A;B;"}
    for name, value in (given | fields).items():
        position = int(name[1:])
        if position < width:
            cells[position] = value
    return "\t".join(cells)


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


BAD_MENTIONS = {
    mention(15): "width",
    mention(17): "width",
    "": "width",
    mention(m2=""): "empty",
    mention(m5=""): "empty",
    mention(m13=""): "empty",
    mention(m13="1.0d"): "tone",
    mention(m13="-nan"): "tone",
    mention(m13="n/a", m2="nonsense"): "tone",
    mention(m2="2018139925"): "time",
}


def test_good_mentions_survive(spark):
    rows = parse_mentions(lines(spark, mention(), mention(m13=" nan ", m0="", m15=""), *BAD_MENTIONS))
    got = {(r.mention_id, str(r.mention_doc_tone), str(r.mention_time_date)) for r in rows.collect()}
    assert got == {("url", "1.5", "2018-07-20 00:00:00"), ("url", "nan", "2018-07-20 00:00:00")}
    assert rows.columns == ["mention_id", "mention_doc_tone", "mention_time_date"]


def test_mention_rejects(spark):
    rejects = rejected_lines(lines(spark, mention(), *BAD_MENTIONS), "mentions")
    assert {r.line: r.reason for r in rejects.collect()} == BAD_MENTIONS


def test_wide_mentions_need_six_fields(spark):
    given = lines(spark, mention(), mention(m0=""), mention(m1=""), mention(m4=""))
    rows = parse_mentions(given, "second", MENTION_REQUIRED_WIDE).collect()
    assert [r.asDict() for r in rows] == [
        {
            "mention_id": "url",
            "mention_doc_tone": 1.5,
            "mention_time_date": rows[0].mention_time_date,
            "event_id": "e1",
            "event_time_date": "20180719",
            "mention_src_name": "src",
        }
    ]
    assert str(rows[0].mention_time_date) == "2018-07-20 06:30:15"


def test_unchecked_width(spark):
    given = lines(spark, mention(17), mention(14), mention(13), document())
    rows = parse_mentions(given, require=(), check_width=False)
    assert rows.count() == 2
    docs = parse_documents(
        lines(spark, document(8, d3="", d7="A"), document(7), document(30)),
        require=(),
        check_width=False,
    )
    assert Counter((d.src_common_name, tuple(d.themes)) for d in docs.collect()) == {
        ("", ()): 1,
        ("src", ("A", "B")): 1,
    }


def test_documents_and_their_rejects(spark):
    bad = {
        document(26): "width",
        document(d3=""): "empty",
        document(d4=""): "empty",
        document(d7=""): "empty",
    }
    given = lines(spark, document(), document(d7="TAX_A;B,3;rest"), *bad)
    got = sorted((d.src_common_name, d.doc_id, d.themes) for d in parse_documents(given).collect())
    assert got == [("src", "url", ["A", "B"]), ("src", "url", ["TAX_A", "B,3"])]
    cleaned = parse_documents(given, taxonomy=["TAX"]).collect()
    assert sorted(d.themes for d in cleaned) == [["A", "B"], ["A", "B"]]
    rejects = rejected_lines(given, "documents")
    assert {r.line: r.reason for r in rejects.collect()} == bad
    assert parse_documents(given, require=DOCUMENT_REQUIRED_THEMES).count() == 4
    assert parse_documents(given, require=DOCUMENT_REQUIRED_SOURCE).count() == 4


def test_unknown_kind(spark):
    with pytest.raises(ValueError):
        rejected_lines(lines(spark, ""), "words")


def test_text_round_trip(spark, tmp_path):
    lines(spark, mention(), *BAD_MENTIONS).write.text(str(tmp_path / "20180720.mentions.csv"))
    lines(spark, document(d3="näme")).write.text(str(tmp_path / "20180720.gkg.csv"))
    lines(spark, document()).write.text(str(tmp_path / "20170720.gkg.csv"))
    mentions = read_mentions(spark, str(tmp_path / "*.mentions.csv"))
    assert mentions.count() == 1
    assert read_documents(spark, str(tmp_path / "201[7-8]*.gkg.csv")).count() == 2
    documents = read_documents(spark, str(tmp_path / "2018*.gkg.csv"))
    assert [d.src_common_name for d in documents.collect()] == ["näme"]
    register_views(mentions, documents)
    joined = spark.sql("SELECT * FROM mentions JOIN documents ON mention_id = doc_id")
    assert joined.select(F.size("themes")).collect() == [(2,)]


def test_driver_lines_known_counts(spark):
    from tonetide import driver_views as v

    sf_dir = "/root/testdata/sf0.01"
    given = v.ment_lines(spark, sf_dir)
    assert parse_mentions(given).count() == 42740
    rejects = rejected_lines(given, "mentions").groupBy("reason").count().collect()
    assert {r.reason: r["count"] for r in rejects} == {"tone": 8662, "width": 8598}
    assert parse_documents(v.docs_lines(spark, sf_dir)).count() == 2000


@pytest.mark.parametrize("grain", ["day", "second"])
@pytest.mark.parametrize("check_width", [True, False])
def test_every_line_is_parsed_or_rejected(spark, grain, check_width):
    given = [mention(), mention(m2="20180720996015"), mention(m2="20180720"), mention(m2="2018"), *BAD_MENTIONS]
    given += [mention(n) for n in (0, 1, 3, 6, 13, 14, 15, 17)]
    rows = lines(spark, *given)
    parsed = parse_mentions(rows, grain, check_width=check_width).count()
    rejects = rejected_lines(rows, "mentions", grain=grain, check_width=check_width)
    assert parsed + rejects.count() == len(given)
    docs = lines(spark, *[document(n) for n in (1, 4, 7, 8, 26, 27, 30)], document(d3=""))
    parsed = parse_documents(docs, check_width=check_width).count()
    assert parsed + rejected_lines(docs, "documents", check_width=check_width).count() == 8


def matches(glob, name):
    """Whether a name is matched by one of the alternatives of a glob."""
    before, inner, after = re.fullmatch(r"(.*)\{(.*)\}(.*)", glob).groups()
    return any(fnmatch.fnmatchcase(name, before + one + after) for one in inner.split(","))


@pytest.mark.parametrize("seed", range(20))
def test_globs_of_times_match_the_range_alone(seed):
    rng = random.Random(seed)
    first = datetime(2015, 1, 1) + timedelta(minutes=15 * rng.randrange(200_000))
    start, end = first, first + timedelta(minutes=15 * rng.choice([1, 3, 96, 2_977, 40_000]))
    if seed % 5 == 0:
        start = None
    elif seed % 5 == 1:
        end = None
    glob = time_glob("/feed/x.*.mentions.csv", start, end)
    assert glob.count(",") < 2 * 14
    low, high = start or datetime(1000, 1, 1), end or datetime(9999, 12, 31)
    moments = [m for m in (start, end) if m]
    moments += [m - timedelta(seconds=1) for m in moments]
    moments += [datetime(2015, 1, 1) + timedelta(minutes=15 * rng.randrange(250_000)) for _ in range(500)]
    for moment in moments:
        name = f"/feed/x.{moment:%Y%m%d%H%M%S}.mentions.csv"
        assert matches(glob, name) == (low <= moment < high), name
    assert not matches(glob, f"/feed/x.{first:%Y%m%d%H%M%S}.gkg.csv")


def test_globs_of_times_without_a_place_or_a_time():
    assert time_glob("/a/*.csv") == "/a/*.csv"
    with pytest.raises(ValueError):
        time_glob("/a*/b.csv", start=datetime(2020, 1, 1))
    with pytest.raises(ValueError):
        time_glob("/a/*.csv", datetime(2020, 1, 2), datetime(2020, 1, 2))


def test_files_of_other_times_are_not_opened(spark, tmp_path):
    for day in range(10, 29):
        (tmp_path / f"201807{day}063015.mentions.csv").write_text(mention(m5=f"u{day}") + "\n")
        (tmp_path / f"201807{day}063015.gkg.csv").write_text("bad\n")
    start, end = datetime(2018, 7, 18, 6, 30, 15), datetime(2018, 7, 21, 6, 30, 15)
    rows = read_mentions(spark, f"{tmp_path}/*.mentions.csv", start=start, end=end)
    opened = sorted(file.rsplit("/", 1)[1][:8] for file in rows.inputFiles())
    assert opened == ["20180718", "20180719", "20180720"]
    assert sorted(r.mention_id for r in rows.collect()) == ["u18", "u19", "u20"]
    rows = read_documents(spark, f"{tmp_path}/*.gkg.csv", end=datetime(2018, 7, 12))
    assert len(rows.inputFiles()) == 2 and rows.count() == 0
