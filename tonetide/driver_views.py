"""The feeds as views over the benchmark's Parquet tables.

The tables hold no news, so documents are derived from ``part`` and mentions from
``lineitem``: coded themes from the type, brand and name of a part, a tone from
the quantity of a line. Everything is a projection of whole tables, so the views
grow with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonetide.functions import GRAINS, theme_list
from tonetide.schemas import (
    DOCUMENT_FIELDS,
    DOCUMENT_WIDTH,
    MENTION_FIELDS,
    MENTION_WIDTH,
)

# Vocabularies that fit the derived themes and sources.
TAXONOMY = ("ECONOMY", "SMALL", "MEDIUM", "PROMO", "STANDARD", "LARGE", "TAX")
THEMES = ("BLUE_GEAR", "STANDARD", "RED_WIDGET")
SOURCES = ("Brand#1", "Brand#2")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id``, ``src_common_name`` and ``raw_themes`` as one string."""
    kind = F.upper("p_type")
    name = F.upper(F.replace("p_name", F.lit(" "), F.lit("_")))
    brand = F.replace("p_brand", F.lit("#"), F.lit(""))
    codes = (kind, "_", brand, "_", name, ",7;", kind, ";TAX_", kind, ";DROPPED")
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("doc_id"),
        F.col("p_brand").alias("src_common_name"),
        F.concat(*[F.lit(c) if isinstance(c, str) else c for c in codes]).alias("raw_themes"),
    )


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as the parser returns them."""
    return raw_docs(spark, sf_dir).select(
        "src_common_name", "doc_id", theme_list(F.col("raw_themes")).alias("themes")
    )


def raw_ment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mentions with the time still in feed notation, plus what the lines need."""
    line = F.lpad(F.col("l_linenumber").cast("string"), 2, "0")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("event_id"),
        F.col("l_suppkey").cast("string").alias("mention_src_name"),
        F.col("l_partkey").cast("string").alias("mention_id"),
        ((F.col("l_quantity") - 25) / 2).alias("mention_doc_tone"),
        F.date_format("l_shipdate", "yyyyMMdd").alias("raw_day"),
        F.concat(F.date_format("l_shipdate", "yyyyMMdd"), line, F.lit("3015")).alias("raw_time"),
        F.col("l_linenumber").alias("line_number"),
    )


def ment(spark: SparkSession, sf_dir: str, grain: str = "day") -> DataFrame:
    """Mentions as the parser returns them."""
    return raw_ment(spark, sf_dir).select(
        "mention_id",
        "mention_doc_tone",
        GRAINS[grain](F.col("raw_time")).alias("mention_time_date"),
    )


def _line(width: int, filled: dict[int, Column]) -> Column:
    return F.concat_ws("\t", *[filled.get(i, F.lit("x")) for i in range(width)]).alias("value")


def docs_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as feed lines."""
    filled = {
        DOCUMENT_FIELDS["src_common_name"]: F.col("src_common_name"),
        DOCUMENT_FIELDS["doc_id"]: F.col("doc_id"),
        DOCUMENT_FIELDS["themes"]: F.col("raw_themes"),
    }
    return raw_docs(spark, sf_dir).select(_line(DOCUMENT_WIDTH, filled))


def ment_lines(spark: SparkSession, sf_dir: str, bad_times: bool = False) -> DataFrame:
    """Mentions as feed lines; the sixth and seventh line of an order are bad.

    The sixth has a tone that is no number. The seventh is one field short, as
    ``concat_ws`` leaves out the NULL at its end. With ``bad_times`` the fourth has
    an hour that is none and the fifth only a day.
    """
    number = F.col("line_number")
    tone = F.when(number == 6, "n/a").otherwise(F.col("mention_doc_tone").cast("string"))
    time = F.col("raw_time")
    if bad_times:
        day = F.substring("raw_time", 1, 8)
        time = F.when(number == 4, F.concat(day, F.lit("996015"))).when(number == 5, day).otherwise(time)
    filled = {
        MENTION_FIELDS["event_id"]: F.col("event_id"),
        MENTION_FIELDS["event_time_date"]: F.col("raw_day"),
        MENTION_FIELDS["mention_time_date"]: time,
        MENTION_FIELDS["mention_src_name"]: F.col("mention_src_name"),
        MENTION_FIELDS["mention_id"]: F.col("mention_id"),
        MENTION_FIELDS["mention_doc_tone"]: tone,
        MENTION_WIDTH - 1: F.when(number != 7, "x"),
    }
    return raw_ment(spark, sf_dir).select(_line(MENTION_WIDTH, filled))


def ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tones of events: few themes and days, hence dense groups."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("theme"),
        F.date_trunc("day", "ts").alias("time"),
        F.col("user_id").cast("string").alias("src_common_name"),
        ((F.col("value") - 50) / 5).alias("mention_doc_tone"),
    )


def doc_src(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source names of the text documents."""
    return table(spark, sf_dir, "documents").select(F.col("source").alias("src_common_name"))


def number_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantities written in ways that are or are not numbers, by line number."""
    q = F.col("l_quantity").cast("int").cast("string")
    forms = {
        1: q,
        2: F.concat(F.lit(" -"), q, F.lit(". ")),
        3: F.concat(q, F.lit("e2")),
        4: F.concat(q, F.lit("d")),
        5: F.concat(F.lit("0x"), q),
        6: F.concat(F.lit("."), q),
    }
    text = F.when(F.lit(False), "")
    for number, form in forms.items():
        text = text.when(F.col("l_linenumber") == number, form)
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", text.otherwise(F.lit("n/a")).alias("txt")
    )
