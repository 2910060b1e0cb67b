"""Reading the two tab-separated feeds.

``read_*`` takes a path, which may be a glob such as ``2018*.gkg.csv``, and with
``start`` or ``end`` opens only the files whose names lie in that time;
``parse_*`` takes a DataFrame with one string column ``value``, so the same rules
serve text files, tables of lines and tests.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonetide.functions import (
    GRAINS,
    all_non_empty,
    clean_themes,
    has_width,
    is_number,
    once,
    theme_list,
    to_double,
)
from tonetide.schemas import (
    DOCUMENT_FIELDS,
    DOCUMENT_REQUIRED,
    DOCUMENT_WIDTH,
    MENTION_FIELDS,
    MENTION_REQUIRED,
    MENTION_WIDTH,
)

_MENTION_COLUMNS = ("mention_id", "mention_doc_tone", "mention_time_date")
_DOCUMENT_COLUMNS = ("src_common_name", "doc_id", "themes")
# Digits of the time in the name of a feed file.
_TIME_DIGITS = 14


def _fields(lines: DataFrame, *keep: str) -> DataFrame:
    """Cut every line at its tabs; trailing empty fields count."""
    return lines.select(*keep, once(F.split("value", "\t")).alias("fields"))


def _field(position: int) -> Column:
    return F.get(F.col("fields"), F.lit(position))


def _parse(
    lines: DataFrame,
    positions: dict[str, int],
    width: int | None,
    require: Sequence[str],
    columns: Sequence[str],
) -> DataFrame:
    rows = _fields(lines)
    if width is not None:
        rows = rows.where(has_width(F.col("fields"), width))
    if require:
        rows = rows.where(all_non_empty(*[_field(positions[name]) for name in require]))
    rows = rows.select(*[_field(positions[name]).alias(name) for name in columns])
    # Only reachable without a width check: the line ends before the field.
    return rows.dropna() if width is None else rows


def parse_mentions(
    lines: DataFrame,
    grain: str = "day",
    require: Sequence[str] = MENTION_REQUIRED,
    check_width: bool = True,
) -> DataFrame:
    """Mentions from feed lines.

    Columns are the id, tone and time of the mention, then any further field that
    ``require`` names. Lines of the wrong width, with an empty required field, a
    tone that is no number or a time that is no date are left out;
    :func:`rejected_lines` lists them.
    """
    extra = [name for name in require if name not in _MENTION_COLUMNS]
    rows = _parse(
        lines,
        MENTION_FIELDS,
        MENTION_WIDTH if check_width else None,
        require,
        [*_MENTION_COLUMNS, *extra],
    )
    parsed = F.struct(
        to_double(F.col("mention_doc_tone")).alias("tone"),
        GRAINS[grain](F.col("mention_time_date")).alias("time"),
    )
    return (
        rows.select("mention_id", *extra, once(parsed).alias("parsed"))
        .where(F.col("parsed.tone").isNotNull() & F.col("parsed.time").isNotNull())
        .select(
            "mention_id",
            F.col("parsed.tone").alias("mention_doc_tone"),
            F.col("parsed.time").alias("mention_time_date"),
            *extra,
        )
    )


def parse_documents(
    lines: DataFrame,
    taxonomy: Iterable[str] | None = None,
    require: Sequence[str] = DOCUMENT_REQUIRED,
    check_width: bool = True,
) -> DataFrame:
    """Documents from feed lines, themes as an array of codes.

    With ``taxonomy`` the codes are cleaned right away; the tone jobs leave that
    to themselves so that they can drop unwanted themes in the same step.
    """
    rows = _parse(
        lines, DOCUMENT_FIELDS, DOCUMENT_WIDTH if check_width else None, require, _DOCUMENT_COLUMNS
    )
    themes = theme_list(F.col("themes"))
    if taxonomy is not None:
        themes = clean_themes(themes, taxonomy)
    return rows.withColumn("themes", themes)


def rejected_lines(
    lines: DataFrame,
    kind: str,
    require: Sequence[str] | None = None,
    grain: str = "day",
    check_width: bool = True,
) -> DataFrame:
    """Lines the parser leaves out when called with the same arguments, with the first rule they break.

    ``kind`` is ``mentions`` or ``documents``. Rules are tried in the order width,
    empty, tone, time; the last two exist for mentions only. Without
    ``check_width`` the width rule asks only for the fields that are used.
    """
    if kind == "mentions":
        width, positions, columns = MENTION_WIDTH, MENTION_FIELDS, _MENTION_COLUMNS
        require = MENTION_REQUIRED if require is None else require
    elif kind == "documents":
        width, positions, columns = DOCUMENT_WIDTH, DOCUMENT_FIELDS, _DOCUMENT_COLUMNS
        require = DOCUMENT_REQUIRED if require is None else require
    else:
        raise ValueError(f"unknown kind of lines: {kind!r}")

    if check_width:
        narrow = ~has_width(F.col("fields"), width)
    else:
        narrow = F.size("fields") <= max(positions[name] for name in (*columns, *require))
    reason = F.when(narrow, "width").when(
        ~all_non_empty(*[_field(positions[name]) for name in require]), "empty"
    )
    if kind == "mentions":
        time = _field(positions["mention_time_date"])
        reason = reason.when(~is_number(_field(positions["mention_doc_tone"])), "tone").when(
            GRAINS[grain](time).isNull(), "time"
        )
    return (
        _fields(lines, "value")
        .select(F.col("value").alias("line"), reason.alias("reason"))
        .where(F.col("reason").isNotNull())
    )


def time_glob(path: str, start: datetime | None = None, end: datetime | None = None) -> str:
    """``path`` narrowed to the files of a time, by name alone.

    Feed files are named after their time, ``YYYYMMDDHHMMSS``; it stands where the last
    part of ``path`` has its first ``*`` (``feed/*.mentions.csv``). The result is a glob
    for the names from ``start`` up to but not at ``end``, so files of other times are
    never opened. The range is covered by runs of names that share leading digits: at
    most two for every digit, however many files there are.
    """
    if start is None and end is None:
        return path
    folder, slash, name = path.rpartition("/")
    before, star, after = name.partition("*")
    if not star:
        raise ValueError(f"no * for the time in the last part of {path!r}")
    low = int(f"{start:%Y%m%d%H%M%S}") if start else 0
    high = int(f"{end:%Y%m%d%H%M%S}") if end else 10**_TIME_DIGITS
    if low >= high:
        raise ValueError(f"no time between {start} and {end}")
    runs = []
    while low < high:
        free = 0  # trailing digits that may be anything
        while low % 10 ** (free + 1) == 0 and low + 10 ** (free + 1) <= high:
            free += 1
        step = 10**free
        first = low // step % 10
        last = first + min(9 - first, (high - low) // step - 1)
        lead = f"{low // step // 10:0{_TIME_DIGITS - free - 1}d}" if free < _TIME_DIGITS - 1 else ""
        runs.append(f"{lead}[{first}-{last}]" + "?" * free)
        low += (last - first + 1) * step
    return f"{folder}{slash}{before}{{{','.join(runs)}}}*{after}"


def read_mentions(
    spark: SparkSession,
    path: str,
    grain: str = "day",
    require: Sequence[str] = MENTION_REQUIRED,
    check_width: bool = True,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """:func:`parse_mentions` over text files, of all times or some (:func:`time_glob`)."""
    lines = spark.read.text(time_glob(path, start, end))
    return parse_mentions(lines, grain, require, check_width)


def read_documents(
    spark: SparkSession,
    path: str,
    taxonomy: Iterable[str] | None = None,
    require: Sequence[str] = DOCUMENT_REQUIRED,
    check_width: bool = True,
    start: datetime | None = None,
    end: datetime | None = None,
) -> DataFrame:
    """:func:`parse_documents` over text files, of all times or some (:func:`time_glob`)."""
    lines = spark.read.text(time_glob(path, start, end))
    return parse_documents(lines, taxonomy, require, check_width)


def register_views(
    mentions: DataFrame,
    documents: DataFrame,
    names: tuple[str, str] = ("mentions", "documents"),
) -> None:
    """Make both inputs addressable by name in ``spark.sql``."""
    mentions.createOrReplaceTempView(names[0])
    documents.createOrReplaceTempView(names[1])
