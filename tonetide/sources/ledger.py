"""Distinct tones kept per day and grown batch by batch.

The ledger holds one row per theme, time, source and tone with its weight: all that the
result tables need, and all that adds up. A batch is merged into the days it touches;
those days are written anew, whole, to a folder of their own, and a new version of the
manifest then points to them. So a day is never replaced by a part of it, a run that
dies before its manifest leaves nothing behind that a reader sees, and readers of the
version before go on undisturbed. The manifest also names the input files that are in,
which are skipped when they are handed in again.

One writer at a time. Layout below ``path``: ``days/<folder>/date=...`` and
``manifest/v=<version>``, one file each, whose rows are the days of that version with
their folders and the input files the version added.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER_KEYS = ("theme", "time", "src_common_name")
_ROWS = "theme string, time timestamp, src_common_name string, mention_doc_tone double, weight bigint"
_MANIFEST = "v int, kind string, name string, folder string"


def _manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """All versions, or nothing before the first batch."""
    try:
        found = spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return found


def _days(spark: SparkSession, path: str) -> tuple[int, dict[str, str]]:
    """The newest version and the folder of each of its days."""
    manifest = _manifest(spark, path)
    if manifest is None:
        return 0, {}
    version = manifest.agg(F.max("v")).first()[0]
    rows = manifest.where((F.col("v") == version) & (F.col("kind") == "day")).collect()
    return version, {row["name"]: row["folder"] for row in rows}


def batch_files(spark: SparkSession, path: str) -> DataFrame:
    """The input files that are in the ledger, as column ``file``."""
    manifest = _manifest(spark, path)
    if manifest is None:
        return spark.createDataFrame([], "file string")
    return manifest.where("kind = 'file'").select(F.col("name").alias("file")).distinct()


def read_ledger(
    spark: SparkSession, path: str, days: Iterable[str] | None = None
) -> DataFrame:
    """The rows of the newest version, of all days or of some (``YYYY-MM-DD``)."""
    _, folders = _days(spark, path)
    if days is not None:
        wanted = set(days)
        folders = {day: folder for day, folder in folders.items() if day in wanted}
    parts = [f"{path}/days/{folder}/date={day}" for day, folder in sorted(folders.items())]
    if not parts:
        return spark.createDataFrame([], _ROWS)
    return spark.read.schema(_ROWS).parquet(*parts)


def add_batch(
    spark: SparkSession,
    path: str,
    files: Sequence[str],
    tones: Callable[[list[str]], DataFrame],
) -> list[str]:
    """Merge the files that are not in yet; returns the days that changed.

    ``tones`` turns a list of files into rows of :func:`tonetide.operators.theme_tones`.
    """
    given = spark.createDataFrame([(file,) for file in dict.fromkeys(files)], "file string")
    known = batch_files(spark, path)
    new = [row.file for row in given.join(known, "file", "left_anti").collect()]
    new = [file for file in dict.fromkeys(files) if file in set(new)]
    if not new:
        return []
    version, folders = _days(spark, path)
    folder = uuid.uuid4().hex
    fresh = (
        tones(new)
        .groupBy(*LEDGER_KEYS, "mention_doc_tone")
        .agg(F.sum("weight").alias("weight"))
    )
    target = f"{path}/days/{folder}"
    # First what the batch adds: the days it touches are known from what was written.
    staged = f"{path}/days/{folder}-batch"
    fresh.write.parquet(staged)
    fresh = spark.read.schema(_ROWS).parquet(staged)
    touched = [
        row.day
        for row in fresh.select(F.date_format("time", "yyyy-MM-dd").alias("day")).distinct().collect()
    ]
    before = read_ledger(spark, path, touched)
    (
        before.unionByName(fresh)
        .groupBy(*LEDGER_KEYS, "mention_doc_tone")
        .agg(F.sum("weight").alias("weight"))
        .withColumn("date", F.date_format("time", "yyyy-MM-dd"))
        .hint("rebalance", "date")
        .write.partitionBy("date")
        .parquet(target)
    )
    folders |= dict.fromkeys(touched, folder)
    rows = [("day", day, where) for day, where in sorted(folders.items())]
    rows += [("file", file, None) for file in new]
    (
        spark.createDataFrame(rows, "kind string, name string, folder string")
        .coalesce(1)
        .write.parquet(f"{path}/manifest/v={version + 1}")
    )
    return sorted(touched)
