"""Finished steps of a run, kept so that a run that died goes on where it stopped.

A run is known by what it does: its arguments and the names, sizes and times of its
input files. Below the shared folder each run has attempts, and an attempt has one
marker for each finished step, written after everything the step wrote. A run that
finds an attempt without its last marker takes that attempt up; otherwise it starts a new
one, so a run that is simply repeated does all its work again.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

END = "end"
_MARKS = "attempt int, step string, result string"


def input_state(spark: SparkSession, paths: Sequence[str]) -> str:
    """One value that changes when a file behind the paths comes, goes or changes."""
    # Only the listing is read: the column with the contents is pruned.
    files = spark.read.format("binaryFile").load(sorted(set(paths)))
    entry = F.xxhash64("path", "modificationTime", "length").cast("decimal(20,0)")
    state = files.agg(F.count("*"), F.sum(entry)).first()
    return f"{state[0]}:{state[1]}"


class Steps:
    """The steps of one run, marked below ``folder``; ``arguments`` must be JSON values."""

    def __init__(self, spark: SparkSession, folder: str, arguments: object):
        text = json.dumps(arguments, sort_keys=True)
        self.spark = spark
        self.folder = f"{folder}/runs/{hashlib.sha256(text.encode()).hexdigest()}"
        marks = self._marks()
        last = max((mark["attempt"] for mark in marks), default=0)
        self.results = {m["step"]: m["result"] for m in marks if m["attempt"] == last}
        self.attempt = last
        if not marks or END in self.results:
            self.attempt, self.results = last + 1, {}

    def _marks(self) -> list:
        """As many rows as the attempts have steps."""
        try:
            return self.spark.read.schema(_MARKS).parquet(f"{self.folder}/*/*").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []

    def do(self, step: str, work: Callable[[], str | None]) -> str | None:
        """The result of a step, from its marker if it is finished.

        A step must be safe to repeat, as it may die before its marker is written.
        """
        if step not in self.results:
            result = work()
            row = self.spark.createDataFrame([(self.attempt, step, result)], _MARKS)
            row.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/{self.attempt}/{step}")
            self.results[step] = result
        return self.results[step]
