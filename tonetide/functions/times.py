"""Feed times (``YYYYMMDDHHMMSS``) as timestamps; NULL where they are no date."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def second_ts(col: Column) -> Column:
    """The full time; characters after the fourteenth are ignored."""
    return F.try_to_timestamp(F.substring(col, 1, 14), F.lit("yyyyMMddHHmmss"))


def day_ts(col: Column) -> Column:
    """Midnight of the day; only the first eight characters matter."""
    return F.try_to_timestamp(F.substring(col, 1, 8), F.lit("yyyyMMdd"))


GRAINS = {"day": day_ts, "second": second_ts}
