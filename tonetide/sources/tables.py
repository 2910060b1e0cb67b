"""Result tables: constraints, date-partitioned Parquet, JDBC."""

from __future__ import annotations

import configparser
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonetide.schemas import HISTOGRAM_BINS, QUANTILE_PROBS, STATS_COLUMNS


def check_stats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that break the rules of a result table, one row per key and rule.

    Rules: no NULL in any column, ``num_mentions`` above zero, keys unique. The
    per-row rules are flagged before the one aggregation, which combines on the
    map side, so a key with many copies is no hot spot.
    """
    columns = [*keys, *[c for c in STATS_COLUMNS if c in df.columns]]
    broken = {
        "null": reduce(Column.__or__, [F.col(c).isNull() for c in columns]),
        "not_positive": F.col("num_mentions") <= 0,
    }
    per_key = df.groupBy(*keys).agg(
        *[F.count_if(rule).alias(name) for name, rule in broken.items()],
        F.count("*").alias("copies"),
    )
    per_key = per_key.withColumn("duplicate", F.when(F.col("copies") > 1, F.col("copies")))
    found = [
        F.when(F.col(name) > 0, F.struct(F.lit(name).alias("rule"), F.col(name).alias("rows")))
        for name in (*broken, "duplicate")
    ]
    return per_key.select(*keys, F.inline(F.array_compact(F.array(*found))))


def write_stats(df: DataFrame, path: str) -> None:
    """Write result rows as Parquet, partitioned by ``date``; safe to repeat.

    Only the days present in ``df`` are replaced, so running a job again for the
    same input leaves the table as it was. The rebalance hint gathers the rows of
    a day, splits days that are large and merges files that would be tiny.
    """
    (
        df.withColumn("date", F.to_date("time"))
        .hint("rebalance", "date")
        .sortWithinPartitions("date", "theme", F.desc("time"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("date")
        .parquet(path)
    )


def read_stats(spark: SparkSession, path: str) -> DataFrame:
    """A table written by :func:`write_stats`, ``date`` included for pruning."""
    return spark.read.parquet(path)


def _spread(array: str, width: int, prefix: str) -> list[Column]:
    """One column per element; an array of another size is an error, never cut."""
    fits = F.size(array) == width
    wrong = F.raise_error(F.concat(F.lit(f"{array} has not {width} elements but "), F.size(array)))
    return [
        F.when(fits, F.get(array, F.lit(i))).otherwise(wrong).alias(f"{prefix}{i}")
        for i in range(width)
    ]


def jdbc_rows(
    df: DataFrame,
    flatten: bool = False,
    quantiles: int = len(QUANTILE_PROBS),
    cells: int = HISTOGRAM_BINS + 2,
) -> DataFrame:
    """Result rows with the types of the database table.

    ``flatten`` spreads both arrays over plain columns (``q0``.., ``b0``..) for
    databases without array columns; ``quantiles`` and ``cells`` say how many
    elements they have.
    """
    rows = df.withColumn("num_mentions", F.col("num_mentions").cast("int"))
    if not flatten:
        return rows
    return rows.select(
        *[c for c in rows.columns if c not in ("quantiles", "bin_vals")],
        *_spread("quantiles", quantiles, "q"),
        *_spread("bin_vals", cells, "b"),
    )


def jdbc_settings(path: str, section: str = "postgresql") -> dict[str, str]:
    """Connection settings from an INI file, as keywords for :func:`write_jdbc`.

    ``url``, ``username``, ``password`` and ``driver`` are read; ``table``, if the
    section has one, comes along.
    """
    config = configparser.ConfigParser(interpolation=None)
    with open(path) as file:
        config.read_file(file)
    names = {"username": "user"}
    wanted = ("url", "username", "password", "driver", "table")
    given = config[section]
    return {names.get(name, name): given[name] for name in wanted if name in given}


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    flatten: bool = False,
    quantiles: int = len(QUANTILE_PROBS),
    cells: int = HISTOGRAM_BINS + 2,
    **options: str,
) -> None:
    """Append result rows to a database table; see :func:`jdbc_rows` for the widths.

    Everything the driver needs (user, password, driver class, ``numPartitions``
    to bound the open connections, ``batchsize``) comes from the caller, e.g. from
    :func:`jdbc_settings`. PostgreSQL turns the time into the column's type by
    itself. The table's primary key is what rejects a second run.
    """
    (
        jdbc_rows(df, flatten, quantiles, cells)
        .write.format("jdbc")
        .options(url=url, dbtable=table, **options)
        .mode("append")
        .save()
    )
