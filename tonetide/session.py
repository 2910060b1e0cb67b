"""Session settings the jobs rely on."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

# Times in the feed carry no zone; reading and printing them in UTC keeps a day
# a day, whatever zone the cluster runs in.
_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def use_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    ``fallback`` is used only where that setting is missing. It must be a folder
    every executor can reach, so there is no default.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or fallback
    if not folder:
        raise ValueError("spark.checkpoint.dir is not set and no checkpoint folder was given")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """Where intermediate tables go: ``spark.checkpoint.dir``, or else below the warehouse.

    Either is a folder that the driver and all executors see.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/.intermediate"
    return folder.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    What reads the result several times shares one computation for certain, and a lost
    executor costs its tasks, not the table.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
