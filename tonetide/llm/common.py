"""What the operators share: the shared folder, written tables, Arrow batches in small pieces."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from weakref import WeakKeyDictionary

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What separates words everywhere in this folder: space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Rows per Arrow batch. Texts may be long, so far fewer than Spark's default.
BATCH_ROWS = 512
# Bytes of text handled at a time inside a task.
PIECE_BYTES = 1 << 21

# Spark's setting that a query's shuffle files are deleted when the query has ended.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_folder: dict[str, str] = {}
_kept: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def prepare(spark: SparkSession) -> SparkSession:
    """Keep Arrow batches of whole texts small; returns the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session may do without the setting: it then gets a temporary
    folder, which driver and tasks share as they are one process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir is not set")
    app = spark.sparkContext.applicationId
    if app not in _local_folder:
        _local_folder[app] = tempfile.mkdtemp(prefix="tonetide-")
    return _local_folder[app]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str = "table", **options: str) -> DataFrame:
    """``df`` written to the shared folder, with options of the writer, and read back.

    Cuts the lineage: a lost executor costs the tasks it ran, not the tables
    written so far, and readers of the result don't compute it again. So the shuffle
    files of the query that wrote it go at its end, not when the driver next collects.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    before = spark.conf.get(_SHUFFLES_GO, None)
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLES_GO)
        else:
            spark.conf.set(_SHUFFLES_GO, before)
    back = spark.read.schema(df.schema).parquet(path)
    _kept[back] = path
    return back


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``keep`` returned and that nothing reads any more."""
    for df in tables:
        path = _kept.pop(df)
        context = df.sparkSession.sparkContext
        where = context._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of an input table."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def lower_ascii(text: Column) -> Column:
    """A-Z to lower case, all else as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def pieces(batches: Iterator[pa.RecordBatch], text: int = 1) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of about ``PIECE_BYTES`` of the text column.

    A longer text is a slice by itself.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = offsets(batch.column(text))[1:]
        at = 0
        while at < batch.num_rows:
            begin = ends[at - 1] if at else offsets(batch.column(text))[0]
            to = int(np.searchsorted(ends, begin + PIECE_BYTES, side="right"))
            to = max(to, at + 1)
            yield batch.slice(at, to - at)
            at = to


def offsets(texts: pa.StringArray) -> np.ndarray:
    """Where the texts begin and end in their buffer, one more than there are texts."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if texts.buffers()[1] is None:
        return np.zeros(len(texts) + 1, np.int64)
    ends = np.frombuffer(texts.buffers()[1], kind)
    return ends[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def ids_of(batch: pa.RecordBatch, column: int = 0) -> np.ndarray:
    return np.asarray(batch.column(column).to_numpy(zero_copy_only=False), np.int64)
