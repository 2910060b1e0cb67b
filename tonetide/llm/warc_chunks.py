"""WARC archives written from and read into a table of record chunks.

A payload is a run of rows (record id, chunk number, bytes). The task that cuts it holds
it once more in UTF-8; no step after that holds a whole payload. Chunks are cut inside
Spark; a digest runs
along a record's chunks and every chunk carries it as far as it has come, so the
last has the payload's digest and a reader can check each chunk by itself.

Archives are gzip members, one for each record. Of records with equal payloads of at
least LEAST_BYTES bytes the one with the smallest id is a ``response``, the others
are ``revisit`` records that name it and hold no payload.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonetide.llm.common import keep, new_folder

CHUNK = 1 << 16
LEAST_BYTES = 100
READ = 1 << 20
# A date that doesn't change between runs; the table has none.
DATE = "2024-01-01T00:00:00Z"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_CHUNKS = "record_id long, url string, chunk_no int, last boolean, size long, digest string, data binary"


def one_row_per_id(pages: DataFrame) -> DataFrame:
    """Rows with an id, each id once: by smallest url, then smallest SHA-256 of the html.

    A null url comes first, a null html counts as empty. Only rows whose id occurs more
    than once are looked at again; payloads of the others stay where they are.
    """
    named = pages.where("page_id IS NOT NULL").select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")
    )
    repeated = keep(
        named.groupBy("page_id").agg(F.count("*").alias("n")).where("n > 1").select("page_id"), "repeated"
    )
    if repeated.isEmpty():
        return named
    row = F.struct("url", F.sha2("html", 256).alias("sha")).alias("_row")
    several = named.join(repeated, "page_id", "left_semi").select("*", row)
    chosen = keep(several.groupBy("page_id").agg(F.min("_row").alias("_first")), "chosen")
    ours = (several["page_id"] == chosen["page_id"]) & several["_row"].eqNullSafe(chosen["_first"])
    kept = several.join(chosen, ours, "left_semi").select("page_id", "url", "html")
    return named.join(repeated, "page_id", "left_anti").union(kept.dropDuplicates(["page_id"]))


def chunk_table(pages: DataFrame) -> DataFrame:
    """``record_id``, ``url``, ``chunk_no``, ``last``, ``data``; a record's chunks in a row.

    A null payload counts as empty; an empty one is one chunk of no bytes.
    """
    body = F.encode(F.coalesce("html", F.lit("")), "utf-8")
    chunks = F.greatest(F.ceil(F.length(body) / CHUNK), F.lit(1)).cast("int")
    cut = pages.select(
        F.col("page_id").cast("long").alias("record_id"),
        "url",
        body.alias("body"),
        chunks.alias("chunks"),
        F.explode(F.sequence(F.lit(0), chunks - 1)).alias("chunk_no"),
    )
    return cut.select(
        "record_id",
        "url",
        "chunk_no",
        (F.col("chunk_no") == F.col("chunks") - 1).alias("last"),
        F.expr(f"substring(body, chunk_no * {CHUNK} + 1, {CHUNK})").alias("data"),
    )


def _run_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    running, size = hashlib.sha256(), 0
    for batch in batches:
        digests, sizes = [], []
        for number, data in zip(batch.column(2).to_pylist(), batch.column(4), strict=True):
            if number == 0:
                running, size = hashlib.sha256(), 0
            part = data.as_buffer()
            running.update(part)
            size += part.size
            digests.append(running.hexdigest())
            sizes.append(size)
        yield pa.record_batch(
            [*(batch.column(c) for c in range(4)), pa.array(sizes, pa.int64()), pa.array(digests), batch.column(4)],
            ["record_id", "url", "chunk_no", "last", "size", "digest", "data"],
        )


def with_digests(chunks: DataFrame) -> DataFrame:
    """Chunks with the size and SHA-256 of their record up to their end.

    Reads chunks as :func:`chunk_table` leaves them: a record's chunks follow each
    other in one partition.
    """
    return chunks.select("record_id", "url", "chunk_no", "last", "data").mapInArrow(
        _run_digests, _CHUNKS
    )


def record_roles(chunks: DataFrame) -> DataFrame:
    """``record_id``, ``payload_bytes``, ``payload_digest``, ``record_type``, ``refers_to``."""
    whole = keep(
        chunks.where("last").select(
            "record_id", F.col("size").alias("payload_bytes"), F.col("digest").alias("payload_digest")
        ),
        "records",
    )
    # Copies meet only in a minimum that is combined before the shuffle; the way
    # back is a plain join, whose hot payload adaptive execution can split.
    first = (
        whole.where(F.col("payload_bytes") >= LEAST_BYTES)
        .groupBy("payload_digest")
        .agg(F.min("record_id").alias("first"))
    )
    again = F.coalesce(F.col("first") < F.col("record_id"), F.lit(False))
    return whole.join(first, "payload_digest", "left").select(
        "record_id",
        "payload_bytes",
        "payload_digest",
        F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first")).alias("refers_to"),
    )


def record_urn(record_id: int) -> str:
    return f"<urn:uuid:{uuid.UUID(int=record_id & (1 << 64) - 1)}>"


def _uri(url: str | None) -> str:
    """A url safe in a header line; an absent one is named so."""
    return re.sub(rb"[^\x21-\x7e]", lambda m: b"%%%02X" % m[0][0], (url or "about:blank").encode()).decode()


def header(row: dict) -> bytes:
    """WARC and HTTP headers of a record; the payload of a response follows."""
    http = HTTP.format(row["payload_bytes"]).encode()
    lines = [
        "WARC/1.1",
        f"WARC-Type: {row['record_type']}",
        f"WARC-Record-ID: {record_urn(row['record_id'])}",
        f"WARC-Target-URI: {_uri(row['url'])}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{row['payload_digest']}",
        "Content-Type: application/http; msgtype=response",
    ]
    length = len(http)
    if row["record_type"] == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_urn(row['refers_to'])}"]
    else:
        length += row["payload_bytes"]
    lines.append(f"Content-Length: {length}")
    return ("\r\n".join(lines) + "\r\n\r\n").encode() + http


def write_archives(chunks: DataFrame, roles: DataFrame, folder: str) -> DataFrame:
    """Write one record per row of ``roles``; returns ``path`` and ``records`` per archive."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = pafs.FileSystem.from_uri(folder)
        fs.create_dir(root, recursive=True)
        path = f"{root}/pages-{TaskContext.get().partitionId():06d}.warc.gz"
        attempt = f"{root}/.tmp-{uuid.uuid4().hex}"
        records = 0
        with fs.open_output_stream(attempt, compression=None) as stream:
            member = None
            for batch in batches:
                for row in batch.to_pylist():
                    if row["chunk_no"] == 0:
                        records += 1
                        member = zlib.compressobj(6, zlib.DEFLATED, 31)
                        stream.write(member.compress(header(row)))
                    if row["record_type"] == "response":
                        stream.write(member.compress(row["data"]))
                    if row["last"] or row["record_type"] == "revisit":
                        stream.write(member.compress(b"\r\n\r\n") + member.flush())
        if not records:
            fs.delete_file(attempt)
            return
        fs.move(attempt, path)
        yield pa.record_batch([pa.array([path]), pa.array([records])], ["path", "records"])

    # The chunks of a record lie in one partition before and after this join, however
    # it is carried out: they come from one task and go where their id sends them.
    # Of a revisit only the first chunk travels, and without its bytes.
    rows = chunks.select("record_id", "url", "chunk_no", "last", "data").join(roles, "record_id")
    revisit = F.col("record_type") == "revisit"
    return (
        rows.where(~revisit | (F.col("chunk_no") == 0))
        .withColumn("data", F.when(revisit, F.lit(b"")).otherwise(F.col("data")))
        .sortWithinPartitions("record_id", "chunk_no")
        .mapInArrow(write, "path string, records long")
    )


class ArchiveReader:
    """Streams an archive: headers of each record, then its payload piece by piece."""

    def __init__(self, stream):
        self.stream = stream
        self.raw = b""
        self.data = b""
        self.member = zlib.decompressobj(31)

    def _more(self) -> bool:
        while True:
            if self.member.eof:
                self.raw = self.member.unused_data + self.raw
                self.member = zlib.decompressobj(31)
            if not self.raw:
                self.raw = self.stream.read(READ)
                if not self.raw:
                    return False
            data = self.member.decompress(self.raw, READ)
            self.raw = self.member.unconsumed_tail
            if data:
                self.data += data
                return True

    def _until(self, mark: bytes) -> bytes | None:
        while (at := self.data.find(mark)) < 0:
            if not self._more():
                if self.data.strip():
                    raise ValueError("archive is cut short")
                return None
        found, self.data = self.data[:at], self.data[at + len(mark) :]
        return found

    def _fields(self) -> dict[str, str] | None:
        block = self._until(b"\r\n\r\n")
        if block is None:
            return None
        lines = block.decode().split("\r\n")
        return {"": lines[0]} | dict(line.split(": ", 1) for line in lines[1:])

    def records(self) -> Iterator[tuple[dict, dict, Iterator[bytes]]]:
        """(WARC fields, HTTP fields, pieces of the payload) of every record, in order."""
        while (warc := self._fields()) is not None:
            if not warc[""].startswith("WARC/"):
                raise ValueError("not a WARC record")
            http = self._fields()
            left = int(http["Content-Length"]) if warc["WARC-Type"] == "response" else 0

            def payload(left=left):
                while left:
                    if not self.data and not self._more():
                        raise ValueError("archive is cut short")
                    part, self.data = self.data[:left], self.data[left:]
                    left -= len(part)
                    yield part

            own = payload()
            yield warc, http, own
            for _ in own:
                pass
            if self._until(b"\r\n\r\n") != b"":
                raise ValueError("record is longer than it says")


def read_archives(files: DataFrame, folder: str) -> DataFrame:
    """The chunk table of archives: fields of the record, ``chunk_no``, ``last``, running digest, ``data``.

    A record without payload gives one chunk without bytes.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = pafs.FileSystem.from_uri(folder)
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, size = [], 0
                with fs.open_input_stream(path, compression=None) as stream:
                    for warc, http, payload in ArchiveReader(stream).records():
                        for row in _chunks_of(warc, http, payload):
                            rows.append(row)
                            size += len(row["data"]) + 500
                            if size >= READ:
                                yield _batch(rows)
                                rows, size = [], 0
                if rows:
                    yield _batch(rows)

    return files.select("path").mapInArrow(read, _READ)


_READ = (
    "record_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, chunk_no int, last boolean, digest string, data binary"
)


def _batch(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary()}
    fields = [field.split(" ") for field in _READ.split(", ")]
    return pa.RecordBatch.from_pylist(rows, pa.schema([(name, kinds[kind]) for name, kind in fields]))


def _id_of(urn: str) -> int:
    number = uuid.UUID(urn.strip("<>").removeprefix("urn:uuid:")).int
    return number - (1 << 64) if number >= 1 << 63 else number


def _chunks_of(warc: dict, http: dict, payload: Iterator[bytes]) -> Iterator[dict]:
    base = {
        "record_id": _id_of(warc["WARC-Record-ID"]),
        "url": warc["WARC-Target-URI"],
        "record_type": warc["WARC-Type"],
        "refers_to": _id_of(warc["WARC-Refers-To"]) if "WARC-Refers-To" in warc else None,
        "payload_bytes": int(http["Content-Length"]),
        "payload_digest": warc["WARC-Payload-Digest"].removeprefix("sha256:"),
    }
    running, held, number = hashlib.sha256(), b"", 0
    for part in payload:
        held += part
        while len(held) > CHUNK:
            running.update(held[:CHUNK])
            yield base | {"chunk_no": number, "last": False, "digest": running.hexdigest(), "data": held[:CHUNK]}
            held, number = held[CHUNK:], number + 1
    running.update(held)
    digest = running.hexdigest()
    if base["record_type"] == "response" and digest != base["payload_digest"]:
        raise ValueError(f"payload of record {base['record_id']} is damaged")
    yield base | {"chunk_no": number, "last": True, "digest": digest, "data": held}


def archive_and_read(spark: SparkSession, pages: DataFrame, files: int) -> DataFrame:
    """Write every row of ``pages`` as a record and describe what is read back.

    ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type``,
    ``refers_to``, ``chunks``. Needs ``page_id``, ``url``, ``html``; a null html is
    an empty payload, a null url is written as ``about:blank``. Rows that repeat an
    id count once, see :func:`one_row_per_id`; rows with a null id are left out. An empty table writes nothing; other columns are ignored.
    """
    folder = new_folder(spark, "warc")
    chunks = with_digests(chunk_table(one_row_per_id(pages)))
    roles = keep(record_roles(chunks), "roles")
    written = keep(write_archives(chunks, roles, folder), "archives")
    back = read_archives(written.repartition(files, "path"), folder)
    return back.where("last").select(
        F.col("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
        (F.col("chunk_no") + 1).alias("chunks"),
    )
