"""Token ids in files of independent zstandard frames with a seek table at the end.

File layout, all numbers little-endian:

* magic ``TTIDS001``
* frames: the ids of some consecutive documents as unsigned 32-bit integers, each
  frame a complete zstandard frame with its own content checksum
* seek table, a zstandard frame too, of one record for each document: doc_id (signed
  64-bit), frame number, first id within its frame, number of ids (unsigned 32-bit
  each); then one record for each frame: offset (64-bit), compressed bytes, crc32 of
  the compressed bytes (unsigned 32-bit each)
* footer: documents, frames (64-bit), bytes and crc32 of the seek table (32-bit),
  magic

A reader fetches the footer, the seek table and only the frames that hold the
documents it wants. Files are named by the range partition they hold, so ascending
names hold ascending ids. A task writes to a name of its own and renames the
finished file, so a task that is run again after a lost executor replaces it with an
equal one.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tonetide.llm.common import ids_of, keep, new_folder, offsets, pieces

MAGIC = b"TTIDS001"
FOOTER = struct.Struct("<QQII8s")
DOC = np.dtype([("doc_id", "<i8"), ("frame", "<u4"), ("first", "<u4"), ("count", "<u4")])
FRAME = np.dtype([("offset", "<u8"), ("size", "<u4"), ("crc", "<u4")])
# A frame is closed at the end of the document that takes it past this many ids.
FRAME_IDS = 1 << 16
END_ID = 2
# Runs and words a task remembers; more are encoded again when they come again.
CACHE_PIECES = 300_000
# Longer ones are never remembered.
CACHE_CHARS = 64
# Runs the library gets as one text.
TOGETHER = 256

# Letters besides a-z whose kind, lower case and normal form are beyond doubt; in UTF-8
# they begin with C3 to C5. A word of other characters goes to the library as a whole.
_LATIN = "\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f"
_OTHER = re.compile(rf"[^\x20-\x7E\x09-\x0D{_LATIN}]")
_GAP, _MARK, _LETTER, _DIGIT = range(4)
_KIND = np.full(256, _MARK, np.uint8)
_KIND[[0x20, 9, 10, 11, 12, 13]] = _GAP
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x41:0x5B] = _KIND[0x61:0x7B] = _KIND[0x80:] = _LETTER
_ODD = np.zeros(256, bool)
_ODD[:0x20] = _ODD[0x7F] = _ODD[0xC0:0xC3] = _ODD[0xC6:] = True
_ODD[9:14] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

_cache: dict[str, dict[str, bytes]] = {}
_last: dict[str, np.ndarray] = {}


def _encoder(tokenizer: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(tokenizer)
    model.encode_special_tokens = True
    return model


def _ids(model, texts: list[str]) -> list[bytes]:
    """Ids of each text, by the library."""
    coded = model.encode_batch_fast(texts, add_special_tokens=False)
    return [array("I", e.ids).tobytes() for e in coded]


def _ids_of_runs(model, name: str, runs: list[str]) -> list[bytes]:
    """Ids of each run; the library gets many as one text, as each ends in a token of its own kind."""
    if name not in _last:
        vocab = model.get_vocab()
        _last[name] = np.zeros(max(vocab.values()) + 1, bool)
        _last[name][[n for token, n in vocab.items() if token.endswith("</w>")]] = True
    out: list[bytes] = []
    together = [runs[i : i + TOGETHER] for i in range(0, len(runs), TOGETHER)]
    texts = [" ".join(part) for part in together]
    for part, ids in zip(together, _ids(model, texts), strict=True):
        to = (np.flatnonzero(_last[name][np.frombuffer(ids, "<u4")]) + 1) * 4
        if len(to) != len(part) or to[-1] != len(ids):
            out += _ids(model, part)
            continue
        to = to.tolist()
        out += [ids[low:high] for low, high in zip([0, *to], to)]
    return out


def runs_of(texts: pa.StringArray) -> tuple[pa.StringArray, np.ndarray]:
    """What the tokenizer encodes by itself, in turn, and where in that each text begins.

    Runs of letters, single digits, runs of other marks, and a lone apostrophe with the
    s, t, re, ve, m, ll or d behind it; A-Z in lower case. A word with a character other
    than ASCII and ``_LATIN`` stays whole and as it is.
    """
    at = offsets(texts)
    if at[-1] == at[0]:
        return pa.array([], pa.string()), np.zeros(len(at), np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    kind = _KIND[data]
    ink = kind != _GAP
    last = np.concatenate([[np.uint8(_GAP)], kind[:-1]])
    last[edge[:-1]] = _GAP
    starts = ink & ((kind != last) | (kind == _DIGIT))
    low = _LOWER[data]

    quote = np.flatnonzero((data == ord("'")) & (last != _MARK))
    # Zeros after the end of a text keep what is read there from being a letter.
    ends = np.flatnonzero(edge)[np.searchsorted(np.flatnonzero(edge), quote, side="right")]
    ahead = [
        np.where(quote + n < ends, low[np.minimum(quote + n, len(low) - 1)], 0) for n in (1, 2)
    ]
    one = np.isin(ahead[0], np.frombuffer(b"stmd", np.uint8))
    two = np.isin(ahead[0], np.frombuffer(b"rv", np.uint8)) & (ahead[1] == ord("e"))
    two |= (ahead[0] == ord("l")) & (ahead[1] == ord("l"))
    starts[quote[one | two] + 1] = False
    behind = np.concatenate([quote[one] + 2, quote[two] + 3])
    behind = behind[behind < len(data)]
    starts[behind] = ink[behind]

    odd = _ODD[data]
    for lead, follow in ((0xC3, 0x97), (0xC3, 0xB7), (0xC4, 0xB0)):
        odd[:-1] |= (data[:-1] == lead) & (data[1:] == follow)
    if odd.any():
        begins = ink & (last == _GAP)
        word = np.cumsum(begins) - 1
        whole = np.zeros(word[-1] + 1, bool)
        whole[word[odd]] = True
        inside = ink & whole[word]
        starts[inside] = begins[inside]
        low = np.where(inside, data, low)

    first = np.flatnonzero(starts)
    letters = low[ink]
    to = np.append(np.flatnonzero(starts[ink]), len(letters)).astype(np.int32)
    runs = pa.StringArray.from_buffers(len(first), pa.py_buffer(to), pa.py_buffer(letters))
    return runs, np.searchsorted(first, at)


def encode_texts(model, name: str, texts: pa.StringArray | list[str]) -> list[bytes]:
    """Ids of whole texts as little-endian unsigned 32-bit integers; null counts as empty.

    For tokenizers that drop white space, lower the case, split as ``runs_of`` does and end
    each run in a token with ``</w>``, which is tested for the given vocabulary: a text's
    ids are those of its runs in turn, so the library encodes each distinct run once.
    """
    known = _cache.setdefault(name, {})
    runs, first = runs_of(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()))
    coded = runs.dictionary_encode()
    distinct, order = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    fresh = [w for w in distinct if w not in known]
    whole = [w for w in fresh if _OTHER.search(w)]
    plain = [w for w in fresh if not _OTHER.search(w)]
    new = dict(zip(plain, _ids_of_runs(model, name, plain), strict=True))
    new.update(zip(whole, _ids(model, whole), strict=True))
    ids = [new[w] if w in new else known[w] for w in distinct]
    room = CACHE_PIECES - len(known)
    if room > 0:
        known.update([(w, v) for w, v in new.items() if len(w) <= CACHE_CHARS][:room])
    flat = np.frombuffer(b"".join(ids), "<u4")
    size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
    begin = np.cumsum(size) - size
    sizes = size[order]
    to = np.append(0, np.cumsum(sizes))
    flat = flat[np.repeat(begin[order] - to[:-1], sizes) + np.arange(to[-1])]
    return [flat[low:high].tobytes() for low, high in pairwise(to[first].tolist())]


class Writer:
    """One file; documents are added in ascending order."""

    def __init__(self, stream):
        self.stream, self.at = stream, len(MAGIC)
        self.docs: list[tuple] = []
        self.frames: list[tuple] = []
        self.open: list[bytes] = []
        self.open_ids = self.ids = 0
        self.squeeze = zstandard.ZstdCompressor(level=1, write_checksum=True)
        stream.write(MAGIC)

    def add(self, doc_id: int, ids: bytes) -> None:
        count = len(ids) // 4
        self.docs.append((doc_id, len(self.frames), self.open_ids, count))
        self.open.append(ids)
        self.open_ids += count
        self.ids += count
        if self.open_ids >= FRAME_IDS:
            self._close_frame()

    def _close_frame(self) -> None:
        if self.open:
            frame = self.squeeze.compress(b"".join(self.open))
            self.stream.write(frame)
            self.frames.append((self.at, len(frame), zlib.crc32(frame)))
            self.at += len(frame)
            self.open, self.open_ids = [], 0

    def finish(self) -> None:
        self._close_frame()
        seek = self.squeeze.compress(
            np.array(self.docs, DOC).tobytes() + np.array(self.frames, FRAME).tobytes()
        )
        self.stream.write(seek)
        self.stream.write(
            FOOTER.pack(len(self.docs), len(self.frames), len(seek), zlib.crc32(seek), MAGIC)
        )


class Reader:
    """Random access to one file; a damaged part raises ``ValueError``."""

    def __init__(self, stream):
        self.stream = stream
        end = stream.size()
        stream.seek(end - FOOTER.size)
        docs, frames, size, crc, magic = FOOTER.unpack(stream.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a token file, or cut short")
        stream.seek(end - FOOTER.size - size)
        seek = stream.read(size)
        if zlib.crc32(seek) != crc:
            raise ValueError("seek table is damaged")
        table = zstandard.ZstdDecompressor().decompress(seek)
        self.docs = np.frombuffer(table, DOC, docs)
        self.frames = np.frombuffer(table, FRAME, frames, docs * DOC.itemsize)

    def frame(self, number: int) -> bytes:
        offset, size, crc = self.frames[number].tolist()
        self.stream.seek(offset)
        data = self.stream.read(size)
        if zlib.crc32(data) != crc:
            raise ValueError(f"frame {number} is damaged")
        return zstandard.ZstdDecompressor().decompress(data)

    def read(self, wanted: Iterable[int] | None = None) -> Iterator[tuple[int, bytes]]:
        """(doc_id, ids) of the wanted documents, or of all, decompressing only their frames."""
        rows = self.docs
        if wanted is not None:
            rows = rows[np.isin(rows["doc_id"], np.fromiter(wanted, np.int64))]
        number, data = -1, b""
        for doc_id, frame, first, count in rows.tolist():
            if frame != number:
                number, data = frame, self.frame(frame)
            yield doc_id, data[4 * first : 4 * (first + count)]


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def write_ids(
    docs: DataFrame, tokenizer: str, folder: str, files: int, end_id: int = END_ID
) -> DataFrame:
    """Encode ``doc_id``, ``text`` and write the ids in ascending ``doc_id`` order.

    ``folder`` must be one that every executor reaches. Null texts count as empty.
    Returns, and by being read carries out, one row per file: ``file``, ``path``
    and ``ids`` (how many it holds).
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(folder)
        fs.create_dir(root, recursive=True)
        number = TaskContext.get().partitionId()
        path = f"{root}/ids-{number:06d}"
        attempt = f"{root}/.tmp-{uuid.uuid4().hex}"
        model, end = _encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        with fs.open_output_stream(attempt) as stream:
            writer = Writer(stream)
            for batch in pieces(batches):
                coded = encode_texts(model, tokenizer, batch.column(1))
                for doc_id, ids in zip(ids_of(batch).tolist(), coded, strict=True):
                    writer.add(doc_id, ids + end)
            writer.finish()
        if not writer.docs:
            fs.delete_file(attempt)
            return
        fs.move(attempt, path)
        yield pa.record_batch(
            [pa.array([number]), pa.array([path]), pa.array([writer.ids])], ["file", "path", "ids"]
        )

    return (
        docs.select("doc_id", "text")
        .repartitionByRange(files, "doc_id")
        .sortWithinPartitions("doc_id")
        .mapInArrow(write, "file long, path string, ids long")
    )


def read_ids(files: DataFrame, folder: str) -> DataFrame:
    """Read files back: ``file``, ``doc_id``, ``first`` (ids before it in the file), ``ids``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_folder(folder)
        for batch in batches:
            for number, path in zip(*(batch.column(c).to_pylist() for c in (0, 1)), strict=True):
                with fs.open_input_file(path) as stream:
                    rows, size, first = [], 0, 0
                    for doc_id, ids in Reader(stream).read():
                        rows.append((number, doc_id, first, ids))
                        first += len(ids) // 4
                        size += len(ids)
                        if size >= 4 << 20:
                            yield _rows(rows)
                            rows, size = [], 0
                    if rows:
                        yield _rows(rows)

    return files.select("file", "path").mapInArrow(
        read, "file long, doc_id long, first long, ids binary"
    )


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
    columns = [pa.array(values, kind) for values, kind in zip(zip(*rows), kinds, strict=True)]
    return pa.record_batch(columns, ["file", "doc_id", "first", "ids"])


def encode_to_files(spark: SparkSession, docs: DataFrame, tokenizer: str, files: int) -> DataFrame:
    """Write the ids of all documents, read them back, and describe every document.

    ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` (with the
    end id), ``ids_crc32`` (of its ids as little-endian unsigned 32-bit integers),
    ``path``. Null and empty texts hold the end id alone. Rows that repeat an id
    are documents of their own, next to each other; rows with a null id are left
    out. An empty table writes nothing. Other columns are ignored.
    """
    folder = new_folder(spark, "token-ids")
    docs = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id IS NOT NULL")
    written = keep(write_ids(docs, tokenizer, folder, files), "token-files")
    # One row per file, so this window is as long as the list of files.
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    base = written.select("file", "path", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    back = read_ids(written.repartition(files, "file"), folder)
    # Spark takes the ids for small, as it sizes them by the list of files; that list, one row
    # a file, is what may be sent to all.
    return back.join(F.broadcast(base), "file").select(
        "doc_id",
        (F.col("base") + F.col("first")).alias("start"),
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
        "path",
    )
