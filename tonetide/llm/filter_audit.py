"""What each of several filters removes in every order, over a sparse document-term matrix.

Texts become a document-term matrix in compressed sparse rows. Tasks first encode a
few MB of texts each with a dictionary of their own (``local_shards``). The distinct
words of all shards form one dictionary with a number per word (``number_words``), and
only a shard's own distinct words are shuffled for it, so a word that is everywhere costs
a row per shard, not a row per document. With the numbers put in, a shard is a piece of the matrix
(``csr_shards``): ``indptr``, ``terms``, ``counts``. The sum of a row is the text's
number of words, its stored entries are its distinct words; these decide the first two
filters (``row_flags``).

The other flags are single properties of a text, and equality with an earlier text,
found per digest (SHA-256). Documents then collapse to counts per part, set of failed
filters and labels, at most 2**5 * 4 rows a part, from which every order of the filters
is worked out.

Rows and edge cases: a null text is empty; a null language is the part with the empty
name; a null id is never larger than another, so its text counts as a first one, and it
makes no other text a repeat; rows with equal id and text count each, and neither is a
repeat of the other; several labels of one id count as set if one of them is 1; labels
without a document have no effect; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonetide.llm.common import keep, offsets

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITAL_PERCENT = 3
SYMBOLS = b"#$%&*|"
# Texts of one shard, in bytes and rows; a longer text is a shard of its own.
SHARD_BYTES = 12 << 20
SHARD_ROWS = 16_384
# A row group of written shards ends once it has so many bytes. Parquet's own rule looks after
# 100 rows, and a task that writes or reads that many shards holds them all at a time.
_GROUPS = {
    "parquet.block.size": str(8 << 20),
    "parquet.page.size.row.check.min": "1",
    "parquet.page.size.row.check.max": "1",
}

_ROWS = (
    "doc_ids array<long>, langs array<string>, digests array<binary>, "
    "capitals array<boolean>, symbols array<boolean>, indptr array<long>, "
)
LOCAL_SCHEMA = f"shard long, {_ROWS}words array<binary>, places array<int>, counts array<int>"
CSR_SCHEMA = f"shard long, {_ROWS}terms array<long>, counts array<int>"
NUMBERS_SCHEMA = "shard long, base long, at array<int>, low array<int>, words array<binary>"
FLAGS_SCHEMA = (
    "doc_id long, lang string, digest binary, n_words long, n_distinct long, "
    "A boolean, B boolean, C boolean, D boolean"
)
# Words a task numbers before it hands them back by shard.
NUMBERED_ROWS = 300_000

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


def local_shards(docs: DataFrame) -> DataFrame:
    """Shards whose ``places`` point into their own list of ``words``."""
    rows = docs.select(
        F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.coalesce("text", F.lit("")).alias("text")
    )
    return rows.mapInArrow(_encode, LOCAL_SCHEMA)


def _lists(shard: pa.Array, **lists: pa.Array) -> pa.RecordBatch:
    """One row; every list is the whole of an array."""
    columns = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in lists.values()]
    return pa.RecordBatch.from_arrays([shard, *columns], names=["shard", *lists])


def _shard(number: int, rows: list[tuple]) -> pa.RecordBatch:
    """Encode some texts with a dictionary of their own."""
    ids, langs, texts = zip(*rows, strict=True)
    # A line end behind each text keeps words apart and every text non-empty.
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    start = np.cumsum([0, *(len(t) + 1 for t in texts)])
    ink = ~_BLANK[data]
    begin = np.flatnonzero(ink & ~np.concatenate([[False], ink[:-1]]))
    end = np.flatnonzero(ink & ~np.concatenate([ink[1:], [False]])) + 1
    bounds = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int32)
    tokens = pa.BinaryArray.from_buffers(
        pa.binary(), len(begin), [None, pa.py_buffer(bounds), pa.py_buffer(data[ink])]
    )
    coded = tokens.dictionary_encode()
    width = max(1, len(coded.dictionary))
    owner = np.repeat(np.arange(len(texts)), np.diff(np.searchsorted(begin, start)))
    cells = owner * width + coded.indices.to_numpy()
    cells.sort()
    new = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]])[: len(cells)])
    counts = np.diff(np.concatenate([new, [len(cells)]]))
    cells = cells[new]
    indptr = np.searchsorted(cells, np.arange(len(texts) + 1) * width)

    def sums(which: np.ndarray) -> np.ndarray:
        return np.add.reduceat(which, start[:-1], dtype=np.int64)

    capitals = sums((data >= 65) & (data <= 90))
    points = sums((data & 0xC0) != 0x80) - 1
    return _lists(
        pa.array([number], pa.int64()),
        doc_ids=pa.array(ids, pa.int64()),
        langs=pa.array(langs, pa.string()),
        digests=pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
        capitals=pa.array(100 * capitals > MOST_CAPITAL_PERCENT * points),
        symbols=pa.array(sums(_SYMBOL[data]) > 0),
        indptr=pa.array(indptr, pa.int64()),
        words=coded.dictionary,
        places=pa.array((cells % width).astype(np.int32)),
        counts=pa.array(counts.astype(np.int32)),
    )


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # The same input partition gives the same shards under the same numbers.
    number = TaskContext.get().partitionId() << 32
    rows, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        ids, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        texts = batch.column(2)
        at = offsets(texts)
        raw = memoryview(texts.buffers()[2] or b"")
        for i, (doc_id, lang) in enumerate(zip(ids, langs, strict=True)):
            text = bytes(raw[at[i] : at[i + 1]])
            if rows and (size + len(text) > SHARD_BYTES or len(rows) >= SHARD_ROWS):
                yield _shard(number, rows)
                number, rows, size = number + 1, [], 0
            rows.append((doc_id, lang, text))
            size += len(text)
    if rows:
        yield _shard(number, rows)
        # The worker lives on beside those of the next stage.
        del rows, batch, texts, raw
        pa.default_memory_pool().release_unused()


def number_words(shards: DataFrame, spell: bool = False) -> DataFrame:
    """The global dictionary: a number for every distinct word, handed back by shard.

    Words meet sorted in the tasks that number them, one row for each shard that holds
    them. A result row tells a shard that its words ``at`` have the numbers ``base`` +
    ``low``. With ``spell`` there are rows without a shard as well, that list ``words``
    beside their numbers.
    """
    return (
        shards.select("shard", F.posexplode("words").alias("at", "word"))
        .repartition("word")
        .sortWithinPartitions("word")
        .mapInArrow(_numberer(spell), NUMBERS_SCHEMA)
    )


def _numberer(spell: bool):
    none = pa.array([], pa.binary())

    def row(shard, base, at, low, words):
        return pa.RecordBatch.from_arrays(
            [
                pa.array([shard], pa.int64()),
                pa.array([base], pa.int64()),
                *(
                    pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v)
                    for v in (pa.array(at, pa.int32()), pa.array(low, pa.int32()), words)
                ),
            ],
            names=["shard", "base", "at", "low", "words"],
        )

    def numbered(held: list[pa.RecordBatch], base: int, last, count: int):
        table = pa.Table.from_batches(held).combine_chunks()
        words = table["word"].combine_chunks()
        new = np.ones(len(words), bool)
        new[1:] = pc.not_equal(words[1:], words[:-1]).to_numpy(zero_copy_only=False)
        new[0] = words[0].as_py() != last
        low = count + np.cumsum(new) - 1
        shard = table["shard"].to_numpy()
        at = table["at"].to_numpy()
        order = np.argsort(shard, kind="stable")
        cuts = np.flatnonzero(np.diff(shard[order])) + 1
        out = [row(int(shard[part[0]]), base, at[part], low[part], none) for part in np.split(order, cuts)]
        if spell:
            out.append(row(None, base, [], low[new], words.filter(pa.array(new))))
        return out, words[-1].as_py(), int(low[-1]) + 1

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 40
        base, last, count, held, rows = task, None, 0, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows >= NUMBERED_ROWS:
                out, last, count = numbered(held, base, last, count)
                yield from out
                held, rows = [], 0
                if count > 1 << 30:
                    # The last word may go on, so its number stays the first of the next block.
                    base, count = base + count - 1, 1
        if rows:
            yield from numbered(held, base, last, count)[0]

    return number


def csr_shards(shards: DataFrame, numbers: DataFrame) -> DataFrame:
    """The document-term matrix: local shards with the numbers of one dictionary.

    What meets in a task is one shard and the numbers of its words.
    """
    return _with_numbers(shards, numbers).applyInArrow(_renumber, CSR_SCHEMA)


def _with_numbers(shards: DataFrame, numbers: DataFrame):
    own = shards.drop("words").groupBy("shard")
    return own.cogroup(numbers.where("shard IS NOT NULL").drop("words").groupBy("shard"))


def _values(batch, name: str, row: int) -> pa.Array:
    return batch.column(name).slice(row, 1).combine_chunks().flatten()


def _renumber(shard: pa.Table, numbers: pa.Table) -> pa.Table:
    # A shard of empty texts has no words to look up.
    term = np.zeros(0, np.int64)
    if numbers.num_rows:
        lengths = pc.list_value_length(numbers["at"]).to_numpy()
        term = np.empty(int(lengths.sum()), np.int64)
        low = numbers["low"].combine_chunks().flatten().to_numpy()
        at = numbers["at"].combine_chunks().flatten().to_numpy()
        term[at] = np.repeat(numbers["base"].to_numpy(), lengths) + low
    kept = ["doc_ids", "langs", "digests", "capitals", "symbols", "indptr"]
    places = _values(shard, "places", 0).to_numpy()
    out = _lists(
        shard["shard"].combine_chunks(),
        **{name: _values(shard, name, 0) for name in kept},
        terms=pa.array(term[places], pa.int64()),
        counts=_values(shard, "counts", 0),
    )
    return pa.Table.from_batches([out])


def row_flags(csr: DataFrame) -> DataFrame:
    """Per document the sums of its matrix row and the filters that look at one text."""
    return csr.mapInArrow(_row_flags, FLAGS_SCHEMA)


def row_flags_of_shards(shards: DataFrame, numbers: DataFrame) -> DataFrame:
    """``row_flags`` of ``csr_shards``, each piece of the matrix read by the task that made it.

    Two operators in a row have a Python worker each, so that a task holds a piece of the matrix
    in both and in the executor between them.
    """
    return _with_numbers(shards, numbers).applyInArrow(_renumber_and_flag, FLAGS_SCHEMA)


def _renumber_and_flag(shard: pa.Table, numbers: pa.Table) -> pa.Table:
    flags = pa.Table.from_batches(_row_flags(iter(_renumber(shard, numbers).to_batches())))
    pa.default_memory_pool().release_unused()
    return flags


def _row_flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in map(lambda b: pa.Table.from_batches([b]), batches):
        for row in range(batch.num_rows):
            indptr = _values(batch, "indptr", row).to_numpy()
            counts = _values(batch, "counts", row).to_numpy()
            terms = _values(batch, "terms", row).to_numpy()
            sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
            n_words = sums[indptr[1:]] - sums[indptr[:-1]]
            # Entries of different terms within a row; terms of a row are distinct as stored.
            n_distinct = np.diff(np.concatenate([[0], np.cumsum(terms >= 0)])[indptr])
            yield pa.RecordBatch.from_arrays(
                [
                    _values(batch, "doc_ids", row),
                    _values(batch, "langs", row),
                    _values(batch, "digests", row),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_distinct, pa.int64()),
                    pa.array(n_words < LEAST_WORDS),
                    pa.array(100 * n_distinct < LEAST_DISTINCT_PERCENT * n_words),
                    _values(batch, "capitals", row),
                    _values(batch, "symbols", row),
                ],
                names=["doc_id", "lang", "digest", "n_words", "n_distinct", *"ABCD"],
            )


def failure_patterns(flags: DataFrame, labels: DataFrame) -> DataFrame:
    """Documents per part, set of failed filters (``fails``, as letters) and labels."""
    marks = (
        labels.where("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(
            F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
            F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
        )
    )
    own = F.concat(*[F.when(F.col(c), c).otherwise("") for c in FILTERS[:-1]])
    kind = ["part", "fails", "good", "toxic"]
    per_id = (
        flags.join(marks, "doc_id", "left")
        .select(
            "doc_id",
            "digest",
            F.coalesce("lang", F.lit("")).alias("part"),
            own.alias("fails"),
            F.coalesce("good", F.lit(False)).alias("good"),
            F.coalesce("toxic", F.lit(False)).alias("toxic"),
        )
        .groupBy("doc_id", "digest", *kind)
        .agg(F.count("*").alias("n"))
    )
    # A text with a third of all documents is a few rows from here on: the smallest id of
    # each kind goes along with its number of rows.
    named = F.col("doc_id").isNotNull()
    copies = per_id.groupBy("digest", *kind).agg(
        F.sum("n").alias("n"),
        F.sum(F.when(~named, F.col("n")).otherwise(0)).alias("unnamed"),
        F.min(F.when(named, F.struct("doc_id", "n"))).alias("first"),
    )
    smallest = F.min("first.doc_id").over(Window.partitionBy("digest"))
    new = F.col("unnamed") + F.when(F.col("first.doc_id") == smallest, F.col("first.n")).otherwise(0)
    both = F.array(
        F.struct(F.col("fails").alias("fails"), F.col("new").alias("n")),
        F.struct(F.concat("fails", F.lit(FILTERS[-1])).alias("fails"), (F.col("n") - F.col("new")).alias("n")),
    )
    return (
        copies.withColumn("new", F.coalesce(new, F.col("unnamed")))
        .select("part", "good", "toxic", F.inline(both))
        .where("n > 0")
        .groupBy(*kind)
        .agg(F.sum("n").alias("n"))
    )


def all_orders(patterns: DataFrame) -> DataFrame:
    """What every filter keeps and removes at its step of every order, per part."""
    orders = " ".join("".join(order) for order in itertools.permutations(FILTERS))
    steps = patterns.select(
        "*", F.explode(F.split(F.lit(orders), " ")).alias("filter_order")
    ).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    stop = F.least(
        F.lit(len(FILTERS) + 1),
        *[
            F.when(F.contains("fails", F.lit(c)), F.instr("filter_order", c)).otherwise(len(FILTERS) + 1)
            for c in FILTERS
        ],
    )
    # Among the orders, each failed filter comes first equally often.
    share = math.factorial(len(FILTERS)) / F.greatest(F.length("fails"), F.lit(1))
    letter = F.substring("filter_order", F.col("step"), F.lit(1))
    rows = steps.withColumns({"stop": stop, "hit": F.contains("fails", letter), "letter": letter})
    removed = F.col("stop") == F.col("step")

    def count(condition: Column, alias: str) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0)).alias(alias)

    return rows.groupBy("part", "filter_order", "step").agg(
        count(F.col("stop") > F.col("step"), "kept"),
        count(removed, "removed"),
        count(F.col("hit") & (F.col("stop") < F.col("step")), "redundant"),
        count(F.col("fails") == F.col("letter"), "unique_fails"),
        count(removed & F.col("good"), "good_lost"),
        count(removed & F.col("toxic"), "toxic_lost"),
        F.sum(F.when(F.col("hit"), F.col("n") * share.cast("long")).otherwise(0)).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step; see the module for the filters.

    Columns: ``part``, ``filter_order``, ``step``, ``kept``, ``removed``, ``redundant``,
    ``unique_fails``, ``good_lost``, ``toxic_lost``, ``shapley``.
    """
    shards = keep(local_shards(docs), "shards", compression="zstd", **_GROUPS)
    flags = keep(row_flags_of_shards(shards, number_words(shards)), "flags")
    return all_orders(keep(failure_patterns(flags, labels), "patterns"))


_LETTERS = "(SELECT unnest(string_split('A B C D E', ' ')) AS c)"
ORACLE_SQL = f"""WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
marks AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
  FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         concat(CASE WHEN len(words) < 200 THEN 'A' ELSE '' END,
                CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 'B' ELSE '' END,
                CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text)
                     THEN 'C' ELSE '' END,
                CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END,
                CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END) AS fails
  FROM texts LEFT JOIN marks USING (doc_id)),
patterns AS (SELECT part, fails, good, toxic, count(*) AS n FROM judged GROUP BY ALL),
orders AS (
  SELECT concat(a.c, b.c, d.c, e.c, f.c) AS filter_order
  FROM {_LETTERS} a, {_LETTERS} b, {_LETTERS} d, {_LETTERS} e, {_LETTERS} f
  WHERE len(list_distinct([a.c, b.c, d.c, e.c, f.c])) = 5),
steps AS (
  SELECT part, fails, good, toxic, n, filter_order, step, substr(filter_order, step::BIGINT, 1) AS letter,
         coalesce(list_min(list_transform(nullif(string_split(fails, ''), ['']),
                  lambda x: instr(filter_order, x))), 6) AS stop
  FROM patterns, orders, (SELECT unnest(range(1, 6))::INTEGER AS step))
SELECT part, filter_order, step,
       sum(CASE WHEN stop > step THEN n ELSE 0 END)::BIGINT AS kept,
       sum(CASE WHEN stop = step THEN n ELSE 0 END)::BIGINT AS removed,
       sum(CASE WHEN contains(fails, letter) AND stop < step THEN n ELSE 0 END)::BIGINT AS redundant,
       sum(CASE WHEN fails = letter THEN n ELSE 0 END)::BIGINT AS unique_fails,
       sum(CASE WHEN stop = step AND good THEN n ELSE 0 END)::BIGINT AS good_lost,
       sum(CASE WHEN stop = step AND toxic THEN n ELSE 0 END)::BIGINT AS toxic_lost,
       sum(CASE WHEN contains(fails, letter) THEN n * (120 // length(fails)) ELSE 0 END)::BIGINT AS shapley
FROM steps GROUP BY part, filter_order, step"""
