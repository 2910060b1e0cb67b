"""MinHash near-duplicates with HyperMinHash registers.

A document's distinct five-word shingles are hashed once. The top bits of a hash
choose one of 256 buckets; a bucket keeps its smallest hash, compressed to a count
of leading zeros and ten bits of mantissa (16 bits). Empty buckets borrow from
others, probing in an order of their own, so that also a few shingles fill all
registers and two registers are still equal with the chance of the sets' Jaccard
similarity. Forty-two bands of six registers find a pair of similarity 0.75 with a
chance above 0.999.

Documents with equal sets are one class from the start, so copies cost nothing, and a
class is what is compared. Bands never give all pairs of a bucket:

1. Every class of a bucket is compared with the bucket's smallest. Buckets whose members
   now lie in one component are done.
2. Of the others, small ones give their pairs of different components.
3. Classes in larger ones go through an exact join with prefix and position filters.
   Their shingles are ordered from rare to common, and two sets that are similar enough
   share one near the front; where the first they share stands bounds what they can have
   in common. Shingles that everybody has stand last and pair nobody.

So every pair that shares a bucket ends up in one component, is compared, or is ruled
out by a bound. A comparison looks at one bit of each register first, then estimates the
similarity from the registers, corrected for accidental equality, and confirms it on the
full shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonetide.llm.common import ids_of, keep, pieces
from tonetide.llm.graph import components
from tonetide.llm.words import mix, shingle_set, words_of

SHINGLE = 5
# Similarity, in hundredths, from which documents are linked.
PERCENT = 75
BUCKET_BITS = 8
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
BAND_ROWS = 6
BANDS = BUCKETS // BAND_ROWS
# Standard errors an estimate may lie below the threshold and still be verified.
SLACK = 4.5
# Sets smaller than this are verified whatever the registers say.
SMALL_SET = 64
# Share of accidentally equal registers at equal sizes, of the HyperMinHash paper.
_COLLISION = 0.169919487159739093975315012348

# Buckets of at most so many classes give their pairs; larger ones go through the join.
SMALL_BUCKET = 16
# Ids of further texts under one document id lie above all document ids.
EXTRA_ID = 1 << 62

_PROBES = 64
_probe_order = (
    mix(np.arange(BUCKETS * _PROBES, dtype=np.uint64) + np.uint64(1)) >> np.uint64(64 - BUCKET_BITS)
).astype(np.int64).reshape(BUCKETS, _PROBES)

_SIGNATURE = "doc_id long, n_shingles long, set_a long, set_b long, registers binary"
_SETS = "set_a long, set_b long, n long, shingles array<long>"
_KEY = ["set_a", "set_b", "n_shingles"]


def registers(shingles: np.ndarray) -> np.ndarray:
    """The compressed minima of a sorted set of hashes, one for each bucket."""
    bucket = (shingles >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    full, first = np.unique(bucket, return_index=True)
    # The set is sorted, so a bucket's first hash is its smallest.
    rest = shingles[first] << np.uint64(BUCKET_BITS)
    exponent = np.frexp(np.maximum(rest, np.uint64(1)).astype(np.float64))[1]
    zeros = np.minimum(64 - exponent, 63)
    mantissa = (rest << np.minimum(zeros + 1, 63).astype(np.uint64)) >> np.uint64(64 - MANTISSA_BITS)
    value = (zeros.astype(np.uint64) << np.uint64(MANTISSA_BITS)) | mantissa
    out = np.zeros(BUCKETS, np.uint16)
    filled = np.zeros(BUCKETS, bool)
    out[full] = value
    filled[full] = True
    empty = np.flatnonzero(~filled)
    if len(empty):
        tries = filled[_probe_order[empty]]
        found = tries.any(axis=1)
        donor = _probe_order[empty, tries.argmax(axis=1)]
        # All probes of a bucket may miss in tiny sets; it then walks on from its
        # last probe to the next full bucket.
        after = np.searchsorted(full, _probe_order[empty, -1]) % len(full)
        donor = np.where(found, donor, full[after])
        out[empty] = out[donor]
    return out


def set_key(shingles: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """128 bits that tell sets apart."""
    return np.bitwise_xor.reduce(shingles), np.add.reduce(mix(shingles))


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        words = words_of(batch.column(1))
        sizes, keys, regs = [], [], []
        for i in range(batch.num_rows):
            shingles = shingle_set(words.of(i), SHINGLE)
            sizes.append(len(shingles))
            if not len(shingles):
                keys.append((0, 0))
                regs.append(None)
                continue
            keys.append(set_key(shingles))
            regs.append(registers(shingles).tobytes())
        key = np.array(keys, np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.record_batch(
            [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.array(key[:, 0]),
                pa.array(key[:, 1]),
                pa.array(regs, pa.binary()),
            ],
            ["doc_id", "n_shingles", "set_a", "set_b", "registers"],
        )


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seed = mix(np.arange(1, BANDS * BAND_ROWS + 1, dtype=np.uint64)).reshape(BANDS, BAND_ROWS)
    for batch in batches:
        if not batch.num_rows:
            continue
        regs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16)
        regs = regs.reshape(batch.num_rows, BUCKETS)[:, : BANDS * BAND_ROWS]
        cells = regs.reshape(-1, BANDS, BAND_ROWS).astype(np.uint64) + np.uint64(1)
        keys = mix((mix(cells * seed) * (seed | np.uint64(1))).sum(axis=2, dtype=np.uint64))
        yield pa.record_batch(
            [
                pa.array(keys.reshape(-1).view(np.int64)),
                pa.array(np.repeat(ids_of(batch), BANDS)),
            ],
            ["band", "id"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        words = words_of(batch.column(1))
        sets = [shingle_set(words.of(i), SHINGLE) for i in range(batch.num_rows)]
        sets = [s for s in sets if len(s)]
        if not sets:
            continue
        key = np.array([set_key(s) for s in sets], np.uint64).view(np.int64)
        sizes = [len(s) for s in sets]
        ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        shingles = pa.ListArray.from_arrays(
            pa.array(ends), pa.array(np.concatenate(sets).view(np.int64))
        )
        yield pa.record_batch(
            [pa.array(key[:, 0]), pa.array(key[:, 1]), pa.array(sizes, pa.int64()), shingles],
            ["set_a", "set_b", "n", "shingles"],
        )


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lowest bit of every register, packed."""
    for batch in batches:
        if not batch.num_rows:
            continue
        regs = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint16)
        packed = np.packbits((regs & 1).astype(np.uint8).reshape(batch.num_rows, BUCKETS), axis=1)
        bits = pa.array([row.tobytes() for row in packed], pa.binary())
        yield pa.record_batch([batch.column(0), batch.column(1), bits], ["id", "n", "b"])


def _slack(na: np.ndarray, nb: np.ndarray, chance: float) -> np.ndarray:
    """Standard errors of a share of equal registers, times ``SLACK``."""
    sample = np.minimum(np.minimum(na, nb), BUCKETS)
    return SLACK * np.sqrt(chance * (1 - chance) / np.maximum(sample, 1))


def _likely_by_bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sizes and register bits leave room for the wanted similarity."""
    # Registers that differ have equal bits half of the time.
    want = (1 + PERCENT / 100) / 2
    for batch in batches:
        if not batch.num_rows:
            continue
        ba, bb = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1)
            for c in ("ba", "bb")
        )
        na, nb = (ids_of(batch, batch.schema.get_field_index(c)) for c in ("na", "nb"))
        equal = 1 - np.unpackbits(ba ^ bb, axis=1).mean(axis=1)
        small = np.minimum(na, nb) < SMALL_SET
        possible = np.minimum(na, nb) * 100 >= PERCENT * np.maximum(na, nb)
        ok = possible & (small | (equal >= want - _slack(na, nb, want)))
        yield batch.select(["a", "b"]).filter(pa.array(ok))


def _estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose registers leave room for the wanted similarity."""
    want = PERCENT / 100
    for batch in batches:
        if not batch.num_rows:
            continue
        ra, rb = (
            np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS)
            for c in ("ra", "rb")
        )
        na, nb = (ids_of(batch, batch.schema.get_field_index(c)) for c in ("na", "nb"))
        ratio = np.maximum(na, nb) / np.maximum(np.minimum(na, nb), 1)
        chance = _COLLISION * 2.0**-MANTISSA_BITS * 4 * ratio / (1 + ratio) ** 2
        equal = (ra == rb).mean(axis=1)
        jaccard = (equal - chance) / (1 - chance)
        slack = _slack(na, nb, want)
        small = np.minimum(na, nb) < SMALL_SET
        possible = np.minimum(na, nb) * 100 >= PERCENT * np.maximum(na, nb)
        ok = pa.array(possible & (small | (jaccard >= want - slack)))
        yield batch.select(["a", "b"]).filter(ok)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` for every row.

    Links join documents whose shingle sets have ``100 * intersection >= 75 *
    union``; a component's id is its smallest ``doc_id``, and only that document
    is kept. A null, empty or blank text has no shingles and no links. Rows that
    repeat an id are one document: it has the links of each of its texts, and all of
    them are in its component. Ids are below 2**62. A null id links with nothing: its
    component is null and it is kept. An empty table gives an empty result; other columns
    are ignored.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    sig = keep(docs.mapInArrow(_signatures, _SIGNATURE), "signatures")
    with_set = sig.where("n_shingles > 0 AND doc_id IS NOT NULL")

    # A class has the id of its first document; further classes of one document get their own.
    classes = with_set.groupBy(*_KEY).agg(F.min("doc_id").alias("rep"))
    first = classes.groupBy("rep").agg(F.min("set_a").alias("_first"))
    extra = F.xxhash64(*_KEY).bitwiseAND(F.lit(EXTRA_ID - 1)).bitwiseOR(F.lit(EXTRA_ID))
    classes = keep(
        classes.join(first, "rep").select(
            *_KEY, "rep", F.when(F.col("set_a") == F.col("_first"), F.col("rep")).otherwise(extra).alias("id")
        ),
        "classes",
    )
    members = keep(
        with_set.select("doc_id", *_KEY).distinct().join(classes, _KEY).select("doc_id", "id"), "members"
    )
    several = members.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("_last"))
    one_document = (
        members.join(several.where("a < _last"), "doc_id").where("id <> a").select("a", F.col("id").alias("b"))
    )
    rep_sig = keep(
        with_set.join(
            classes.select(*_KEY, F.col("rep").alias("doc_id"), "id"), [*_KEY, "doc_id"]
        )
        .dropDuplicates(["id"])
        .select("id", F.col("n_shingles").alias("n"), F.col("registers").alias("r")),
        "registers",
    )

    bands = rep_sig.select("id", "r").mapInArrow(_bands, "band long, id long")
    shared = (
        bands.groupBy("band")
        .agg(F.min("id").alias("center"), F.max("id").alias("_last"), F.count("*").alias("members"))
        .where("center < _last")
        .drop("_last")
    )
    buckets = keep(bands.join(shared, "band"), "buckets")
    labels = _linked(docs, classes, rep_sig, buckets, one_document)

    of_class = members.join(labels, "id", "left").select(
        "doc_id", F.coalesce("component", "id").alias("_component")
    )
    of_doc = of_class.groupBy("doc_id").agg(F.min("_component").alias("_component"))
    component = F.coalesce("_component", "doc_id")
    return (
        sig.select("doc_id", "n_shingles")
        .join(of_doc, "doc_id", "left")
        .select(
            "doc_id",
            "n_shingles",
            component.alias("component_id"),
            F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
        )
    )


def _linked(
    docs: DataFrame, classes: DataFrame, rep_sig: DataFrame, buckets: DataFrame, one_document: DataFrame
) -> DataFrame:
    """Components over the verified links of the buckets."""
    bits = keep(rep_sig.select("id", "n", "r").mapInArrow(_bits, "id long, n long, b binary"), "bits")
    pairs = (
        buckets.where("id <> center").select(F.col("center").alias("a"), F.col("id").alias("b")).distinct()
    )
    links = keep(_verified(pairs, docs, classes, rep_sig, bits).union(one_document), "verified")
    labels = components(links, "a", "b")

    placed = buckets.join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = (
        placed.groupBy("band")
        .agg((F.min("component") < F.max("component")).alias("mixed"))
        .where("mixed")
        .select("band")
    )
    open_ = keep(placed.join(mixed, "band"), "open")
    small = open_.where(F.col("members") <= SMALL_BUCKET).select("band", "id", "component")
    other = small.select("band", F.col("id").alias("b"), F.col("component").alias("_other"))
    near = (
        small.withColumnRenamed("id", "a")
        .join(other, "band")
        .where("a < b AND component <> _other")
        .select("a", "b")
    )
    crowded = keep(
        open_.where(F.col("members") > SMALL_BUCKET).select("id", "component").distinct(), "crowded"
    )
    if not crowded.isEmpty():
        near = near.union(_similar_sets(docs, classes, crowded))
    # Pairs with the smallest of a bucket have been compared.
    fresh = keep(near.distinct().join(pairs, ["a", "b"], "left_anti"), "pairs")
    found = keep(_verified(fresh, docs, classes, rep_sig, bits), "verified")
    return labels if found.isEmpty() else components(links.union(found), "a", "b")


def _shingles(docs: DataFrame, classes: DataFrame, ids: DataFrame) -> DataFrame:
    """``id``, ``n`` and the full set of the classes listed."""
    wanted = classes.join(ids, "id", "left_semi")
    texts = docs.join(wanted.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    keys = wanted.select("set_a", "set_b", F.col("n_shingles").alias("n"), "id")
    return (
        texts.mapInArrow(_sets, _SETS)
        .join(keys, ["set_a", "set_b", "n"])
        .dropDuplicates(["id"])
        .select("id", "n", "shingles")
    )


def _similar_sets(docs: DataFrame, classes: DataFrame, crowded: DataFrame) -> DataFrame:
    """Pairs of different components that prefix and position leave possible."""
    sets = keep(_shingles(docs, classes, crowded.select("id")), "sets")
    tokens = sets.select("id", "n", F.explode("shingles").alias("shingle"))
    common = tokens.groupBy("shingle").agg(F.count("*").alias("holders"))
    # A shingle of one set pairs nobody, but takes its place at the front.
    order = F.array_sort(F.collect_list(F.struct("holders", "shingle")))
    # Bounded by the shingles of one text.
    ranked = tokens.join(common, "shingle").groupBy("id", "n").agg(order.alias("ranked"))
    # A set shares one of its first shingles with any that has enough of it.
    front = F.col("n") - F.ceil(F.col("n") * F.lit(PERCENT) / 100) + 1
    prefix = keep(
        ranked.join(crowded, "id")
        .select("id", "n", "component", F.posexplode(F.slice("ranked", 1, front.cast("int"))).alias("pos", "s"))
        .where("s.holders > 1")
        .select(F.col("s.shingle").alias("shingle"), "id", "n", "component", "pos"),
        "prefix",
    )
    other = prefix.select(
        "shingle",
        F.col("id").alias("b"),
        F.col("n").alias("nb"),
        F.col("component").alias("_other"),
        F.col("pos").alias("pb"),
    )
    # With 100 * common >= 75 * union, common is at least 75 / 175 of both sizes together.
    left = F.least(F.col("n") - F.col("pos"), F.col("nb") - F.col("pb"))
    return (
        prefix.withColumnRenamed("id", "a")
        .join(other, "shingle")
        .where("a < b AND component <> _other")
        .where(
            (F.least("n", "nb") * 100 >= F.greatest("n", "nb") * PERCENT)
            & (left * (100 + PERCENT) >= (F.col("n") + F.col("nb")) * PERCENT)
        )
        .select("a", "b")
        .distinct()
    )


def _with_ends(pairs: DataFrame, table: DataFrame, **names: str) -> DataFrame:
    """Pairs with columns of ``table`` for both ends."""
    for end in ("a", "b"):
        side = table.select(
            F.col("id").alias(end), *[F.col(c).alias(f"{new}{end}") for c, new in names.items()]
        )
        pairs = pairs.join(side, end)
    return pairs


def _verified(
    pairs: DataFrame, docs: DataFrame, classes: DataFrame, rep_sig: DataFrame, bits: DataFrame
) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    hopeful = _with_ends(pairs, bits, n="n", b="b").mapInArrow(_likely_by_bits, "a long, b long")
    likely = keep(
        _with_ends(hopeful, rep_sig, n="n", r="r").mapInArrow(_estimate, "a long, b long"), "likely"
    )
    ids = likely.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = keep(_shingles(docs, classes, ids), "sets")
    common = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - F.col("common")
    return (
        _with_ends(likely, sets, shingles="s")
        .withColumn("common", common)
        .where(F.col("common") * 100 >= union * PERCENT)
        .select("a", "b")
    )
