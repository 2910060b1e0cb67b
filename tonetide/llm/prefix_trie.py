"""The prefix trie of conversations, rolled up by centroid decomposition.

A node is a distinct sequence of leading turns (role, text); its members are the
conversations that start with it. Turns become two 64-bit hashes and a byte count
before anything is shuffled. A sequence is keyed by the exclusive-or of hashes of
its turns, each mixed with its place, so that a key is a running aggregate and the
key of the parent is the key without the last term. Two different sequences have
equal keys with a chance of about 2**-128.

Sums over subtrees (leaves, saved bytes) come from a centroid decomposition of the
forest of parent edges. The root goes first: its sums are those of the table, and the
trees below it are the first components. The centroid of a component is its deepest
node that still holds half of the component's weight, where a node weighs as many
conversations as pass through it; that weight of a subtree is known from the grouping
that makes the nodes, and is kept up as parts are cut off. Taking out a centroid
leaves the part above it and one part per child. The totals of the parts below are
added to the centroid and to every node on the path from it to the top of the
component, and each part is split in turn. Weight halves each time, so a node takes
part in no more than log2(rows) splits. Components of more than ``LOCAL_NODES`` nodes
are split by joins; smaller ones, many at a time, by the same steps on arrays inside
a task. Where that line lies has no effect on results.

Rows and edge cases: a null role or text counts as empty; a null turn comes first;
equal turns of one conversation are ordered by a hash of role and text, so repeated
rows stay separate turns; rows without a conversation id belong to no conversation and
are left out; an empty table has no nodes, not even a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonetide.llm.common import keep

# Components of at most so many nodes are finished inside one task (a few MB of arrays).
LOCAL_NODES = 20_000
# Nodes a task decomposes at once; whole components only.
BATCH_NODES = 50_000
# Turns of one conversation that are summed up in one window.
BLOCK_TURNS = 4_096
# Copies of the one row a large component has in a join with its many nodes.
SALTS = 64
# Ids joined to one piece of text before they are hashed.
PIECE_IDS = 4_096

KEY = ["depth", "k1", "k2"]
_EMPTY = hashlib.sha256(b"").hexdigest()


def turn_rows(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``pos`` (1, 2, ...), two hashes and the UTF-8 bytes of every turn.

    Turns are numbered within ranges of the sorted table, and a range goes on from
    the earlier ranges of its conversation: one that holds a third of all turns is
    numbered by many tasks.
    """
    spark = conversations.sparkSession
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    turns = keep(
        conversations.where("conv_id IS NOT NULL").select(
            F.col("conv_id").cast("long"),
            F.col("turn").cast("long"),
            F.xxhash64(F.lit(1), role, text).alias("t1"),
            F.xxhash64(F.lit(2), role, text).alias("t2"),
            F.octet_length(text).cast("long").alias("bytes"),
        ),
        "turns",
    )
    order = [F.asc_nulls_first("turn"), "t1", "t2"]
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = keep(
        turns.repartitionByRange(width, "conv_id", *order).withColumn("part", F.spark_partition_id()),
        "turns",
    )
    here = Window.partitionBy("part", "conv_id").orderBy(*order)
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranges.groupBy("part", "conv_id")
        .agg(F.count("*").alias("n"))
        .select("part", "conv_id", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    )
    numbered = ranges.select("*", F.row_number().over(here).cast("long").alias("at"))
    return numbered.join(starts, ["part", "conv_id"]).select(
        "conv_id", (F.col("start") + F.col("at")).alias("pos"), "t1", "t2", "bytes"
    )


def shared_openings(rows: DataFrame, convs: DataFrame, every: int, most: int) -> DataFrame:
    """Conversations rebuilt so that neighbours share an opening.

    Conversation c takes the first h turns of conversation c - c % ``every`` in place
    of its own first h, with h = crc32(c in decimal) % ``most``.
    """
    ids = convs.select(
        "conv_id",
        (F.col("conv_id") - F.col("conv_id") % every).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("long").alias("h"),
    )
    heads = rows.where((F.col("conv_id") % every == 0) & (F.col("pos") < most))
    sizes = heads.groupBy(F.col("conv_id").alias("base")).agg(F.count("*").alias("there"))
    ids = ids.join(sizes, "base", "left").withColumn(
        "taken", F.least("h", F.coalesce("there", F.lit(0)))
    )
    shared = ids.join(heads.withColumnRenamed("conv_id", "base"), "base").where("pos <= h")
    own = rows.join(ids, "conv_id").where("pos > h")
    return shared.select("conv_id", "pos", "t1", "t2", "bytes").union(
        own.select("conv_id", F.expr("pos - h + taken AS pos"), "t1", "t2", "bytes")
    )


def _xor_over(column: str, window) -> Column:
    return F.coalesce(F.bit_xor(column).over(window), F.lit(0).cast("long"))


def prefixes(rows: DataFrame) -> DataFrame:
    """One row per conversation and depth from 1: the node's key, its parent's, its tree's."""
    terms = rows.select(
        "conv_id",
        F.col("pos").alias("depth"),
        F.xxhash64("pos", "t1").alias("x1"),
        F.xxhash64("pos", "t2").alias("x2"),
        "bytes",
        F.floor((F.col("pos") - 1) / BLOCK_TURNS).alias("block"),
    )
    opening = F.col("depth") == 1
    blocks = terms.groupBy("conv_id", "block").agg(
        F.bit_xor("x1").alias("b1"),
        F.bit_xor("x2").alias("b2"),
        F.count("*").alias("n"),
        F.max(F.when(opening, F.col("x1"))).alias("f1"),
        F.max(F.when(opening, F.col("x2"))).alias("f2"),
    )
    whole = Window.partitionBy("conv_id")
    before = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select(
        "conv_id",
        "block",
        _xor_over("b1", before).alias("b1"),
        _xor_over("b2", before).alias("b2"),
        F.sum("n").over(whole).alias("length"),
        F.max("f1").over(whole).alias("c1"),
        F.max("f2").over(whole).alias("c2"),
    )
    here = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = terms.select("*", *[_xor_over(f"x{i}", here).alias(f"s{i}") for i in (1, 2)])
    key = [F.col(f"b{i}").bitwiseXOR(F.col(f"s{i}")) for i in (1, 2)]
    return running.join(carried, ["conv_id", "block"]).select(
        "conv_id",
        "depth",
        key[0].alias("k1"),
        key[1].alias("k2"),
        key[0].bitwiseXOR(F.col("x1")).alias("p1"),
        key[1].bitwiseXOR(F.col("x2")).alias("p2"),
        "bytes",
        "length",
        "c1",
        "c2",
    )


def _nodes(paths: DataFrame, root_conv: int) -> DataFrame:
    """The nodes below the root with all that needs no subtree."""
    grouped = keep(
        paths.groupBy(*KEY).agg(
            F.count("*").alias("n_convs"),
            F.min("conv_id").alias("conv_id"),
            F.max("bytes").alias("bytes"),
            F.sum(F.expr("length - depth + 1")).alias("weight"),
            *[F.min(c).alias(c) for c in ("p1", "p2", "c1", "c2")],
        ),
        "nodes",
    )
    children = grouped.groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")
    ).agg(F.count("*").alias("n_children"))
    with_children = grouped.join(children, KEY, "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0).cast("long"))
    )
    # A node with very many children is one row here and skewed on the other side, which
    # adaptive execution splits. Children of the root look for nobody, each by its own key.
    parents = grouped.select(
        (F.col("depth") + 1).alias("_depth"),
        F.col("k1").alias("_k1"),
        F.col("k2").alias("_k2"),
        F.col("conv_id").alias("_conv"),
    )
    own = [F.when(F.col("depth") == 1, F.col(f"k{i}")).otherwise(F.col(f"p{i}")) for i in (1, 2)]
    above = with_children.join(
        parents,
        (F.col("depth") == F.col("_depth")) & (own[0] == F.col("_k1")) & (own[1] == F.col("_k2")),
        "left",
    )
    return above.select(
        *KEY,
        "p1",
        "p2",
        "c1",
        "c2",
        "conv_id",
        F.when(F.col("depth") == 1, F.lit(root_conv)).otherwise(F.col("_conv")).alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "weight",
        (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"),
        # What has been added from outside the present component.
        F.lit(0).cast("long").alias("n_leaves"),
        F.lit(0).cast("long").alias("saved_tokens"),
    )


def _salted(rows: DataFrame, components: DataFrame) -> DataFrame:
    """Each node with the row of its component, where that is one of the given ones.

    Such a component has many nodes, so copies of its row cost little and its nodes meet
    them in many tasks.
    """
    copies = components.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod("k1", F.lit(SALTS)).cast("int")).join(
        copies, ["c1", "c2", "_salt"]
    ).drop("_salt")


def _large(live: DataFrame, local_nodes: int) -> DataFrame:
    return (
        live.groupBy("c1", "c2")
        .agg(F.count("*").alias("_n"), F.max("weight").alias("_total"), F.min("depth").alias("_top"))
        .where(F.col("_n") > local_nodes)
        .drop("_n")
    )


def _split(live: DataFrame, large: DataFrame, paths: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Take the centroid out of every large component: (rows that are done, rows left)."""
    placed = _salted(live, large)
    lightest = F.min(F.struct("weight", -F.col("depth"), "k1", "k2", "depth", "conv_id"))
    centroids = keep(
        placed.where("2 * weight >= _total")
        .groupBy("c1", "c2", "_top")
        .agg(lightest.alias("z"))
        .select(
            "c1",
            "c2",
            "_top",
            F.col("z.depth").alias("_zdepth"),
            F.col("z.k1").alias("_z1"),
            F.col("z.k2").alias("_z2"),
            F.col("z.conv_id").alias("_zconv"),
            F.col("z.weight").alias("_zweight"),
        ),
        "centroids",
    )
    # A node lies below the centroid if its conversation passes through it; the step
    # after the centroid names the part the node falls into.
    steps = paths.select(
        F.col("conv_id").alias("_conv"),
        F.col("depth").alias("_depth"),
        F.col("k1").alias("_step1"),
        F.col("k2").alias("_step2"),
        F.col("p1").alias("_from1"),
        F.col("p2").alias("_from2"),
    )
    with_z = _salted(live, centroids)
    stepped = with_z.join(
        steps,
        (F.col("conv_id") == F.col("_conv")) & (F.col("_depth") == F.col("_zdepth") + 1)
        & (F.col("depth") > F.col("_zdepth")),
        "left",
    )
    below = F.coalesce((F.col("_from1") == F.col("_z1")) & (F.col("_from2") == F.col("_z2")), F.lit(False))
    centre = (F.col("depth") == F.col("_zdepth")) & (F.col("k1") == F.col("_z1")) & (F.col("k2") == F.col("_z2"))
    parts = keep(
        stepped.withColumns({"_below": below, "_centre": centre}).drop("_conv", "_depth", "_from1", "_from2"),
        "parts",
    )
    # Totals per part, then of all parts under one centroid and itself.
    hanging = (
        parts.where("_below OR _centre")
        .groupBy("c1", "c2", "_step1", "_step2")
        .agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
        .groupBy("c1", "c2")
        .agg(F.sum("leaf").alias("_leaves"), F.sum("saved").alias("_saved"))
    )
    totals = keep(centroids.join(hanging, ["c1", "c2"]), "totals")
    up = totals.where("_zdepth > _top").select(
        F.col("_zconv").alias("conv_id"),
        F.explode(F.expr("sequence(_top, _zdepth - 1)")).alias("depth"),
        "_leaves",
        "_saved",
        "_zweight",
    )
    additions = up.join(paths.select("conv_id", *KEY), ["conv_id", "depth"]).select(
        *KEY, F.col("_leaves").alias("_l"), F.col("_saved").alias("_s"), F.col("_zweight").alias("_w")
    )
    columns = live.columns
    done = _salted(
        parts.where("_centre").select(columns), totals.select("c1", "c2", "_leaves", "_saved")
    ).select(
        *[c for c in columns if c not in ("n_leaves", "saved_tokens")],
        (F.col("n_leaves") + F.col("_leaves")).alias("n_leaves"),
        (F.col("saved_tokens") + F.col("_saved")).alias("saved_tokens"),
    )
    rest = parts.where("NOT _centre").join(additions, KEY, "left")
    zero = F.lit(0).cast("long")
    changed = {
        "c1": F.when(F.col("_below"), F.col("_step1")).otherwise(F.col("c1")),
        "c2": F.when(F.col("_below"), F.col("_step2")).otherwise(F.col("c2")),
        "weight": F.col("weight") - F.coalesce("_w", zero),
        "n_leaves": F.col("n_leaves") + F.coalesce("_l", zero),
        "saved_tokens": F.col("saved_tokens") + F.coalesce("_s", zero),
    }
    left = rest.select(*[changed.get(c, F.col(c)).alias(c) for c in columns])
    return keep(done, "done"), keep(left, "live")


def roll_up(nodes: DataFrame, paths: DataFrame, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """``nodes`` with ``n_leaves`` and ``saved_tokens`` summed over every subtree."""
    finished = []
    ready = []
    live = nodes
    first = True
    while True:
        large = keep(_large(live, local_nodes), "large")
        if large.isEmpty():
            ready.append(live)
            break
        # What is small enough waits; the rest is split again.
        marks = large.select("c1", "c2")
        small = live.join(marks, ["c1", "c2"], "left_anti")
        ready.append(small if first else keep(small, "small"))
        if first:
            # Paths of the large trees alone, a conversation being in one tree.
            paths = keep(_salted(paths, marks), "paths")
        done, live = _split(live, large, paths)
        finished.append(done)
        first = False
    waiting = ready[0]
    for part in ready[1:]:
        waiting = waiting.unionByName(part)
    schema = nodes.schema
    result = (
        waiting.select(nodes.columns)
        .repartition("c1", "c2")
        .sortWithinPartitions("c1", "c2", "depth")
        .mapInArrow(_decompose_batches, schema)
    )
    for part in finished:
        result = result.unionByName(part)
    return result


def _decompose_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole components, about ``BATCH_NODES`` nodes at a time."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        rows += batch.num_rows
        if rows < BATCH_NODES:
            continue
        table = pa.Table.from_batches(held)
        tops = np.column_stack([table[c].to_numpy() for c in ("c1", "c2")])
        # The last component may go on in the next batch.
        cut = np.flatnonzero((tops[1:] != tops[:-1]).any(axis=1))
        if len(cut):
            yield from _decomposed(table.slice(0, int(cut[-1]) + 1))
            table = table.slice(int(cut[-1]) + 1)
        held, rows = table.to_batches(), table.num_rows
    if rows:
        yield from _decomposed(pa.Table.from_batches(held))


def _decomposed(table: pa.Table) -> Iterator[pa.RecordBatch]:
    table = table.combine_chunks()
    column = {name: table[name].to_numpy() for name in table.column_names}
    parent = _parent_places(column)
    sums = decompose(
        parent, column["depth"], column["weight"], np.column_stack([column["leaf"], column["saved"]])
    )
    for i, name in enumerate(("n_leaves", "saved_tokens")):
        at = table.schema.get_field_index(name)
        table = table.set_column(at, table.schema.field(at), pa.array(column[name] + sums[:, i]))
    yield from table.to_batches()


def _parent_places(column: dict[str, np.ndarray]) -> np.ndarray:
    """Row of each node's parent within the same component, -1 for a component's top."""
    names = np.dtype([("c1", "<i8"), ("c2", "<i8"), ("d", "<i8"), ("k1", "<i8"), ("k2", "<i8")])

    def keys(depth, k1, k2):
        out = np.empty(len(depth), names)
        out["c1"], out["c2"], out["d"] = column["c1"], column["c2"], depth
        out["k1"], out["k2"] = k1, k2
        return out

    both = np.concatenate(
        [
            keys(column["depth"], column["k1"], column["k2"]),
            keys(column["depth"] - 1, column["p1"], column["p2"]),
        ]
    )
    n = len(column["depth"])
    _, code = np.unique(both, return_inverse=True)
    place = np.full(code.max() + 1, -1, np.int64)
    place[code[:n]] = np.arange(n)
    return place[code[n:]]


def decompose(
    parent: np.ndarray, depth: np.ndarray, weight: np.ndarray, values: np.ndarray
) -> np.ndarray:
    """Sums of ``values`` over every subtree of a forest, by centroid decomposition.

    ``weight`` is additive over subtrees and at least 1 per node. All components of a
    level are split at once.
    """
    n = len(parent)
    parent = parent.copy()
    weight = weight.astype(np.int64, copy=True)
    sums = np.zeros(values.shape, np.int64)
    by_depth = np.argsort(depth, kind="stable")
    levels = np.split(by_depth, np.flatnonzero(np.diff(depth[by_depth])) + 1) if n else []
    alive = np.ones(n, bool)
    while alive.any():
        # The top of each node's component.
        top = np.arange(n)
        for level in levels:
            inner = level[(parent[level] >= 0) & alive[level]]
            top[inner] = top[parent[inner]]
        # The lightest node that holds half of its component is the centroid.
        able = np.flatnonzero(alive & (2 * weight >= weight[top]))
        order = able[np.lexsort((able, -depth[able], weight[able], top[able]))]
        first = np.ones(len(order), bool)
        first[1:] = top[order][1:] != top[order][:-1]
        centre = order[first]
        alive[centre] = False
        # Cut the edges to the children: the parts below get tops of their own.
        is_centre = np.zeros(n, bool)
        is_centre[centre] = True
        hung = np.flatnonzero(alive & (parent >= 0))
        hung = hung[is_centre[parent[hung]]]
        below = np.full(n, -1, np.int64)
        below[hung] = parent[hung]
        parent[hung] = -1
        part = np.arange(n)
        for level in levels:
            inner = level[(parent[level] >= 0) & alive[level]]
            inner = inner[~is_centre[parent[inner]]]
            part[inner] = part[parent[inner]]
        # Totals of the parts, gathered at their centroid.
        totals = np.zeros(values.shape, np.int64)
        lower = np.flatnonzero(alive & (below[part] >= 0))
        np.add.at(totals, part[lower], values[lower])
        gathered = values.astype(np.int64, copy=True)
        np.add.at(gathered, below[hung], totals[hung])
        sums[centre] += gathered[centre]
        # From the centroid to the top of its component.
        carry, at = centre, parent[centre]
        while True:
            on = at >= 0
            if not on.any():
                break
            carry, at = carry[on], at[on]
            sums[at] += gathered[carry]
            weight[at] -= weight[carry]
            at = parent[at]
        parent[centre] = -1
    return sums


def ends_digest(ends: DataFrame) -> DataFrame:
    """SHA-256 of the ascending conversation ids that end at a node, joined by commas.

    A digest of one string is sequential by nature. Ids are first sorted by ranges and
    joined to pieces in many tasks; what meets in one task are a node's pieces, read as
    a stream.
    """
    width = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pieces = (
        ends.repartitionByRange(width, *KEY, "conv_id")
        .sortWithinPartitions(*KEY, "conv_id")
        .mapInArrow(_join_ids, "depth long, k1 long, k2 long, begin long, ids string")
    )
    return (
        pieces.repartition(*KEY)
        .sortWithinPartitions(*KEY, "begin")
        .mapInArrow(_hash_ids, "depth long, k1 long, k2 long, ends_sha256 string")
    )


def _join_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.column_stack([batch.column(c).to_numpy() for c in KEY])
        ids = batch.column("conv_id").to_numpy()
        new = np.ones(len(ids), bool)
        new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
        start = np.flatnonzero(new)
        run = np.arange(len(ids)) - start[np.cumsum(new) - 1]
        cut = np.flatnonzero(run % PIECE_IDS == 0)
        texts = [
            ",".join(map(str, ids[a:b].tolist())) for a, b in zip(cut, [*cut[1:], len(ids)], strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(keys[cut, i]) for i in range(3)), pa.array(ids[cut]), pa.array(texts)],
            names=[*KEY, "begin", "ids"],
        )


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(keys, digests):
        return pa.RecordBatch.from_arrays(
            [*(pa.array([k[i] for k in keys], pa.int64()) for i in range(3)), pa.array(digests, pa.string())],
            names=[*KEY, "ends_sha256"],
        )

    key, state = None, None
    for batch in batches:
        keys, digests = [], []
        columns = [batch.column(c).to_pylist() for c in KEY]
        for *now, text in zip(*columns, batch.column("ids").to_pylist(), strict=True):
            if now == key:
                state.update(b",")
            else:
                if key is not None:
                    keys.append(key)
                    digests.append(state.hexdigest())
                key, state = now, hashlib.sha256()
            state.update(text.encode())
        if keys:
            yield out(keys, digests)
    if key is not None:
        yield out([key], [state.hexdigest()])


def build(rows: DataFrame, convs: DataFrame, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """The trie over numbered turns; ``convs`` lists every conversation, turnless ones too.

    Returns one row per node: ``conv_id`` (smallest member), ``depth``,
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves``, ``saved_tokens``,
    ``ends_sha256``.
    """
    spark = rows.sparkSession
    zero = F.lit(0).cast("long")
    whole = convs.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).first()
    paths = keep(prefixes(rows), "paths")
    nodes = keep(_nodes(paths, whole["conv_id"] or 0), "trie")
    summed = roll_up(nodes, paths, local_nodes)
    everything = nodes.agg(
        F.sum((F.col("depth") == 1).cast("long")).alias("n_children"),
        F.sum("leaf").alias("leaves"),
        F.sum("saved").alias("saved"),
    )
    root = everything.where(F.lit(whole["n_convs"] > 0)).select(
        *[F.lit(0).cast("long").alias(c) for c in KEY],
        F.lit(whole["conv_id"]).cast("long").alias("conv_id"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(whole["n_convs"]).cast("long").alias("n_convs"),
        F.coalesce("n_children", zero).alias("n_children"),
        # A root without children is the one leaf.
        F.greatest(F.coalesce("leaves", zero), F.lit(1).cast("long")).alias("n_leaves"),
        F.coalesce("saved", zero).alias("saved_tokens"),
    )
    below = paths.where("depth = length").select(*KEY, "conv_id")
    turnless = convs.join(below, "conv_id", "left_anti").select(
        *[F.lit(0).cast("long").alias(c) for c in KEY], "conv_id"
    )
    digests = ends_digest(below.unionByName(turnless))
    return (
        summed.select(root.columns)
        .unionByName(root)
        .join(digests, KEY, "left")
        .select(
            "conv_id",
            "depth",
            "parent_conv_id",
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
        )
    )


def prefix_trie(conversations: DataFrame, local_nodes: int = LOCAL_NODES) -> DataFrame:
    """The trie of conversations as they are; see :func:`build` for the columns."""
    rows = keep(turn_rows(conversations), "rows")
    return build(rows, rows.select("conv_id").distinct(), local_nodes)


def shared_prefix_trie(
    conversations: DataFrame, every: int = 5, most: int = 9, local_nodes: int = LOCAL_NODES
) -> DataFrame:
    """The trie of conversations rebuilt by :func:`shared_openings`."""
    rows = keep(turn_rows(conversations), "rows")
    convs = keep(rows.select("conv_id").distinct(), "convs")
    return build(shared_openings(rows, convs, every, most), convs, local_nodes)


# crc32 as DuckDB has none: its table by eight shifts, then one step per digit.
ORACLE_SQL = """WITH RECURSIVE shifts AS (
  SELECT i, i AS v, 0 AS step FROM range(256) t(i)
  UNION ALL
  SELECT i, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, step + 1
  FROM shifts WHERE step < 8),
crc_table AS (SELECT list(v ORDER BY i) AS tab FROM shifts WHERE step = 8),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 5 AS base, xor(list_reduce(
    list_prepend(4294967295::BIGINT,
      list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
    lambda crc, b: xor(crc >> 8, tab[(xor(crc, b) & 255) + 1])), 4294967295) % 9 AS h
  FROM conversations, crc_table WHERE conv_id IS NOT NULL),
sized AS (
  SELECT c.conv_id, c.base, c.h, least(c.h, count(t.pos)) AS taken
  FROM convs c LEFT JOIN turns t ON t.conv_id = c.base GROUP BY c.conv_id, c.base, c.h),
rebuilt AS (
  SELECT s.conv_id, t.pos, t.role, t.text FROM sized s JOIN turns t ON t.conv_id = s.base AND t.pos <= s.h
  UNION ALL
  SELECT s.conv_id, t.pos - s.h + s.taken, t.role, t.text
  FROM sized s JOIN turns t ON t.conv_id = s.conv_id AND t.pos > s.h),
paths AS (
  SELECT conv_id, pos AS depth, text, max(pos) OVER (PARTITION BY conv_id) AS length,
         sha256(list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY pos)::VARCHAR) AS node
  FROM rebuilt
  UNION ALL
  SELECT s.conv_id, 0, '', coalesce(r.length, 0), ''
  FROM sized s LEFT JOIN (SELECT conv_id, max(pos) AS length FROM rebuilt GROUP BY conv_id) r USING (conv_id)),
nodes AS (
  SELECT depth, node, min(conv_id) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * max(octet_length(encode(text))) AS saved,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)
                         FILTER (WHERE depth = length), '')) AS ends_sha256
  FROM paths GROUP BY depth, node),
edges AS (
  SELECT n.depth, n.node, p.node AS parent, u.conv_id AS parent_conv_id
  FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
  JOIN nodes u ON u.depth = p.depth AND u.node = p.node),
kids AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM edges GROUP BY 1, 2),
sums AS (
  SELECT p.depth, p.node, count(*) FILTER (WHERE k.n_children IS NULL) AS n_leaves, sum(n.saved) AS saved_tokens
  FROM nodes n LEFT JOIN kids k ON k.depth = n.depth AND k.node = n.node
  JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth
  GROUP BY p.depth, p.node)
SELECT n.conv_id, n.depth, e.parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
       s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s ON s.depth = n.depth AND s.node = n.node
LEFT JOIN edges e ON e.depth = n.depth AND e.node = n.node
LEFT JOIN kids k ON k.depth = n.depth AND k.node = n.node"""
