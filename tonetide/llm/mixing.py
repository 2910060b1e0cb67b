"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Native: every step is a DataFrame expression.

Documents fall into blocks by hash, at most BLOCKS for a source whatever its size. A
source's target says how often its blocks are taken: all of them a whole number of
times, and in permuted order once more until the rest of the target is met. The
quotas of blocks are then split exactly among output shards: a tree halves them
level by level, each half drawn from the multivariate hypergeometric distribution
(one source after the other, given what is left), which is what dealing out all
blocks in random order would give. A shard takes its quota of each source from the
source's permuted blocks, no block twice, and orders its documents by hash.

All draws come from hashes of a seed and of names, so reruns agree. Only hashes of
documents and sums over them are shuffled; the tree's tables have a row for every
node and an entry for every source.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tonetide.llm.common import WORD, keep

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
BLOCKS = 4096
LEVELS = 6  # of the tree: 64 shards
SEED = 20_240


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS) -> DataFrame:
    """``key``, ``number``, ``source_size`` and ``target`` of every source.

    Sources by code point, null last, take the weights in turn and share all words
    in proportion; a target stops at MOST_COPIES times its source's size and the
    excess goes to the others by weight until none is above. That level is found
    in one pass over the sources in the order in which they fill up.
    """
    # Windows over one row per source.
    order = Window.orderBy("has_none", "source")
    choice = F.array(*[F.lit(w) for w in weights])
    sources = (
        sized.groupBy("key", "source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("has_none", F.col("source").isNull())
        .withColumn("number", F.row_number().over(order) - 1)
        .withColumn("weight", F.get(choice, F.col("number") % len(weights)))
        .withColumn("most", F.col("source_size") * MOST_COPIES)
    )
    filling = Window.orderBy(F.col("most") / F.col("weight"), "number")
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    onward = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(before), F.lit(0))
    sources = sources.withColumn("level", left / F.sum("weight").over(onward))
    fits = F.col("most") / F.col("weight") >= F.col("level")
    level = F.max(F.when(fits, F.col("level"))).over(whole)
    return sources.select(
        "key",
        "number",
        "source_size",
        F.least(F.col("most").cast("double"), F.col("weight") * level).alias("target"),
    )


@dataclass
class Mix:
    """``sized``: a row per document with its ``key``, ``block`` and ``size``.

    ``blocks``: size and target of a source beside each of its blocks, with the
    words in it and how often the mix takes it (``copies``). ``units``: ``key``,
    ``block``, ``copy`` and the ``shard`` that takes it.
    """

    sized: DataFrame
    blocks: DataFrame
    units: DataFrame


def _log_factorial(n: str) -> str:
    return (
        f"CASE WHEN {n} <= 20 THEN ln(factorial(CAST({n} AS INT))) ELSE ({n} + 0.5D) * ln({n}) - {n}"
        f" + 0.9189385332046727D + 1D / (12D * {n}) - 1D / (360D * {n} * {n} * {n}) END"
    )


def _log_choose(n: str, k: str) -> str:
    return f"({_log_factorial(n)}) - ({_log_factorial(k)}) - ({_log_factorial(f'({n} - {k})')})"


def _hypergeometric(k: str, n: str, draws: str, u: str) -> str:
    """SQL for how many of ``k`` marked among ``n`` are in ``draws``, by inversion at ``u``."""
    low = f"greatest(0L, {draws} - ({n} - {k}))"
    high = f"least({k}, {draws})"
    start = (
        f"{_log_choose(k, low)} + {_log_choose(f'({n} - {k})', f'({draws} - {low})')}"
        f" - ({_log_choose(n, draws)})"
    )
    step = (
        f"ln(CAST({k} - x AS DOUBLE) * ({draws} - x)"
        f" / ((x + 1D) * ({n} - {k} - {draws} + x + 1D)))"
    )
    # Each step adds the chance of x and moves on to that of x + 1.
    return f"""aggregate(sequence({low}, {high}),
        named_struct('logp', {start}, 'sum', 0D, 'found', CAST(NULL AS BIGINT)),
        (t, x) -> named_struct(
            'logp', t.logp + CASE WHEN x < {high} THEN {step} ELSE 0D END,
            'sum', t.sum + exp(t.logp),
            'found', coalesce(t.found, CASE WHEN t.sum + exp(t.logp) >= {u} THEN x END)),
        t -> coalesce(t.found, {high}))"""


def split_quotas(quotas: DataFrame, levels: int = LEVELS, seed: int = SEED) -> DataFrame:
    """``shard``, ``number`` and ``quota`` from ``number`` and ``quota``.

    Shard totals differ by one at most, and a source's quotas sum to its own.
    """
    nodes = quotas.agg(
        F.expr("transform(array_sort(collect_list(struct(number, quota))), s -> s.quota)").alias("q"),
        F.expr("transform(array_sort(collect_list(struct(number, quota))), s -> s.number)").alias("id"),
    ).withColumn("shard", F.lit(0))
    total = "aggregate(q, 0L, (s, x) -> s + x)"
    u = f"(pmod(xxhash64({seed}, %d, shard, i), 9007199254740992L) + 0.5D) / 9007199254740992D"
    draw = _hypergeometric("k", "acc.rest", "acc.need", "u")
    for level in range(levels):
        left = f"""aggregate(
            transform(q, (k, i) -> named_struct('k', k, 'u', {u % level})),
            named_struct('rest', {total}, 'need', {total} div 2, 'out', CAST(array() AS ARRAY<BIGINT>)),
            (acc, s) -> transform(
                transform(array(s), s -> {_bind(draw)}),
                x -> named_struct('rest', acc.rest - s.k, 'need', acc.need - x,
                                  'out', concat(acc.out, array(x))))[0],
            acc -> acc.out)"""
        nodes = (
            nodes.withColumn("left", F.expr(left))
            .select(
                "id",
                F.inline(
                    F.expr(
                        "array(named_struct('shard', shard * 2, 'q', left), named_struct("
                        "'shard', shard * 2 + 1, 'q', zip_with(q, left, (a, b) -> a - b)))"
                    )
                ),
            )
        )
        nodes = keep(nodes, "tree")
    return nodes.select("shard", F.inline(F.arrays_zip(F.col("id").alias("number"), F.col("q").alias("quota"))))


def _bind(draw: str) -> str:
    """``draw`` with its names k and u read from the struct s."""
    return re.sub(r"\bu\b", "s.u", re.sub(r"\bk\b", "s.k", draw))


def plan_mix(docs: DataFrame, levels: int = LEVELS, seed: int = SEED) -> Mix:
    """Decide how often and into which shard every document goes.

    Needs ``doc_id``, ``text`` and ``source``. A null or blank text has size 0; a
    null source is a source of its own; rows that repeat an id fall into one block
    but count each; null ids form a block. An empty table gives an empty mix.
    """
    sized = keep(
        docs.select(
            "doc_id",
            "source",
            # A key that is never null.
            F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("key"),
            word_count(F.col("text")).alias("size"),
            F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(BLOCKS)).cast("int").alias("block"),
        ),
        "sized",
    )
    targets = source_targets(sized)
    words = sized.groupBy("key", "block").agg(F.sum("size").alias("words"))
    # At most BLOCKS rows in a window.
    permuted = Window.partitionBy("key").orderBy(F.xxhash64("key", "block", F.lit(seed)), "block")
    upto = F.sum("words").over(permuted.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    # A block is taken once more if at least half of it is wanted.
    extra = F.col("upto") - F.col("words") / 2 <= rest
    blocks = keep(
        words.join(targets, "key")
        .withColumn("upto", upto)
        .withColumn("whole", whole.cast("int"))
        .withColumn("copies", F.when(F.col("words") > 0, F.least(F.col("whole") + extra.cast("int"), F.lit(MOST_COPIES))).otherwise(0))
        .select("key", "block", "number", "source_size", "target", "words", "copies"),
        "blocks",
    )
    quotas = blocks.groupBy("number").agg(F.sum("copies").cast("long").alias("quota"))
    leaves = split_quotas(quotas, levels, seed)
    by_shard = Window.partitionBy("number").orderBy("shard")
    before = F.sum("quota").over(by_shard.rowsBetween(Window.unboundedPreceding, -1))
    places = leaves.withColumn("before", F.coalesce(before, F.lit(0))).where("quota > 0").select(
        "shard", "number", F.explode(F.expr("sequence(before, before + quota - 1)")).alias("place")
    )
    dealt = Window.partitionBy("key").orderBy(F.xxhash64("key", "block", "copy", F.lit(seed + 1)), "block", "copy")
    units = (
        blocks.where("copies > 0")
        .select("key", "number", "block", F.explode(F.sequence(F.lit(1), "copies")).alias("copy"))
        .withColumn("place", (F.row_number().over(dealt) - 1).cast("long"))
        .join(places, ["number", "place"])
        .select("key", "block", "copy", "shard")
    )
    return Mix(sized, blocks, keep(units, "units"))


def taken_words(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` of every row of ``docs``."""
    mix = plan_mix(docs)
    drawn = mix.units.groupBy("key", "block").agg(F.count("*").alias("times"))
    plan = mix.blocks.join(drawn, ["key", "block"], "left").select(
        "key", "block", "source_size", "target", F.coalesce("times", F.lit(0)).alias("times")
    )
    return mix.sized.join(plan, ["key", "block"]).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken")
    )


def mixed(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The rows of the mix with all their columns, ``shard`` and ``place`` (its local order)."""
    mix = plan_mix(docs, seed=seed)
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    block = F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(BLOCKS)).cast("int")
    return (
        docs.withColumns({"_key": key, "_block": block})
        .join(
            mix.units.withColumnsRenamed({"key": "_key", "block": "_block", "copy": "_copy"}),
            ["_key", "_block"],
        )
        .where(word_count(F.col("text")) > 0)
        .withColumn("place", F.xxhash64("doc_id", "_copy", F.lit(seed + 2)))
        .select(*[docs[c] for c in docs.columns], "shard", "place")
    )
