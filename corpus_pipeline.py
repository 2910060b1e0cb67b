"""A corpus made ready for training, stage by stage, each written before the next reads it."""

from __future__ import annotations

import public_tokenizers

from tonetide.llm import hyperminhash, merge_replay, mixing, substring_dedup, toxicity_kn
from tonetide.llm.common import keep, prepare, table


def toxicity(spark, docs, sf_dir):
    """Documents predicted to be toxic go; all others stay."""
    scored = toxicity_kn.score(prepare(spark), docs, table(spark, sf_dir, "labels"))
    # Only the rejected ids are joined back, the smaller side by far.
    rejected = scored.where("predicted = 1").select("doc_id").distinct()
    return docs.join(rejected, "doc_id", "left_anti").select(*docs.columns)


def minhash_near_dedup(spark, docs, sf_dir):
    """Of every group of near copies the document with the smallest id stays.

    Rows that repeat an id count as copies, and the text with the smallest SHA-256 stays;
    rows without an id all stay.
    """
    prepare(spark)
    found = hyperminhash.near_duplicates(docs)
    dropped = found.where("NOT kept").select("doc_id").distinct()
    named = docs.where("doc_id IS NOT NULL").join(dropped, "doc_id", "left_anti")
    named = substring_dedup.one_text_per_id(named.select(*docs.columns)).dropDuplicates(["doc_id"])
    return named.unionByName(docs.where("doc_id IS NULL"))


def substring_dedup_stage(spark, docs, sf_dir):
    """Passages that an earlier document has are cut out; every document stays."""
    prepare(spark)
    return substring_dedup.without_repeats(docs)


def source_mix(spark, docs, sf_dir):
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs).select(*docs.columns)


def bpe_merge_replay(spark, docs, sf_dir):
    """Token ids of every document of the mix, with a check that they decode to its text."""
    prepare(spark)
    coded = merge_replay.encode_decode(
        docs,
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
    return merge_replay.digests(coded)


STAGES = [
    ("toxicity", toxicity),
    ("minhash_near_dedup", minhash_near_dedup),
    ("substring_dedup", substring_dedup_stage),
    ("source_mix", source_mix),
    ("bpe_merge_replay", bpe_merge_replay),
]

# The language model, the hashes of the mix and the tokenizer have no SQL form. Tests hold
# each stage against its operator, and the operators against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; each result is written as Parquet and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = keep(stage(spark, docs, sf_dir), name)
    return docs
