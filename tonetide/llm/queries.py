"""The driver's queries over the operators of this folder."""

from __future__ import annotations

import public_tokenizers

from tonetide.llm import (
    filter_audit,
    hyperminhash,
    license_scan,
    merge_replay,
    mixing,
    prefix_trie,
    quality_llr,
    seekable_ids,
    substring_dedup,
    toxicity_kn,
    url_templates,
    vector_dedup,
    warc_chunks,
)
from tonetide.llm.common import prepare, table


def op1_substring_dedup(spark, sf_dir):
    return substring_dedup.repeated_passages(
        table(prepare(spark), sf_dir, "documents", "doc_id", "text")
    )


def op2_token_ids(spark, sf_dir):
    docs = table(prepare(spark), sf_dir, "documents", "doc_id", "text")
    return seekable_ids.encode_to_files(
        spark, docs, public_tokenizers.path("word_bpe_49k.json"), docs.rdd.getNumPartitions()
    )


def op3_url_templates(spark, sf_dir):
    return url_templates.judge(
        table(spark, sf_dir, "pages", "page_id", "url"),
        table(spark, sf_dir, "labels", "doc_id", "quality"),
    )


def op4_vector_dedup(spark, sf_dir):
    return vector_dedup.near_vectors(table(prepare(spark), sf_dir, "embeddings", "vec_id", "embedding"))


def op5_source_mix(spark, sf_dir):
    return mixing.taken_words(table(spark, sf_dir, "documents", "doc_id", "text", "source"))


def op6_bpe_merge_replay(spark, sf_dir):
    docs = table(prepare(spark), sf_dir, "documents", "doc_id", "text")
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return merge_replay.digests(
        merge_replay.encode_decode(docs, ranks, public_tokenizers.PATTERN)
    )


def op9_toxicity(spark, sf_dir):
    docs = table(prepare(spark), sf_dir, "documents", "doc_id", "text")
    return toxicity_kn.score(spark, docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


def op10_quality_rules(spark, sf_dir):
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return quality_llr.judge(table(spark, sf_dir, "documents", "doc_id", "text"), trusted)


def op7_warc(spark, sf_dir):
    pages = table(prepare(spark), sf_dir, "pages", "page_id", "url", "html")
    return warc_chunks.archive_and_read(spark, pages, pages.rdd.getNumPartitions())


def op8_minhash_near_dedup(spark, sf_dir):
    return hyperminhash.near_duplicates(
        table(prepare(spark), sf_dir, "documents", "doc_id", "text")
    )


def op11_filter_audit(spark, sf_dir):
    return filter_audit.audit(
        table(prepare(spark), sf_dir, "documents", "doc_id", "text", "lang"),
        table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"),
    )


def op12_license_scan(spark, sf_dir):
    return license_scan.scan(table(prepare(spark), sf_dir, "documents", "doc_id", "text"))


def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.shared_prefix_trie(table(spark, sf_dir, "conversations"))


def queries():
    return {
        query.__name__: query
        for query in (
            op1_substring_dedup,
            op2_token_ids,
            op3_url_templates,
            op4_vector_dedup,
            op5_source_mix,
            op6_bpe_merge_replay,
            op7_warc,
            op8_minhash_near_dedup,
            op9_toxicity,
            op10_quality_rules,
            op11_filter_audit,
            op12_license_scan,
            op13_prefix_trie,
        )
    }


def oracle_sql():
    return {
        "op11_filter_audit": filter_audit.ORACLE_SQL,
        "op13_prefix_trie": prefix_trie.ORACLE_SQL,
    }
