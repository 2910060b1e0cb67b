"""Bringing tones and themes together.

Mentions carry tones, documents carry themes; they meet on the document id. The
relation is many to many and one id may be very common on either side, so the
tone jobs first collapse the documents, the smaller side, to distinct rows with a
multiplicity: copies on both sides would multiply each other. Mentions go into the
join as they are, shuffled once at most, and equal tones combine in the same task
right after it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonetide.functions import clean_themes, once
from tonetide.operators.vocabulary import Vocabulary, clean_codes, filter_to_vocab
from tonetide.session import written

# Slots of the filter that mentions pass before their shuffle. A slot is a broadcast
# row of one long, so this bounds the broadcast whatever the number of documents.
FILTER_SLOTS = 1 << 20


def join_mentions(mentions: DataFrame, documents: DataFrame) -> DataFrame:
    """Mentions with the other columns of every document they refer to."""
    return mentions.join(
        documents, F.col("mention_id") == F.col("doc_id"), "inner"
    ).drop("doc_id")


def document_themes(
    documents: DataFrame,
    taxonomy: Vocabulary | None = None,
    themes: Vocabulary | None = None,
    sources: Vocabulary | None = None,
    by_source: bool = True,
) -> DataFrame:
    """Distinct (id, source, wanted themes) of the documents and their number.

    Themes are cleaned and narrowed to the vocabulary before anything is
    shuffled; a document left without themes is gone. Vocabularies given as lists
    work inside the theme array. A DataFrame vocabulary is joined to the codes, whose
    themes are then put together again, so that either way a document is one row
    until after the join (one for each number of copies).
    """
    if sources is not None:
        documents = filter_to_vocab(documents, "src_common_name", sources)
    keys = ["doc_id", "src_common_name"] if by_source else ["doc_id"]

    if isinstance(taxonomy, DataFrame) or isinstance(themes, DataFrame):
        rows = _theme_rows(documents, keys, taxonomy, themes)
        # Bounded by the themes of one document.
        return rows.groupBy(*keys, "copies").agg(F.collect_list("theme").alias("themes"))

    rows = documents.select(*keys, once(_theme_arrays(taxonomy, themes)).alias("themes"))
    return (
        rows.where(F.size("themes") > 0)
        .groupBy(*keys, "themes")
        .agg(F.count("*").alias("copies"))
    )


def _theme_arrays(taxonomy: Iterable[str] | None, themes: Iterable[str] | None):
    wanted = F.col("themes")
    if taxonomy is not None:
        wanted = clean_themes(wanted, taxonomy)
    if themes is not None:
        vocab = sorted(set(themes))
        wanted = F.filter(wanted, lambda theme: theme.isin(*vocab))
    return wanted


def _theme_rows(
    documents: DataFrame,
    keys: list[str],
    taxonomy: Vocabulary | None,
    themes: Vocabulary | None,
) -> DataFrame:
    rows = (
        documents.select(*keys, F.explode("themes").alias("code"))
        .groupBy(*keys, "code")
        .agg(F.count("*").alias("copies"))
    )
    # The distinct codes form a small dictionary, cleaned once per code instead of
    # once per occurrence. It reads the counts as well, which always pass, so that
    # both readers of `rows` share its shuffle.
    codes = rows.groupBy("code").agg(F.sum("copies").alias("occurrences"))
    dictionary = clean_codes(codes.where(F.col("occurrences") > 0).select("code"), taxonomy)
    if themes is not None:
        dictionary = filter_to_vocab(dictionary, "theme", themes)
    return rows.join(dictionary, "code")


def _slot(key: str):
    return F.pmod(F.xxhash64(key), F.lit(FILTER_SLOTS))


def possible_mentions(mentions: DataFrame, documents: DataFrame) -> DataFrame:
    """Mentions less most of those that refer to none of the documents.

    The documents' ids are hashed to slots, and mentions whose id falls in a free slot
    go, in the task that read them. With ``n`` distinct ids no more than
    ``n / FILTER_SLOTS`` of the other mentions stay by chance; the join drops those.
    Once half of the slots are taken the filter is not worth its broadcast, and all
    mentions stay. ``documents`` is read twice, so it should be a written table.
    """
    taken = written(documents.select(_slot("doc_id").alias("slot")).distinct(), "slots")
    if 2 * taken.count() > FILTER_SLOTS:
        return mentions
    return mentions.join(F.broadcast(taken), _slot("mention_id") == F.col("slot"), "left_semi")


def theme_tones(
    mentions: DataFrame,
    documents: DataFrame,
    taxonomy: Vocabulary | None = None,
    themes: Vocabulary | None = None,
    sources: Vocabulary | None = None,
    by_source: bool = True,
    few_documents: bool = False,
) -> DataFrame:
    """One row per theme, time, source and tone of a joined pair, with its weight.

    The sum of ``weight`` is the number of rows the plain join followed by
    ``explode`` would give. An id that is hot on one side remains a skewed join
    partition; adaptive execution splits it, and nothing downstream ties the join
    to its partitioning.

    ``few_documents`` is for feeds of which few documents have a wanted theme: these
    are written first and keep mentions of others out of the shuffle
    (:func:`possible_mentions`). Results are the same.
    """
    coded = document_themes(documents, taxonomy, themes, sources, by_source)
    if few_documents:
        coded = written(coded, "documents")
        mentions = possible_mentions(mentions, coded)
    source = ["src_common_name"] if by_source else []
    return join_mentions(mentions, coded).select(
        F.explode("themes").alias("theme"),
        F.col("mention_time_date").alias("time"),
        *source,
        "mention_doc_tone",
        F.col("copies").alias("weight"),
    )
