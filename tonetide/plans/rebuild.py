"""The daily run: vocabularies, then both result tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonetide.plans.steps import END, Steps, input_state
from tonetide.plans.tone_jobs import theme_tone, tone_tables
from tonetide.plans.vocab_jobs import taxonomy_words, top_sources, top_themes
from tonetide.schemas import (
    DOCUMENT_REQUIRED_SOURCE,
    DOCUMENT_REQUIRED_THEMES,
    STATS_COLUMNS,
    TAXONOMY_MIN_COUNT,
    TOP_SOURCES,
    TOP_THEMES,
)
from tonetide.session import configure, use_checkpoint_dir
from tonetide.sources import (
    check_stats,
    read_documents,
    read_mentions,
    read_vocab,
    small_list,
    write_jdbc,
    write_stats,
    write_vocab,
)


@dataclass(frozen=True)
class Paths:
    """Where a run reads and writes. Feed paths may be globs.

    The three ``*_documents`` globs choose the files a vocabulary is learned from
    and default to ``documents``.
    """

    mentions: str
    documents: str
    taxonomy: str
    themes: str
    sources: str
    theme_day: str
    theme_day_source: str
    taxonomy_documents: str | None = None
    themes_documents: str | None = None
    sources_documents: str | None = None


def learn_taxonomy(
    spark: SparkSession,
    documents: str,
    out: str,
    min_count: int = TAXONOMY_MIN_COUNT,
    extra: Iterable[str] = (),
) -> None:
    """Write the taxonomy words of the documents."""
    coded = read_documents(spark, documents, require=DOCUMENT_REQUIRED_THEMES)
    write_vocab(taxonomy_words(coded, min_count, extra), out)


def learn_themes(
    spark: SparkSession, documents: str, taxonomy: str, out: str, k: int = TOP_THEMES
) -> None:
    """Write the top themes of the documents, cleaned by the list at ``taxonomy``."""
    words = small_list(read_vocab(spark, taxonomy, "first_two_themes"))
    coded = read_documents(spark, documents, require=DOCUMENT_REQUIRED_THEMES)
    write_vocab(top_themes(coded, words, k), out)


def learn_sources(spark: SparkSession, documents: str, out: str, k: int = TOP_SOURCES) -> None:
    """Write the top sources of the documents."""
    named = read_documents(spark, documents, require=DOCUMENT_REQUIRED_SOURCE)
    write_vocab(top_sources(named, k), out)


def write_theme_tone(
    spark: SparkSession,
    mentions: str,
    documents: str,
    out: str,
    grain: str = "second",
    taxonomy: str | None = None,
    themes: str | None = None,
) -> None:
    """Write the table of one grain over all sources, of raw codes or with the lists given."""

    def listed(path: str | None, key: str):
        return None if path is None else small_list(read_vocab(spark, path, key))

    stats = theme_tone(
        read_mentions(spark, mentions, grain=grain),
        read_documents(spark, documents),
        listed(taxonomy, "first_two_themes"),
        listed(themes, "theme"),
    )
    write_stats(stats, out)


def rebuild_vocabularies(
    spark: SparkSession,
    paths: Paths,
    min_count: int = TAXONOMY_MIN_COUNT,
    extra: Iterable[str] = (),
    k_themes: int = TOP_THEMES,
    k_sources: int = TOP_SOURCES,
    steps: Steps | None = None,
) -> None:
    """Learn the three lists from the documents and write them."""
    jobs = {
        "taxonomy": lambda: learn_taxonomy(
            spark, paths.taxonomy_documents or paths.documents, paths.taxonomy, min_count, extra
        ),
        "themes": lambda: learn_themes(
            spark, paths.themes_documents or paths.documents, paths.taxonomy, paths.themes, k_themes
        ),
        "sources": lambda: learn_sources(
            spark, paths.sources_documents or paths.documents, paths.sources, k_sources
        ),
    }
    for name, job in jobs.items():
        if steps is None:
            job()
        else:
            steps.do(name, job)


def _run_steps(
    spark: SparkSession, folder: str, paths: Paths, mode: str, databases, options: dict
) -> Steps:
    """The run's steps, known by its arguments and by the files it reads."""
    learned = [paths.taxonomy_documents, paths.themes_documents, paths.sources_documents]
    # Lists that the run itself writes are results, not inputs.
    given = [*filter(None, learned)]
    if mode == "existing":
        given = [paths.taxonomy, paths.themes, paths.sources]
    return Steps(
        spark,
        folder,
        {
            "paths": asdict(paths),
            "mode": mode,
            "options": {k: list(v) if k == "extra" else v for k, v in options.items()},
            "databases": {grain: to.get("table") for grain, to in (databases or {}).items()},
            "inputs": input_state(spark, [paths.mentions, paths.documents, *given]),
        },
    )


def run_all(
    spark: SparkSession,
    paths: Paths,
    mode: str = "existing",
    checkpoint_dir: str | None = None,
    databases: Mapping[str, Mapping[str, str]] | None = None,
    **vocabulary_options,
) -> None:
    """Write both result tables; with mode ``new`` rebuild the vocabularies first.

    Both tables come from one pass over the feeds. The finished rows, small next
    to the feeds, are written to the shared folder, so writing two tables
    neither repeats the pass nor depends on executors staying alive. A run that died is
    taken up after its last finished step if it is started again with the same arguments
    and input files (:mod:`tonetide.plans.steps`); a run that finished is done again.

    Nothing is written if any of the rows breaks a rule of its table
    (:func:`check_stats`): a ``ValueError`` names some of them.

    ``databases`` maps ``theme_day`` and ``theme_day_source`` to keywords of
    :func:`write_jdbc`; a table named there is appended to its database as well. An append
    that dies between its commit and its marker is made again, which the table's primary
    key refuses.
    """
    if mode not in ("new", "existing"):
        raise ValueError(f"mode must be 'new' or 'existing', not {mode!r}")
    configure(spark)
    folder = use_checkpoint_dir(spark, checkpoint_dir).rstrip("/")
    steps = _run_steps(spark, folder, paths, mode, databases, vocabulary_options)
    if mode == "new":
        rebuild_vocabularies(spark, paths, **vocabulary_options, steps=steps)

    tables = {
        "theme_day": (paths.theme_day, ("theme",)),
        "theme_day_source": (paths.theme_day_source, ("theme", "src_common_name")),
    }

    def statistics() -> str:
        path = f"{folder}/statistics-{uuid.uuid4().hex}"
        stats = tone_tables(
            read_mentions(spark, paths.mentions),
            read_documents(spark, paths.documents),
            taxonomy=small_list(read_vocab(spark, paths.taxonomy, "first_two_themes")),
            themes=small_list(read_vocab(spark, paths.themes, "theme")),
            sources=small_list(read_vocab(spark, paths.sources, "src_common_name")),
        )
        stats.write.parquet(path)
        return path

    stats = spark.read.parquet(steps.do("statistics", statistics))
    for grain, (_, names) in tables.items():
        rows = stats.where(F.col("grain") == grain)
        broken = check_stats(rows, (*names, "time")).take(5)
        if broken:
            raise ValueError(f"rows of {grain} break the rules of their table: {broken}")
    for grain, (path, names) in tables.items():
        rows = stats.where(F.col("grain") == grain).select(*names, *STATS_COLUMNS, "time")
        steps.do(grain, lambda rows=rows, path=path: write_stats(rows, path))
        if databases and grain in databases:
            to = databases[grain]
            steps.do(f"{grain}_database", lambda rows=rows, to=to: write_jdbc(rows, **to))
    steps.do(END, lambda: None)
