"""Command line: ``spark-submit`` this module to write result tables and lists.

    python -m tonetide existing --mentions ... --documents ... --taxonomy ...

Mode ``new`` first rebuilds the three vocabulary lists at the paths given for
them; ``existing`` reads what is there. ``taxonomy``, ``themes`` and ``sources`` learn one
list, ``tone`` writes the table over all sources at one grain; see ``<mode> --help``.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from dataclasses import fields

from pyspark.sql import SparkSession

from tonetide.functions import GRAINS
from tonetide.plans import rebuild
from tonetide.plans.rebuild import Paths, run_all
from tonetide.schemas import MANUAL_TAXONOMY_WORDS, TAXONOMY_MIN_COUNT, TOP_SOURCES, TOP_THEMES
from tonetide.session import configure
from tonetide.sources import jdbc_settings

TABLES = ("theme_day", "theme_day_source")


def parser() -> argparse.ArgumentParser:
    cli = argparse.ArgumentParser(prog="tonetide", description=__doc__.splitlines()[0])
    modes = cli.add_subparsers(dest="mode", required=True)
    for mode in ("new", "existing"):
        _run_options(modes.add_parser(mode))

    taxonomy = modes.add_parser("taxonomy")
    themes = modes.add_parser("themes")
    themes.add_argument("--taxonomy", required=True)
    themes.add_argument("--top", type=int, default=TOP_THEMES)
    sources = modes.add_parser("sources")
    sources.add_argument("--top", type=int, default=TOP_SOURCES)
    tone = modes.add_parser("tone")
    tone.add_argument("--mentions", required=True)
    tone.add_argument("--grain", choices=sorted(GRAINS), default="second")
    tone.add_argument("--taxonomy", help="raw codes are the themes without it")
    tone.add_argument("--themes", help="all themes are kept without it")
    taxonomy.add_argument("--cut", type=int, default=TAXONOMY_MIN_COUNT)
    _manual_words(taxonomy)
    for job in (taxonomy, themes, sources, tone):
        job.add_argument("--documents", required=True)
        job.add_argument("--out", required=True)
    return cli


def _manual_words(cli: argparse.ArgumentParser) -> None:
    cli.add_argument(
        "--manual-words", action="store_true", help="add the hand-picked taxonomy words"
    )


def _run_options(cli: argparse.ArgumentParser) -> None:
    for field in fields(Paths):
        flag = "--" + field.name.replace("_", "-")
        cli.add_argument(flag, required=not field.name.endswith("_documents"))
    cli.add_argument("--checkpoint-dir", help="used if spark.checkpoint.dir is not set")
    for table in TABLES:
        cli.add_argument(
            f"--{table.replace('_', '-')}-jdbc",
            metavar="INI",
            help=f"settings of the database that also takes {table}: url, username, password, "
            "driver and table in a section [postgresql]",
        )
    cli.add_argument("--taxonomy-cut", type=int, default=TAXONOMY_MIN_COUNT)
    cli.add_argument("--top-themes", type=int, default=TOP_THEMES)
    cli.add_argument("--top-sources", type=int, default=TOP_SOURCES)
    _manual_words(cli)


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = SparkSession.builder.appName("tonetide").getOrCreate()
    if args.mode in ("new", "existing"):
        return _run(spark, args)
    configure(spark)
    if args.mode == "taxonomy":
        extra = MANUAL_TAXONOMY_WORDS if args.manual_words else ()
        rebuild.learn_taxonomy(spark, args.documents, args.out, args.cut, extra)
    elif args.mode == "themes":
        rebuild.learn_themes(spark, args.documents, args.taxonomy, args.out, args.top)
    elif args.mode == "sources":
        rebuild.learn_sources(spark, args.documents, args.out, args.top)
    else:
        rebuild.write_theme_tone(
            spark, args.mentions, args.documents, args.out, args.grain, args.taxonomy, args.themes
        )


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    paths = Paths(**{field.name: getattr(args, field.name) for field in fields(Paths)})
    settings = {table: getattr(args, f"{table}_jdbc") for table in TABLES}
    run_all(
        spark,
        paths,
        args.mode,
        args.checkpoint_dir,
        {table: jdbc_settings(path) for table, path in settings.items() if path},
        min_count=args.taxonomy_cut,
        extra=MANUAL_TAXONOMY_WORDS if args.manual_words else (),
        k_themes=args.top_themes,
        k_sources=args.top_sources,
    )


if __name__ == "__main__":
    main()
