"""URL filters from rules and from a path-template tree for every host.

Native: every step is a DataFrame expression.

The paths of a host form a tree of segments. Level by level a segment becomes a
wildcard where it is variable (rare among many siblings) or where its pages are
statistically like those of its siblings (the rates of bad labels differ by less
than chance would explain). Templates are then rejected by their share of bad pages
among labelled ones, smoothed towards the host's, which is smoothed towards the
share of all. Levels beyond DEPTH become one wildcard. A rule, where one fits, goes
before the template.

Pages are first counted by host and path, and all further steps read those counts,
so a host with a third of all pages is spread over its paths and from then on over
its templates.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tonetide.llm.common import keep, lower_ascii

DEPTH = 4
WILD = "*"
# A segment with fewer pages than this among at least as many siblings is variable.
VARIABLE = 5
# Standard errors by which rates must differ for a segment to keep its name.
DIFFERENT = 3.0
# Labelled pages that the smoothing counts for, at the template and at the host.
PRIOR_TEMPLATE = 20.0
PRIOR_HOST = 50.0
# A template is rejected if its smoothed share of good pages is below this.
PURITY = 0.5


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com", "/"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """From behind the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lowered."""
    return lower_ascii(F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """From behind the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(_after_scheme(url), F.lit("")), r"^[^/?#]*([^?#]*)", 1)


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule for the host or a parent domain whose path the path starts with."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        hit = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, hit).otherwise(found)
    return found


def _segment(level: int) -> Column:
    """A path's segment at a level; the last level holds one wildcard for all deeper ones."""
    part = F.get(F.col("parts"), F.lit(level))
    if level < DEPTH - 1:
        return part
    return F.when(F.size("parts") > DEPTH, F.lit(WILD + WILD)).otherwise(part)


def templates(paths: DataFrame) -> DataFrame:
    """``host``, ``path`` and ``template`` from counted paths.

    ``paths`` has a row per host and path with ``pages``, ``labelled`` and ``bad``.
    A level's branches are few compared with pages: they are counted with partial
    sums before the shuffle.
    """
    rows = paths.withColumn(
        "parts", F.filter(F.split("path", "/"), lambda p: p != "")
    ).withColumn("template", F.lit(""))
    sums = [F.sum(c).alias(c) for c in ("pages", "labelled", "bad")]
    for level in range(DEPTH):
        rows = rows.withColumn("segment", _segment(level))
        branches = rows.where("segment IS NOT NULL").groupBy("host", "template", "segment").agg(*sums)
        above = branches.groupBy("host", "template").agg(
            F.count("*").alias("siblings"),
            F.sum("labelled").alias("all_labelled"),
            F.sum("bad").alias("all_bad"),
        )
        others = F.col("all_labelled") - F.col("labelled")
        rate = F.col("all_bad") / F.col("all_labelled")
        error = F.sqrt(rate * (1 - rate) * (1 / F.col("labelled") + 1 / others))
        apart = F.abs(F.col("bad") / F.col("labelled") - (F.col("all_bad") - F.col("bad")) / others)
        different = (
            (F.col("labelled") > 0) & (others > 0) & (error > 0) & (apart > DIFFERENT * error)
        )
        variable = (F.col("pages") < VARIABLE) & (F.col("siblings") >= VARIABLE)
        # An only branch has nothing to be merged with and keeps its name.
        named = ~variable & ((F.col("siblings") == 1) | F.coalesce(different, F.lit(False)))
        kept = (
            branches.join(above, ["host", "template"])
            .where(named)
            .select("host", "template", "segment", F.lit(True).alias("named"))
        )
        step = F.when(F.col("segment").isNull(), "").otherwise(
            F.concat(F.lit("/"), F.when(F.col("named"), F.col("segment")).otherwise(WILD))
        )
        rows = (
            rows.join(kept, ["host", "template", "segment"], "left")
            .withColumn("template", F.concat("template", step))
            .drop("segment", "named")
        )
        rows = keep(rows, "templates")
    return rows.drop("parts")


def template_verdicts(rows: DataFrame) -> DataFrame:
    """``host``, ``template``, ``purity`` and ``verdict``."""
    sums = [F.sum(c).alias(c) for c in ("labelled", "bad")]
    by_template = rows.groupBy("host", "template").agg(*sums)
    by_host = by_template.groupBy("host").agg(*[F.sum(c).alias(f"host_{c}") for c in ("labelled", "bad")])
    # One row; with no labels at all everything counts as good.
    everything = by_host.agg(
        F.coalesce(F.sum("host_bad") / F.sum("host_labelled"), F.lit(0.0)).alias("rate")
    )
    rate = keep(everything, "rate").scalar()
    host_rate = (F.col("host_bad") + PRIOR_HOST * rate) / (F.col("host_labelled") + PRIOR_HOST)
    bad = (F.col("bad") + PRIOR_TEMPLATE * F.col("host_rate")) / (F.col("labelled") + PRIOR_TEMPLATE)
    return (
        by_template.join(by_host.withColumn("host_rate", host_rate), "host")
        .withColumn("purity", 1 - bad)
        .select(
            "host",
            "template",
            "purity",
            F.when(F.col("purity") < PURITY, "block").otherwise("allow").alias("verdict"),
        )
    )


def judge(pages: DataFrame, labels: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``template``, ``purity`` of every row.

    ``labels`` says of ids (``doc_id``, matched with ``page_id``) whether a page is
    good (``quality`` 1) or bad (0); null labels are ignored, and where an id has
    several the worst counts. A null url, or one without ``://``, has an empty host
    and path. Rows are judged by their url, so repeated rows and null ids get the
    same verdict; an empty table gives an empty result. Other columns are ignored.
    """
    marks = (
        labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy(F.col("doc_id").alias("page_id"))
        .agg((F.min("quality") == 0).cast("int").alias("_bad"))
    )
    urls = pages.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    paths = (
        urls.join(marks, "page_id", "left")
        .groupBy("host", "path")
        .agg(
            F.count("*").alias("pages"),
            F.count("_bad").alias("labelled"),
            F.coalesce(F.sum("_bad"), F.lit(0)).alias("bad"),
        )
    )
    placed = templates(keep(paths, "paths"))
    verdicts = template_verdicts(placed)
    by_path = placed.select("host", "path", "template").join(verdicts, ["host", "template"])
    fit = fitting_rule(F.col("host"), F.col("path"), rules)
    return (
        urls.join(by_path, ["host", "path"])
        .withColumn("fit", fit)
        .select(
            "page_id",
            "host",
            "path",
            F.col("fit.rule").alias("rule"),
            F.coalesce("fit.verdict", "verdict").alias("verdict"),
            "template",
            "purity",
        )
    )
