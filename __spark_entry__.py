"""

Arrays are spread over plain columns, times are printed, and doubles rounded, so
that both engines' results can be compared by value.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonetide import driver_views as v
from tonetide import functions as fn
from tonetide import operators as op
from tonetide import plans, sources
from tonetide.schemas import (
    HISTOGRAM_BINS,
    HISTOGRAM_HIGH,
    HISTOGRAM_LOW,
    MANUAL_TAXONOMY_WORDS,
    QUANTILE_PROBS,
    THEME_DAY_KEYS,
    THEME_DAY_SOURCE_KEYS,
)
from tonetide.operators.sketches import RANK_ERROR
from tonetide.session import configure, shared_folder, written
from tonetide.sources.ledger import add_batch, read_ledger

# The subpackage for training data may be absent; everything else works without it.
try:
    import corpus_pipeline
    from tonetide.llm import queries as llm_queries
except ImportError:
    corpus_pipeline = llm_queries = None

SMOKE_DIR = "/root/testdata/sf0.001"
CELLS = HISTOGRAM_BINS + 2
STATS = ("num_mentions", "avg", "quantiles", "bin_vals")

# Arguments shared by a query and its SQL.
TOP_THEMES_K = 10
TOP_SOURCES_K = 5
TAXONOMY_CUT = 10
SKETCHED_DAYS = ("2024-01-05", "2024-01-20")
EVOLUTION = ("BLUE_GEAR", "1996-01-01", "1999-01-01")
FILE_TIMES = (datetime(1996, 3, 1), datetime(1998, 8, 1))


# -- Spark side ----------------------------------------------------------------


def _flat(df: DataFrame, keys: Sequence[str], parts: Sequence[str] = STATS) -> DataFrame:
    """Result rows with arrays spread out, doubles rounded and times printed."""
    columns = [
        F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time") if k == "time" else F.col(k)
        for k in keys
    ]
    if "num_mentions" in parts:
        columns.append(F.col("num_mentions"))
    if "avg" in parts:
        columns.append(F.round("avg", 10).alias("avg"))
    if "quantiles" in parts:
        columns += [
            F.round(F.get("quantiles", F.lit(i)).cast("double"), 4).alias(f"q{i}")
            for i in range(len(QUANTILE_PROBS))
        ]
    if "bin_vals" in parts:
        columns += [
            F.get("bin_vals", F.lit(i)).alias(f"b{i}") for i in range(CELLS)
        ]
    return df.select(*columns)


def _time(name: str = "time", source: str = "mention_time_date"):
    return F.date_format(source, "yyyy-MM-dd HH:mm:ss").alias(name)


def _codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return v.docs(spark, sf_dir).select("doc_id", F.explode("themes").alias("code"))


def _theme_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.theme_day_tone(
        v.ment(spark, sf_dir), v.docs(spark, sf_dir), v.TAXONOMY, v.THEMES
    )


def _theme_day_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.theme_day_source_tone(
        v.ment(spark, sf_dir), v.docs(spark, sf_dir), v.TAXONOMY, v.THEMES, v.SOURCES
    )


def parse_mentions(spark, sf_dir):
    rows = sources.parse_mentions(v.ment_lines(spark, sf_dir))
    return rows.select("mention_id", "mention_doc_tone", _time())


def parse_documents(spark, sf_dir):
    rows = sources.parse_documents(v.docs_lines(spark, sf_dir))
    return rows.select("doc_id", "src_common_name", F.array_join("themes", "|").alias("themes"))


def rejected_lines(spark, sf_dir):
    return sources.rejected_lines(v.ment_lines(spark, sf_dir), "mentions")


def rejected_lines_second(spark, sf_dir):
    lines = v.ment_lines(spark, sf_dir, bad_times=True)
    return sources.rejected_lines(lines, "mentions", grain="second")


def is_number_filter(spark, sf_dir):
    rows = v.number_texts(spark, sf_dir).where(fn.is_number(F.col("txt")))
    return rows.select("l_orderkey", "l_linenumber", "txt", fn.to_double(F.col("txt")).alias("num"))


def mention_time_second(spark, sf_dir):
    rows = v.raw_ment(spark, sf_dir)
    return rows.select(
        "event_id", "raw_time", _time("time", fn.second_ts(F.col("raw_time")))
    )


def clean_comma(spark, sf_dir):
    return v.docs(spark, sf_dir).select(
        "doc_id",
        fn.strip_comma(F.get("themes", F.lit(0))).alias("first_code"),
        F.array_join(fn.strip_commas(F.col("themes")), "|").alias("codes"),
    )


def first_two_tokens(spark, sf_dir):
    parts = fn.tokens(F.col("code"))
    return _codes(spark, sf_dir).select(
        "doc_id",
        "code",
        F.array_join(fn.first_two(parts), "|").alias("first_two"),
        fn.token_count(parts).cast("bigint").alias("tokens"),
        (~fn.has_digit(F.col("code"))).alias("no_digit"),
    )


def clean_taxonomy(spark, sf_dir):
    themes = fn.clean_themes(F.col("themes"), v.TAXONOMY)
    return v.docs(spark, sf_dir).select("doc_id", F.array_join(themes, "|").alias("themes"))


def explode_themes(spark, sf_dir):
    return _codes(spark, sf_dir)


def distinct_themes(spark, sf_dir):
    return op.distinct_themes(v.docs(spark, sf_dir))


def taxonomy_words(spark, sf_dir):
    return plans.taxonomy_words(v.docs(spark, sf_dir), TAXONOMY_CUT)


def taxonomy_words_extra(spark, sf_dir):
    return plans.taxonomy_words(v.docs(spark, sf_dir), TAXONOMY_CUT, MANUAL_TAXONOMY_WORDS)


def theme_counts(spark, sf_dir):
    return plans.vocab_jobs.theme_counts(v.docs(spark, sf_dir), v.TAXONOMY)


def top_themes(spark, sf_dir):
    return plans.top_themes(v.docs(spark, sf_dir), v.TAXONOMY, TOP_THEMES_K)


def top_sources(spark, sf_dir):
    return plans.top_sources(v.docs(spark, sf_dir), TOP_SOURCES_K)


def top_sources_tied(spark, sf_dir):
    return plans.top_sources(v.doc_src(spark, sf_dir), TOP_SOURCES_K)


def join_mentions(spark, sf_dir):
    rows = op.join_mentions(v.ment(spark, sf_dir), v.docs(spark, sf_dir))
    return rows.select(
        "mention_id",
        "mention_doc_tone",
        _time(),
        "src_common_name",
        F.array_join("themes", "|").alias("themes"),
    )


def theme_filter(spark, sf_dir):
    cleaned = fn.clean_theme(F.col("code"), v.TAXONOMY).alias("theme")
    return op.filter_to_vocab(_codes(spark, sf_dir).select("doc_id", cleaned), "theme", v.THEMES)


def source_filter(spark, sf_dir):
    docs = v.docs(spark, sf_dir).select("doc_id", "src_common_name")
    top = plans.top_sources(docs, TOP_SOURCES_K).select("src_common_name")
    return op.filter_to_vocab(docs, "src_common_name", top)


def tone_quantiles(spark, sf_dir):
    return _flat(op.tone_stats(v.ev(spark, sf_dir)), THEME_DAY_KEYS, ["quantiles"])


def tone_quantiles_split(spark, sf_dir):
    stats = op.tone_stats(v.ev(spark, sf_dir), leaf=20)
    return _flat(stats, THEME_DAY_KEYS)


def tone_range_sketched(spark, sf_dir):
    """Quantiles over a range of days from daily states, and whether their ranks are close."""
    tones = v.ev(spark, sf_dir)
    daily = written(op.tone_states(tones), "states")
    merged = op.merge_states(daily.where(F.col("time").between(*SKETCHED_DAYS)), ["theme"])
    stats = op.state_stats(merged)
    share = {
        f"{side}{i}": F.avg(tone_is(F.get("quantiles", F.lit(i))).cast("double"))
        for i in range(len(QUANTILE_PROBS))
        for side, tone_is in (
            ("below", lambda q: F.col("mention_doc_tone").cast("float") < q),
            ("upto", lambda q: F.col("mention_doc_tone").cast("float") <= q),
        )
    }
    ranks = (
        tones.where(F.col("time").between(*SKETCHED_DAYS))
        .join(stats.select("theme", "quantiles"), "theme")
        .groupBy("theme")
        .agg(*[column.alias(name) for name, column in share.items()])
    )
    close = F.lit(True)
    for i, p in enumerate(QUANTILE_PROBS):
        close &= (F.col(f"below{i}") <= p + RANK_ERROR) & (F.col(f"upto{i}") >= p - RANK_ERROR)
    rows = stats.join(ranks.select("theme", close.alias("ranks_close")), "theme")
    return _flat(rows, ["theme", "ranks_close"], ["num_mentions", "avg", "bin_vals"])


def tone_histogram(spark, sf_dir):
    tones = v.ev(spark, sf_dir).groupBy(*THEME_DAY_KEYS)
    cells = tones.agg(fn.tone_histogram(F.col("mention_doc_tone")).alias("bin_vals"))
    return _flat(cells, THEME_DAY_KEYS, ["bin_vals"])


def collect_tones(spark, sf_dir):
    tones = op.collect_tones(v.ev(spark, sf_dir), THEME_DAY_KEYS)
    return tones.select("theme", _time(source="time"), "mention_doc_tone", "num_mentions")


def theme_day_tone(spark, sf_dir):
    return _flat(_theme_day(spark, sf_dir), THEME_DAY_KEYS)


def theme_day_tone_increments(spark, sf_dir):
    """The table of a ledger that took the mentions in by four batches, one of them twice."""
    ledger = f"{shared_folder(spark)}/ledger-{uuid.uuid4().hex}"
    mentions = v.ment(spark, sf_dir)
    # Stand-ins for files: each takes the mentions of every fourth document id.
    share = F.pmod(F.col("mention_id").cast("long"), F.lit(4)).cast("string")

    def tones(files):
        batch = mentions.where(share.isin(files))
        return op.theme_tones(batch, v.docs(spark, sf_dir), v.TAXONOMY, v.THEMES)

    for files in (["0"], ["1"], ["1", "2"], ["3", "0"]):
        add_batch(spark, ledger, files, tones)
    return _flat(plans.ledger_stats(read_ledger(spark, ledger)), THEME_DAY_KEYS)


def theme_day_tone_few(spark, sf_dir):
    """Mentions of documents without a wanted theme stay out of the shuffle."""
    stats = plans.theme_tone(
        v.ment(spark, sf_dir), v.docs(spark, sf_dir), v.TAXONOMY, v.THEMES, few_documents=True
    )
    return _flat(stats, THEME_DAY_KEYS)


def mentions_of_some_files(spark, sf_dir):
    """A feed of a file a month, of which those of some months are read."""
    folder = f"{shared_folder(spark)}/feed-{uuid.uuid4().hex}"
    month = F.substring(F.get(F.split("value", "\t"), F.lit(2)), 1, 6)
    lines = v.ment_lines(spark, sf_dir).withColumn("file", F.concat(month, F.lit("01000000")))
    lines.hint("rebalance", "file").write.partitionBy("file").text(folder)
    rows = sources.read_mentions(spark, f"{folder}/file=*", start=FILE_TIMES[0], end=FILE_TIMES[1])
    return rows.select("mention_id", "mention_doc_tone", _time())


def latest_tone_stored(spark, sf_dir):
    """The newest row of each wanted theme, from a stored table read from its end."""
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    sources.write_stats(_theme_day(spark, sf_dir), path)
    rows = op.latest_stored(sources.read_stats(spark, path), v.THEMES)
    return _flat(rows, THEME_DAY_KEYS)


def theme_day_source_tone(spark, sf_dir):
    return _flat(_theme_day_source(spark, sf_dir), THEME_DAY_SOURCE_KEYS)


def theme_day_tone_learned(spark, sf_dir):
    docs = v.docs(spark, sf_dir)
    words = plans.taxonomy_words(docs, TAXONOMY_CUT).select("first_two_themes")
    themes = plans.top_themes(docs, words, TOP_THEMES_K).select("theme")
    stats = plans.theme_day_tone(v.ment(spark, sf_dir), docs, words, themes)
    return _flat(stats, THEME_DAY_KEYS)


def tone_multi_grain(spark, sf_dir):
    stats = op.tone_stats_multi(v.ev(spark, sf_dir))
    return _flat(stats, ["grain", *THEME_DAY_SOURCE_KEYS])


def tone_tables_from_lines(spark, sf_dir):
    stats = plans.tone_tables(
        sources.parse_mentions(v.ment_lines(spark, sf_dir)),
        sources.parse_documents(v.docs_lines(spark, sf_dir)),
        v.TAXONOMY,
        v.THEMES,
        v.SOURCES,
    )
    return _flat(stats, ["grain", *THEME_DAY_SOURCE_KEYS])


def theme_second_tone_raw(spark, sf_dir):
    stats = plans.theme_tone(v.ment(spark, sf_dir, "second"), v.docs(spark, sf_dir))
    return _flat(stats, THEME_DAY_KEYS)


def theme_second_tone_clean(spark, sf_dir):
    stats = plans.theme_tone(
        v.ment(spark, sf_dir, "second"), v.docs(spark, sf_dir), v.TAXONOMY, v.THEMES
    )
    return _flat(stats, THEME_DAY_KEYS)


def tone_evolution(spark, sf_dir):
    return _flat(op.tone_evolution(_theme_day(spark, sf_dir), *EVOLUTION), THEME_DAY_KEYS)


def tone_distribution(spark, sf_dir):
    cells = op.tone_distribution(_theme_day_source(spark, sf_dir), *EVOLUTION)
    return _flat(cells, ["src_common_name"], ["num_mentions", "bin_vals"])


def latest_tone(spark, sf_dir):
    rows = op.latest_tone(_theme_day_source(spark, sf_dir), ["theme", "src_common_name"])
    return _flat(rows, THEME_DAY_SOURCE_KEYS)


def stats_violations(spark, sf_dir):
    rows = v.table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("theme"),
        F.col("l_shipdate").alias("time"),
        (F.col("l_linenumber") - 1).alias("num_mentions"),
        F.nullif("l_tax", F.lit(0.0)).alias("avg"),
    )
    return sources.check_stats(rows, THEME_DAY_KEYS).select(
        "theme", _time(source="time"), "rule", "rows"
    )


QUERIES = (
    parse_mentions,
    parse_documents,
    rejected_lines,
    rejected_lines_second,
    is_number_filter,
    mention_time_second,
    clean_comma,
    first_two_tokens,
    clean_taxonomy,
    explode_themes,
    distinct_themes,
    taxonomy_words,
    taxonomy_words_extra,
    theme_counts,
    top_themes,
    top_sources,
    top_sources_tied,
    join_mentions,
    theme_filter,
    source_filter,
    tone_quantiles,
    tone_quantiles_split,
    tone_range_sketched,
    tone_histogram,
    collect_tones,
    theme_day_tone,
    theme_day_tone_increments,
    theme_day_tone_few,
    mentions_of_some_files,
    latest_tone_stored,
    theme_day_source_tone,
    theme_day_tone_learned,
    tone_multi_grain,
    tone_tables_from_lines,
    theme_second_tone_raw,
    theme_second_tone_clean,
    tone_evolution,
    tone_distribution,
    latest_tone,
    stats_violations,
)


def entry(spark: SparkSession) -> DataFrame:
    """Tone per theme and day on the smallest tables."""
    return theme_day_tone(configure(spark), SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """One callable per operator or job, each over whole tables."""

    def configured(query):
        return lambda spark, sf_dir: query(configure(spark), sf_dir)

    found = {query.__name__: query for query in QUERIES}
    if llm_queries is not None:
        found |= llm_queries.queries()
        found["pipeline"] = corpus_pipeline.run
    return {name: configured(query) for name, query in found.items()}


# -- SQL side ------------------------------------------------------------------


def _sql_list(words: Sequence[str]) -> str:
    return "(" + ", ".join(f"'{word}'" for word in words) + ")"


_DAY = "cast(strptime(raw_time[1:8], '%Y%m%d') as timestamp)"
_SECOND = "strptime(raw_time, '%Y%m%d%H%M%S')"
_SHOW = "strftime(time, '%Y-%m-%d %H:%M:%S') AS time"

_DOCS = """docs AS (
  SELECT cast(p_partkey AS varchar) AS doc_id, p_brand AS src_common_name,
         concat(upper(p_type), '_', replace(p_brand, '#', ''), '_',
                upper(replace(p_name, ' ', '_')), ',7;', upper(p_type),
                ';TAX_', upper(p_type), ';DROPPED') AS raw_themes
  FROM part)"""

_CODES = """codes AS (
  SELECT doc_id, src_common_name, unnest(string_split(raw_themes, ';')[:-2]) AS code
  FROM docs)"""

_MENT = """ment AS (
  SELECT cast(l_orderkey AS varchar) AS event_id, l_linenumber,
         cast(l_suppkey AS varchar) AS mention_src_name,
         cast(l_partkey AS varchar) AS mention_id, (l_quantity - 25) / 2 AS tone,
         concat(strftime(l_shipdate, '%Y%m%d'), lpad(cast(l_linenumber AS varchar), 2, '0'),
                '3015') AS raw_time
  FROM lineitem)"""

_EV = """ev AS (
  SELECT event_type AS theme, date_trunc('day', ts) AS time,
         cast(user_id AS varchar) AS src_common_name, (value - 50) / 5 AS tone
  FROM events)"""

_PARTS = "list_transform(string_split(code, '_'), lambda x: split_part(x, ',', 1))"


def _cleaned(words: str) -> str:
    """CTE ``cleaned``; ``words`` is what may stand behind IN."""
    return f"""cleaned AS (
  SELECT doc_id, src_common_name, code,
         CASE WHEN len({_PARTS}) > 1
              THEN array_to_string(list_filter({_PARTS},
                     lambda x, i: i > 2 OR NOT (x IN {words} OR regexp_matches(x, '[0-9]'))), '_')
              ELSE {_PARTS}[1] END AS theme
  FROM codes)"""


_CLEANED = _cleaned(_sql_list(v.TAXONOMY))


def _stats_sql(parts: Sequence[str] = STATS) -> str:
    step = (HISTOGRAM_HIGH - HISTOGRAM_LOW) / HISTOGRAM_BINS
    out = []
    if "num_mentions" in parts:
        out.append("count(*) AS num_mentions")
    if "avg" in parts:
        out.append("round(avg(tone), 10) AS avg")
    if "quantiles" in parts:
        out += [
            f"round(cast(cast(quantile_cont(tone, {p}) AS float) AS double), 4) AS q{i}"
            for i, p in enumerate(QUANTILE_PROBS)
        ]
    if "bin_vals" in parts:
        out.append(f"count(*) FILTER (WHERE tone < {HISTOGRAM_LOW}) AS b0")
        for i in range(1, HISTOGRAM_BINS + 1):
            low, high = HISTOGRAM_LOW + (i - 1) * step, HISTOGRAM_LOW + i * step
            out.append(f"count(*) FILTER (WHERE tone >= {low} AND tone < {high}) AS b{i}")
        out.append(f"count(*) FILTER (WHERE tone > {HISTOGRAM_HIGH}) AS b{HISTOGRAM_BINS + 1}")
    return ",\n       ".join(out)


def _joined(time: str, source: str = "cleaned", theme: str = "theme", where: str = "true") -> str:
    """CTE ``joined``: one row per mention and theme occurrence."""
    return f"""joined AS (
  SELECT c.{theme} AS theme, {time} AS time, c.src_common_name, m.tone
  FROM ment m JOIN {source} c ON m.mention_id = c.doc_id
  WHERE {where})"""


_IN_THEMES = f"c.theme IN {_sql_list(v.THEMES)}"
_IN_SOURCES = f"c.src_common_name IN {_sql_list(v.SOURCES)}"


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


_BASE = (_DOCS, _CODES, _CLEANED, _MENT)
_THEME_DAY = f"""theme_day AS (
  SELECT theme, time, {_stats_sql()} FROM joined GROUP BY theme, time)"""
_THEME_DAY_SOURCE = f"""theme_day_source AS (
  SELECT theme, time, src_common_name, {_stats_sql()}
  FROM joined GROUP BY theme, time, src_common_name)"""
_DAY_CTES = (*_BASE, _joined(_DAY, where=_IN_THEMES), _THEME_DAY)
_DAY_SOURCE_CTES = (
    *_BASE,
    _joined(_DAY, where=f"{_IN_THEMES} AND {_IN_SOURCES}"),
    _THEME_DAY_SOURCE,
)
_VALUES = ", ".join(
    ["num_mentions", "avg", *[f"q{i}" for i in range(5)], *[f"b{i}" for i in range(CELLS)]]
)
_IN_RANGE = (
    f"theme = '{EVOLUTION[0]}' AND time >= timestamp '{EVOLUTION[1]}' "
    f"AND time < timestamp '{EVOLUTION[2]}'"
)
_TAXONOMY_SQL = f"""words AS (
  SELECT word AS first_two_themes, count(*) AS count
  FROM (SELECT unnest({_PARTS}[1:2]) AS word
        FROM (SELECT DISTINCT code FROM codes) d WHERE len({_PARTS}) > 1) w
  WHERE NOT regexp_matches(word, '[0-9]')
  GROUP BY word HAVING count(*) >= {TAXONOMY_CUT})"""
_TOP_THEMES_SQL = f"""top AS (
  SELECT theme, num_mentions, rank
  FROM (SELECT theme, count(*) AS num_mentions, rank() OVER (ORDER BY count(*) DESC) AS rank
        FROM cleaned GROUP BY theme) r
  WHERE rank <= {TOP_THEMES_K} AND theme <> '')"""


def _top_sources_sql(table: str) -> str:
    return f"""top_sources AS (
  SELECT src_common_name, count, rank
  FROM (SELECT src_common_name, count(*) AS count, rank() OVER (ORDER BY count(*) DESC) AS rank
        FROM {table} GROUP BY src_common_name) r
  WHERE rank <= {TOP_SOURCES_K} AND src_common_name <> '')"""


_DOC_SRC = "doc_src AS (SELECT source AS src_common_name FROM documents)"
_LINE = """concat_ws(chr(9), event_id, raw_time[1:8], raw_time, 'x', mention_src_name, mention_id,
         'x', 'x', 'x', 'x', 'x', 'x', 'x',
         CASE WHEN l_linenumber = 6 THEN 'n/a' ELSE cast(tone AS varchar) END, 'x',
         CASE WHEN l_linenumber <> 7 THEN 'x' END)"""


def oracle_sql() -> dict[str, str]:
    """The same results in DuckDB SQL over the same tables."""
    ev_groups = "FROM ev GROUP BY theme, time"
    good_lines = "ment_good AS (SELECT * FROM ment WHERE l_linenumber NOT IN (6, 7))"
    from_lines = _joined(_DAY, where=_IN_THEMES).replace("FROM ment m", "FROM ment_good m")
    found = {} if llm_queries is None else llm_queries.oracle_sql()
    return found | {
        "parse_mentions": _with(_MENT)
        + f"""SELECT mention_id, tone AS mention_doc_tone, {_SHOW}
FROM (SELECT *, {_DAY} AS time FROM ment WHERE l_linenumber NOT IN (6, 7))""",
        "parse_documents": _with(_DOCS)
        + """SELECT doc_id, src_common_name,
       array_to_string(string_split(raw_themes, ';')[:-2], '|') AS themes FROM docs""",
        "rejected_lines": _with(_MENT)
        + f"""SELECT {_LINE} AS line, CASE l_linenumber WHEN 7 THEN 'width' ELSE 'tone' END AS reason
FROM ment WHERE l_linenumber IN (6, 7)""",
        "rejected_lines_second": _with(_MENT)
        + f"""SELECT replace({_LINE}, raw_time, bad_time) AS line,
       CASE l_linenumber WHEN 7 THEN 'width' WHEN 6 THEN 'tone' ELSE 'time' END AS reason
FROM (SELECT *, CASE l_linenumber WHEN 4 THEN concat(raw_time[1:8], '996015')
                WHEN 5 THEN raw_time[1:8] ELSE raw_time END AS bad_time FROM ment)
WHERE l_linenumber IN (4, 5, 6, 7)""",
        "is_number_filter": """WITH texts AS (
  SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN q WHEN 2 THEN concat(' -', q, '. ')
         WHEN 3 THEN concat(q, 'e2') WHEN 4 THEN concat(q, 'd') WHEN 5 THEN concat('0x', q)
         WHEN 6 THEN concat('.', q) ELSE 'n/a' END AS txt
  FROM (SELECT l_orderkey, l_linenumber, cast(cast(l_quantity AS int) AS varchar) AS q FROM lineitem))
SELECT l_orderkey, l_linenumber, txt, try_cast(trim(txt) AS double) AS num
FROM texts WHERE try_cast(trim(txt) AS double) IS NOT NULL""",
        "mention_time_second": _with(_MENT)
        + f"SELECT event_id, raw_time, {_SHOW} FROM (SELECT *, {_SECOND} AS time FROM ment)",
        "clean_comma": _with(_DOCS)
        + """SELECT doc_id, split_part(string_split(raw_themes, ';')[1], ',', 1) AS first_code,
       array_to_string(list_transform(string_split(raw_themes, ';')[:-2],
                                      lambda x: split_part(x, ',', 1)), '|') AS codes
FROM docs""",
        "first_two_tokens": _with(_DOCS, _CODES)
        + """SELECT doc_id, code, array_to_string(string_split(code, '_')[1:2], '|') AS first_two,
       len(string_split(code, '_')) AS tokens, NOT regexp_matches(code, '[0-9]') AS no_digit
FROM codes""",
        "clean_taxonomy": _with(_DOCS, _CODES, _CLEANED)
        + """SELECT d.doc_id, array_to_string([a.theme, b.theme, c.theme], '|') AS themes
FROM docs d
JOIN cleaned a ON a.doc_id = d.doc_id AND a.code = string_split(d.raw_themes, ';')[1]
JOIN cleaned b ON b.doc_id = d.doc_id AND b.code = string_split(d.raw_themes, ';')[2]
JOIN cleaned c ON c.doc_id = d.doc_id AND c.code = string_split(d.raw_themes, ';')[3]""",
        "explode_themes": _with(_DOCS, _CODES) + "SELECT doc_id, code FROM codes",
        "distinct_themes": _with(_DOCS, _CODES) + "SELECT DISTINCT code AS theme FROM codes",
        "taxonomy_words": _with(_DOCS, _CODES, _TAXONOMY_SQL) + "SELECT * FROM words",
        "taxonomy_words_extra": _with(_DOCS, _CODES, _TAXONOMY_SQL)
        + f"""SELECT * FROM words
UNION ALL SELECT word, 0 FROM (SELECT unnest([{", ".join(f"'{w}'" for w in MANUAL_TAXONOMY_WORDS)}]) AS word)
WHERE word NOT IN (SELECT first_two_themes FROM words)""",
        "theme_counts": _with(_DOCS, _CODES, _CLEANED)
        + "SELECT theme, count(*) AS num_mentions FROM cleaned GROUP BY theme",
        "top_themes": _with(_DOCS, _CODES, _CLEANED, _TOP_THEMES_SQL) + "SELECT * FROM top",
        "top_sources": _with(_DOCS, _top_sources_sql("docs")) + "SELECT * FROM top_sources",
        "top_sources_tied": _with(_DOC_SRC, _top_sources_sql("doc_src"))
        + "SELECT * FROM top_sources",
        "join_mentions": _with(_DOCS, _MENT)
        + f"""SELECT mention_id, mention_doc_tone, {_SHOW}, src_common_name, themes
FROM (SELECT mention_id, tone AS mention_doc_tone, {_DAY} AS time, src_common_name,
             array_to_string(string_split(raw_themes, ';')[:-2], '|') AS themes
      FROM ment JOIN docs ON mention_id = doc_id)""",
        "theme_filter": _with(_DOCS, _CODES, _CLEANED)
        + f"SELECT doc_id, theme FROM cleaned WHERE theme IN {_sql_list(v.THEMES)}",
        "source_filter": _with(_DOCS, _top_sources_sql("docs"))
        + """SELECT doc_id, src_common_name FROM docs
WHERE src_common_name IN (SELECT src_common_name FROM top_sources)""",
        "tone_quantiles": _with(_EV)
        + f"SELECT theme, {_SHOW}, {_stats_sql(['quantiles'])} {ev_groups}",
        "tone_quantiles_split": _with(_EV) + f"SELECT theme, {_SHOW}, {_stats_sql()} {ev_groups}",
        "tone_histogram": _with(_EV)
        + f"SELECT theme, {_SHOW}, {_stats_sql(['bin_vals'])} {ev_groups}",
        "tone_range_sketched": _with(_EV)
        + f"""SELECT theme, true AS ranks_close, {_stats_sql(("num_mentions", "avg", "bin_vals"))}
FROM ev WHERE time BETWEEN '{SKETCHED_DAYS[0]}' AND '{SKETCHED_DAYS[1]}' GROUP BY theme""",
        "collect_tones": _with(_EV)
        + f"""SELECT theme, {_SHOW}, tone AS mention_doc_tone, count(*) AS num_mentions
{ev_groups}, tone""",
        "theme_day_tone": _with(*_DAY_CTES) + f"SELECT theme, {_SHOW}, {_VALUES} FROM theme_day",
        "theme_day_tone_increments": _with(*_DAY_CTES)
        + f"SELECT theme, {_SHOW}, {_VALUES} FROM theme_day",
        "theme_day_tone_few": _with(*_DAY_CTES) + f"SELECT theme, {_SHOW}, {_VALUES} FROM theme_day",
        "mentions_of_some_files": _with(_MENT)
        + f"""SELECT mention_id, tone AS mention_doc_tone, {_SHOW}
FROM (SELECT *, {_DAY} AS time FROM ment WHERE l_linenumber NOT IN (6, 7))
WHERE time >= timestamp '{FILE_TIMES[0]}' AND time < timestamp '{FILE_TIMES[1]}'""",
        "latest_tone_stored": _with(*_DAY_CTES)
        + f"""SELECT theme, {_SHOW}, {_VALUES} FROM theme_day
QUALIFY row_number() OVER (PARTITION BY theme ORDER BY time DESC) = 1""",
        "theme_day_source_tone": _with(*_DAY_SOURCE_CTES)
        + f"SELECT theme, {_SHOW}, src_common_name, {_VALUES} FROM theme_day_source",
        "theme_day_tone_learned": _with(
            _DOCS,
            _CODES,
            _TAXONOMY_SQL,
            # A subquery cannot stand inside a lambda, so the words go in as a list.
            "word_list AS (SELECT list(first_two_themes) AS taxonomy FROM words)",
            _cleaned("(SELECT 1)")
            .replace("x IN (SELECT 1)", "list_contains(taxonomy, x)")
            .replace("FROM codes)", "FROM codes, word_list)"),
            _MENT,
            _TOP_THEMES_SQL,
            _joined(_DAY, where="c.theme IN (SELECT theme FROM top)"),
            _THEME_DAY,
        )
        + f"SELECT theme, {_SHOW}, {_VALUES} FROM theme_day",
        "tone_multi_grain": _with(_EV)
        + f"""SELECT CASE grouping(src_common_name) WHEN 0 THEN 'theme_day_source'
            ELSE 'theme_day' END AS grain, theme, {_SHOW}, src_common_name, {_stats_sql()}
FROM ev GROUP BY GROUPING SETS ((theme, time), (theme, time, src_common_name))""",
        "tone_tables_from_lines": _with(*_BASE, good_lines, from_lines)
        + f"""SELECT 'theme_day' AS grain, theme, {_SHOW}, NULL AS src_common_name, {_stats_sql()}
FROM joined GROUP BY theme, time
UNION ALL
SELECT 'theme_day_source', theme, {_SHOW}, src_common_name, {_stats_sql()}
FROM joined c WHERE {_IN_SOURCES} GROUP BY theme, time, src_common_name""",
        "theme_second_tone_raw": _with(
            _DOCS, _CODES, _MENT, _joined(_SECOND, "codes", "code"), _THEME_DAY
        )
        + f"SELECT theme, {_SHOW}, {_VALUES} FROM theme_day",
        "theme_second_tone_clean": _with(*_BASE, _joined(_SECOND, where=_IN_THEMES), _THEME_DAY)
        + f"SELECT theme, {_SHOW}, {_VALUES} FROM theme_day",
        "tone_evolution": _with(*_DAY_CTES)
        + f"SELECT theme, {_SHOW}, {_VALUES} FROM theme_day WHERE {_IN_RANGE}",
        "tone_distribution": _with(*_DAY_SOURCE_CTES)
        + f"""SELECT src_common_name, cast(sum(num_mentions) AS bigint) AS num_mentions,
       {", ".join(f"cast(sum(b{i}) AS bigint) AS b{i}" for i in range(CELLS))}
FROM theme_day_source WHERE {_IN_RANGE} GROUP BY src_common_name""",
        "latest_tone": _with(*_DAY_SOURCE_CTES)
        + f"""SELECT theme, {_SHOW}, src_common_name, {_VALUES} FROM theme_day_source
QUALIFY row_number() OVER (PARTITION BY theme, src_common_name ORDER BY time DESC) = 1""",
        "stats_violations": """WITH per_key AS (
  SELECT l_partkey AS theme, l_shipdate AS time, count(*) AS copies,
         count(*) FILTER (WHERE l_tax = 0) AS nulls,
         count(*) FILTER (WHERE l_linenumber - 1 <= 0) AS low
  FROM lineitem GROUP BY l_partkey, l_shipdate),
found AS (
  SELECT theme, time, 'null' AS rule, nulls AS "rows" FROM per_key WHERE nulls > 0
  UNION ALL SELECT theme, time, 'not_positive', low FROM per_key WHERE low > 0
  UNION ALL SELECT theme, time, 'duplicate', copies FROM per_key WHERE copies > 1)
SELECT theme, strftime(time, '%Y-%m-%d %H:%M:%S') AS time, rule, "rows" FROM found""",
    }
