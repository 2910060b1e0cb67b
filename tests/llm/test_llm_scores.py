"""Mixing, quality, URL and toxicity operators, and the pipeline, against plain Python."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tonetide.llm import mixing, quality_llr, toxicity_kn, url_templates
from tonetide.llm.common import prepare

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# -- mixing ------------------------------------------------------------------------


def brute_targets(sizes):
    """Share out by weight, stopping full sources one after the other."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, target, free = sum(sizes.values()), {}, set(order)
    while free:
        left = total - sum(target.values())
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if weight[s] * level > 3 * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in free}
        target |= {s: 3.0 * sizes[s] for s in full}
        free -= full
    return target


def check_mix(rows, out):
    sizes = Counter()
    for r in rows:
        sizes[r.source] += len(WORD.findall(r.text or ""))
    target = brute_targets(dict(sizes))
    of = {r.doc_id: r.source for r in rows}
    taken = Counter()
    assert len(out) == len(rows)
    for r in out:
        s = of[r.doc_id]
        assert r.source_size == sizes[s] and r.target == pytest.approx(target[s])
        assert 0 <= r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
        taken[s] += r.taken
    largest = defaultdict(int)
    for r in out:
        largest[of[r.doc_id]] = max(largest[of[r.doc_id]], r.size)
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(2 * largest[s], sizes[s] / 100), s


def test_mix_on_the_driver_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    first = mixing.taken_words(docs).collect()
    check_mix(docs.collect(), first)
    assert sorted(first) == sorted(mixing.taken_words(docs.repartition(7)).collect())


def test_mix_edges(spark):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randrange(1, 50), rng.choice(["a", "b", "é", None, ""]), 1) for i in range(300)]
    rows += [(300, None, "a", 1), (301, "", "empty", 1), (302, " \n", "empty", 1), (303, "x", "tiny", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    check_mix(docs.collect(), mixing.taken_words(docs).collect())
    assert mixing.taken_words(docs.limit(0)).collect() == []
    rows = [(1, "a b", "s"), (1, "a b", "s"), (None, "c", "s"), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert len(mixing.taken_words(docs).collect()) == 4


def test_units_are_dealt_once_and_evenly(spark, sf_dir):
    mix = mixing.plan_mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    units = mix.units.collect()
    assert len({(u.key, u.block, u.copy) for u in units}) == len(units)
    wanted = {(b.key, b.block): b.copies for b in mix.blocks.collect() if b.copies}
    assert Counter((u.key, u.block) for u in units) == wanted
    per_shard = Counter(u.shard for u in units)
    assert len(per_shard) == 64 and max(per_shard.values()) - min(per_shard.values()) <= 6


def test_hypergeometric_draws_follow_the_distribution(spark):
    k, n, draws = 30, 100, 40
    draw = mixing._hypergeometric(f"{k}L", f"{n}L", f"{draws}L", "u")
    rows = spark.range(1000).select(((F.col("id") + 0.5) / 1000).alias("u")).select(F.expr(draw).alias("x"))
    got = [r.x for r in rows.collect()]
    chance = [math.comb(k, x) * math.comb(n - k, draws - x) / math.comb(n, draws) for x in range(k + 1)]
    upto = np.cumsum(chance)
    want = [int(np.searchsorted(upto, (i + 0.5) / 1000)) for i in range(1000)]
    assert got == want
    edges = spark.sql(f"SELECT {mixing._hypergeometric('0L', '5L', '3L', '0.5D')} a, {mixing._hypergeometric('5L', '5L', '3L', '0.5D')} b, {mixing._hypergeometric('2L', '4L', '0L', '0.9D')} c")
    assert tuple(edges.first()) == (0, 3, 0)


# -- quality ------------------------------------------------------------------------


def brute_base(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(runs)
    repeat = {i + k for i, r in enumerate(runs) if count[r] > 1 for k in range(5)}
    failed = len(words) < 10 or 100 * len(repeat) > 20 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        sum(text.count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(repeat),
        failed,
    )


def base(r):
    return (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)


def test_quality_on_the_driver_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = {r.doc_id: r for r in quality_llr.judge(docs, labels.where("quality = 1")).collect()}
    good = bad = kept_good = kept_bad = 0
    quality = {r.doc_id: r.quality for r in labels.collect()}
    for row in docs.collect():
        r = out[row.doc_id]
        assert base(r) == brute_base(row.text)
        assert r.kept == (not r.base_failed and r.score >= quality_llr.THRESHOLD)
        if not r.base_failed and row.doc_id in quality:
            good += quality[row.doc_id] == 1
            kept_good += quality[row.doc_id] == 1 and r.kept
            bad += quality[row.doc_id] == 0
            kept_bad += quality[row.doc_id] == 0 and r.kept
    assert kept_good >= 0.99 * good and kept_bad <= 0.2 * bad


def test_quality_edges(spark):
    rng = random.Random(2)
    texts = [None, "", " \n\t", "one", "a\n\na\n \na b", "# % <>|é", "x " * 9, "x " * 4000, "a b c d e " * 2]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(60))) for _ in range(150)]
    texts += ["é\u00a0ü \u2028 x\x0by\x0cz \x1c"]
    docs = spark.createDataFrame(
        [(i, t, 1) for i, t in enumerate(texts)] + [(None, "x", 1)], "doc_id long, text string, h int"
    )
    trusted = spark.createDataFrame([(3,), (None,), (3,)], "doc_id long")
    out = {r.doc_id: base(r) for r in quality_llr.judge(docs, trusted).collect()}
    assert out == {i: brute_base(t) for i, t in enumerate(texts)} | {None: brute_base("x")}
    assert quality_llr.judge(docs.limit(0), trusted.limit(0)).collect() == []


# -- urls ---------------------------------------------------------------------------


def brute_url(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [
        r
        for r in url_templates.RULES
        if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return host, path, max(fits, key=lambda r: len(r.name), default=None)


def test_urls(spark, sf_dir):
    odd = [None, "", "no scheme", "http://", "x://EXAMPLE.com", "x://a.Example.COM/en/1?q#f", "x://wwwexample.com/en/",
           "x://www.example.com/en/a", "x://m.www.example.com/en/", "x://net/es/", "x://a.net/fr", "x://b.net/fr/",
           "x://a.org?://net/es/", "x://a.org/a//b/c/d/e/f/g", "://É.com/ü", "x://h:80/p#?", "x://y.com\n/z"]
    table = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    extra = spark.createDataFrame([(-1 - i, u) for i, u in enumerate(odd)] + [(None, "x://a.net/es/")], table.schema)
    pages = table.union(extra)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = url_templates.judge(pages.withColumn("host", F.lit(1)), labels).collect()
    want = Counter((p.page_id, *brute_url(p.url)[:2]) for p in pages.collect())
    assert Counter((r.page_id, r.host, r.path) for r in out) == want
    urls = {p.page_id: p.url for p in pages.collect()}
    for r in out:
        rule = brute_url(urls[r.page_id])[2]
        assert r.rule == (rule and rule.name)
        assert r.verdict == (rule.verdict if rule else "block" if r.purity < url_templates.PURITY else "allow")
    assert url_templates.judge(pages.limit(0), labels.limit(0)).collect() == []


def test_impure_branches_are_rejected_and_variable_segments_merge(spark):
    rows, marks = [], []
    for i in range(400):
        branch = ("spam", "news", "blog")[i % 3]
        rows.append((i, f"http://a.org/{branch}/{i}"))
        marks.append((i, 0 if branch == "spam" else 1))
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    out = url_templates.judge(pages, labels).collect()
    assert {(r.path.split("/")[1], r.template, r.verdict) for r in out} >= {("spam", "/spam/*", "block")}
    assert {r.verdict for r in out if "/spam/" not in r.path} == {"allow"}
    same = url_templates.judge(pages, labels.withColumn("quality", F.lit(1))).collect()
    assert {r.template for r in same} == {"/*/*"}


# -- toxicity ------------------------------------------------------------------------


def test_toxicity_result_form(spark, sf_dir):
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = {r.doc_id: r for r in toxicity_kn.score(spark, docs, labels).collect()}
    assert len(out) == docs.count()
    for r in out.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)


def test_toxicity_accuracy_on_held_out_documents(spark):
    """At scale 0.1, whose fitting folds hold 300 toxic documents."""
    prepare(spark)
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = {r.doc_id: r for r in toxicity_kn.score(spark, docs, labels).collect()}
    marked = [(out[r.doc_id], r.toxic) for r in labels.collect() if out[r.doc_id].held_out]
    toxic, clean = ([r for r, t in marked if t == c] for c in (1, 0))
    auc = np.mean([(a.score > b.score) + 0.5 * (a.score == b.score) for a in toxic for b in clean])
    assert auc > 0.9
    assert np.mean([r.predicted for r in toxic]) > 0.6 and np.mean([r.predicted for r in clean]) < 0.03


def test_toxicity_ignores_held_out_labels_and_takes_odd_rows(spark):
    prepare(spark)
    rng = random.Random(3)
    calm, rude = ["table", "garden", "window", "river"], ["vilefoo", "vilebar"]
    rows = []
    for i in range(300):
        bad = i % 4 == 0
        words = [rng.choice(calm) + rng.choice("abc") for _ in range(30)]
        if bad:
            words[rng.randrange(30)] = rng.choice(rude)
        rows.append((i, " ".join(words), "x", int(bad)))
    docs = spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, score string")
    odd = [(900, None, ""), (901, "", ""), (902, "12 %", ""), (None, "vilefoo", ""), (903, "vilebaz " * 30_000, ""), (903, "vilebaz " * 30_000, "")]
    docs = docs.union(spark.createDataFrame(odd, docs.schema))
    labels = spark.createDataFrame([(r[0], r[3]) for r in rows] + [(None, 1), (5, None)], "doc_id long, toxic int")
    turned = labels.withColumn(
        "toxic", F.when(toxicity_kn.remainder(F.col("doc_id")) == 1, 1 - F.col("toxic")).otherwise(F.col("toxic"))
    )
    one = toxicity_kn.score(spark, docs, labels).collect()
    two = toxicity_kn.score(spark, docs, turned).collect()
    key = lambda r: (r.doc_id is None, r.doc_id)
    assert sorted(one, key=key) == sorted(two, key=key) and len(one) == 306
    score = {r.doc_id: r.score for r in one}
    assert 0.7 > score[901] == score[900] == score[902]
    nothing = toxicity_kn.score(spark, docs, labels.limit(0)).collect()
    assert {r.score for r in nothing} == {0.0}
    assert toxicity_kn.score(spark, docs.limit(0), labels).collect() == []


def test_toxicity_of_an_unseen_word_with_a_toxic_beginning(spark):
    prepare(spark)
    rng = random.Random(3)
    calm, rude = ["table", "garden", "window", "river"], ["vilefoo", "vilebar"]
    rows = []
    for i in range(300):
        words = [rng.choice(calm) + rng.choice("abc") for _ in range(30)]
        if i % 4 == 0:
            words[rng.randrange(30)] = rng.choice(rude)
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    rows.append((903, "vilebaz " * 30_000, None))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    out = toxicity_kn.score(spark, table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    assert out.where("doc_id = 903").first().score > 0.7


def test_toxicity_finds_marked_documents_and_leaves_clean_ones(spark):
    prepare(spark)
    rng = random.Random(7)
    calm = [a + b + c for a in ("gar", "win", "riv", "tab") for b in "aeiou" for c in ("den", "dow", "er", "le")]
    rude = ["vilefoo", "vilebar", "vilebaz", "vilequx"]
    rows = []
    for i in range(900):
        words = [rng.choice(calm) + rng.choice("abcdefgh") for _ in range(rng.randrange(20, 400))]
        for k in range(0, len(words) if i % 6 == 0 else 0, 40):
            words[k] = rng.choice(rude)
        rows.append((i, " ".join(words), int(i % 6 == 0)))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    out = toxicity_kn.score(spark, table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    held = out.where("held_out").join(table, "doc_id").collect()
    toxic, clean = ([r.predicted for r in held if r.toxic == c] for c in (1, 0))
    assert np.mean(toxic) > 0.9
    assert np.mean(clean) < 0.01


def test_toxicity_model_by_hand():
    """A word of a tenth of the documents is left to its beginning, this to the shared counts."""
    toxic, ordinary = toxicity_kn.Counts(), toxicity_kn.Counts()
    toxic.documents, toxic.sums = 100, {0: 100, 4: 50}
    toxic.words = {"bad": 50, "so": 40, "oddly": 10, "oddl*": 30, "rest*": 20}
    ordinary.documents, ordinary.sums = 200, {0: 200, 4: 100}
    ordinary.words = {"so": 80, "all": 120, "rest*": 100}
    shared = {"bad": 0.2, "so": 0.4, "oddly": 0.1, "all": 0.3, "oddl*": 0.2, "rest*": 0.8}
    model = toxicity_kn.Model(toxic, ordinary, shared, 0.1)
    # Words: 10 toxic documents off each leave 0.3 to the lower order. Ordinary counts are
    # halved to 40 and 60; 15 off each leave the same.
    assert model.words["bad"] == pytest.approx(math.log((0.4 + 0.3 * 0.2) / (0.3 * 0.2)))
    assert model.words["so"] == pytest.approx(math.log((0.3 + 0.3 * 0.4) / (0.25 + 0.3 * 0.4)))
    # Beginnings: 10 off each leave 0.4; ordinary counts are halved to 50, 20 off leave the same.
    stem = math.log((0.4 + 0.4 * 0.2) / (0.4 * 0.2))
    assert model.words["oddl*"] == pytest.approx(stem)
    assert "oddly" not in model.words
    assert model.gain("oddly") == model.gain("oddlings") == pytest.approx(stem)
    assert model.gain("odd") == model.gain("unheard") == 0
    x = toxicity_kn.features([model], "Bad bad new")
    assert x[0] == pytest.approx(model.words["bad"]) and x[1] == pytest.approx(model.words["bad"] / 2)


# -- pipeline ------------------------------------------------------------------------


def test_stages_one_by_one(spark, sf_dir):
    """Each stage on what the one before it kept, its decisions compared with its operator."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(300)
    columns = docs.columns
    toxic = corpus_pipeline.toxicity(spark, docs, sf_dir).persist()
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    bad = {r.doc_id for r in toxicity_kn.score(spark, docs, labels).collect() if r.predicted}
    assert bad and {r.doc_id for r in toxic.collect()} == {r.doc_id for r in docs.collect()} - bad
    unique = corpus_pipeline.minhash_near_dedup(spark, toxic, sf_dir).persist()
    assert 0 < unique.count() <= toxic.count() and unique.columns == columns
    cut = corpus_pipeline.substring_dedup_stage(spark, unique, sf_dir).persist()
    assert cut.count() == unique.count() and cut.columns == columns
    before = {r.doc_id: r.text for r in unique.collect()}
    assert all(len(r.text) <= len(before[r.doc_id]) and r.n_chars == len(r.text) for r in cut.collect())
    mixed = corpus_pipeline.source_mix(spark, cut, sf_dir).persist()
    plan = {r.doc_id: r.taken // r.size for r in mixing.taken_words(cut).collect() if r.size and r.taken}
    assert Counter(r.doc_id for r in mixed.collect()) == plan and mixed.columns == columns
    out = corpus_pipeline.bpe_merge_replay(spark, mixed, sf_dir)
    assert out.count() == mixed.count()
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


def test_near_dedup_stage_keeps_rows_without_an_id(spark):
    docs = spark.createDataFrame(
        [(1, "a b c d e f", "en", "s", 1), (2, "a b c d e f", "en", "s", 1), (None, "a b", "en", "s", 1), (None, "c", "en", "s", 1)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    kept = corpus_pipeline.minhash_near_dedup(spark, docs, "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == [(0, "a b"), (0, "c"), (1, "a b c d e f")]
