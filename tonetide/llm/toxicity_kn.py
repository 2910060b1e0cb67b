"""Toxicity from class-conditional Kneser-Ney models of words and their beginnings.

Words are runs of letters in lower case. An interpolated model with absolute
discounting gives the chance of a word after the one before it, once as counted in
toxic and once in ordinary documents. A pair falls back on the word, the word on its
first six letters, these on the first five and four, and the last on counts that both
classes share and that come from the whole corpus: an unseen form of a familiar stem is
judged by the stem. As in the lower orders of such models, counts are numbers of
contexts, not of tokens: a context is a document, so a word repeated inside one counts
once.

The discount is in documents, a share of the smaller class: what is met in fewer
documents is smoothed away into the next lower order, down to the shared counts. Counts
of the larger class are brought to the size of the smaller one, and its discount is set
so that both pass on the same mass. A word that neither class knows, nor its beginning,
is then evidence for neither.

A document scores the mean difference of the two log-likelihoods over its most telling
distinct words, each at its first use: the mean over all words drowns a few insults in
the small differences of hundreds of other words (on the folds used for fitting, at scale
0.1, it found none to 49% of the toxic documents, the mean over two words 84%). A logistic
curve fitted on other labelled documents turns that into a chance; they also choose the
discount and the number of words. Evidence against toxicity counts as none.
Counting over the corpus and scoring run on all documents; the class models come from a
bounded sample of labelled rows (FIT_ROWS of either class), so what is broadcast is
bounded by that sample.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonetide.llm.common import keep, pieces

# Labelled documents per class that the class models are fitted on, and in all that
# the curve is fitted on: those with the smallest hashes.
FIT_ROWS = 2_000
CURVE_ROWS = 6_000
# Discounts to choose from, as shares of the documents of the smaller class.
DISCOUNTS = (0.01, 0.02, 0.05, 0.1, 0.2)
# Numbers of most telling words to choose from; a text with fewer is filled up with zeros.
TELLING = (1, 2, 3, 5, 10)
# Letters of the beginnings a word falls back on, and the mark behind them.
BEGINNINGS = (4, 5, 6)
MARK = "*"
PREDICT = 0.7

LETTERS = r"[^\x00-\x60\x7b-\x7f]+"


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def parent(gram: str) -> str | None:
    """What a word or a beginning falls back on."""
    letters = len(gram.rstrip(MARK)) - 1
    if letters < BEGINNINGS[0]:
        return None
    return gram[: min(letters, BEGINNINGS[-1])] + MARK


def _beginnings(words: Column, letters: int) -> Column:
    longer = F.filter(words, lambda word: F.length(word) > letters)
    return F.transform(longer, lambda word: F.concat(F.substring(word, 1, letters), F.lit(MARK)))


def _documents_with(docs: DataFrame, pairs: bool, *keys: str) -> DataFrame:
    """In how many documents (``n``) a word or beginning is, or a pair ``before word``."""
    found = docs.select(*keys, F.regexp_extract_all(F.lower("text"), F.lit(LETTERS), F.lit(0)).alias("words"))
    grams = F.array_distinct("words")
    if pairs:
        before = F.concat(F.array(F.lit("")), F.col("words"))
        grams = F.zip_with("words", before, lambda word, v: F.concat(v, F.lit(" "), word))
        # The last word is nobody's history here.
        grams = F.filter(grams, lambda gram: gram.isNotNull())
    else:
        grams = F.concat(grams, *[_beginnings(grams, n) for n in BEGINNINGS])
    return (
        found.select(*keys, F.explode(F.array_distinct(grams)).alias("gram"))
        .groupBy(*keys, "gram")
        .agg(F.count("*").alias("n"))
    )


def level(gram: str) -> int:
    """0 for whole words, else the letters of a beginning."""
    return len(gram) - 1 if gram.endswith(MARK) else 0


class Counts:
    """Counts of one class; those of a single document are only summed up."""

    def __init__(self) -> None:
        self.documents = 0
        self.words: dict[str, int] = {}
        # Per level, over all words or beginnings.
        self.sums: dict[int, int] = {}
        self.pairs: dict[tuple[str, str], int] = {}
        self.pair_sums: dict[str, int] = {}


def _mass(words: np.ndarray, total: float, discount: float) -> float:
    """What a discount leaves for the shared counts."""
    return 1 - float(np.maximum(words - discount, 0).sum()) / total


class Model:
    """Logarithms of how much likelier words and pairs are in toxic text."""

    def __init__(self, toxic: Counts, ordinary: Counts, shared: dict[str, float], share: float):
        classes = (toxic, ordinary)
        known = toxic.words.keys() | ordinary.words.keys()
        # The chance of each known word and beginning in either class.
        chances: dict[str, tuple[float, float]] = {}
        self.words = {}
        for size in (*BEGINNINGS, 0):
            grams = [g for g in known if level(g) == size]
            sums = [c.sums.get(size, 0) for c in classes]
            if not grams or not all(sums):
                continue
            least = min(sums)
            scale = [least / n for n in sums]
            small = 0 if sums[0] == least else 1
            counts = [
                np.array([n for g, n in c.words.items() if level(g) == size], float) * z
                for c, z in zip(classes, scale)
            ]
            discount = [max(1.0, share * classes[small].documents)] * 2
            mass = _mass(counts[small], least, discount[small])
            low, high = 0.0, float(counts[1 - small].max(initial=0.0))
            for _ in range(60):
                middle = (low + high) / 2
                if _mass(counts[1 - small], least, middle) < mass:
                    low = middle
                else:
                    high = middle
            discount[1 - small] = high
            fall = [_mass(n, least, d) for n, d in zip(counts, discount)]
            rest = math.log(fall[0] / fall[1])
            for gram in grams:
                lower = self._lower(gram, chances, shared)
                p = tuple(
                    max(classes[c].words.get(gram, 0) * scale[c] - discount[c], 0.0) / least
                    + fall[c] * lower[c]
                    for c in (0, 1)
                )
                chances[gram] = (p[0], p[1] * math.exp(rest))
                own = math.log(p[0] / p[1]) - rest
                if abs(own - self.gain(parent(gram))) > 1e-12:
                    self.words[gram] = own
        # For pairs: those of whole words, as left by the last level.
        if not all(c.sums.get(0, 0) for c in classes):
            scale, discount = [1.0, 1.0], [math.inf, math.inf]
        over: tuple[dict, dict] = ({}, {})
        kept = []
        for c in (0, 1):
            for pair, n in classes[c].pairs.items():
                n = n * scale[c] - discount[c]
                if n > 0:
                    kept.append(pair)
                    over[c][pair[0]] = over[c].get(pair[0], 0.0) + n
        # What a history passes on to the word.
        left: dict[str, list[float]] = {}
        for v in over[0].keys() | over[1].keys():
            left[v] = [
                1 - over[c].get(v, 0.0) / (classes[c].pair_sums[v] * scale[c]) if v in over[c] else 1.0
                for c in (0, 1)
            ]
        self.pairs = {}
        for v, word in kept:
            p = []
            for c in (0, 1):
                n = max(classes[c].pairs.get((v, word), 0) * scale[c] - discount[c], 0.0)
                own = n / (classes[c].pair_sums[v] * scale[c]) if n else 0.0
                p.append(own + max(left[v][c], 1e-9) * chances[word][c])
            self.pairs[v, word] = math.log(p[0] / p[1])

    def _lower(self, gram: str, chances: dict, shared: dict[str, float]) -> tuple[float, float]:
        """The chance of a gram by the next lower order that a class knows."""
        above = parent(gram)
        while above is not None and above not in chances:
            above = parent(above)
        if above is None:
            return shared[gram], shared[gram]
        inside = shared[gram] / shared[above]
        return chances[above][0] * inside, chances[above][1] * inside

    def gain(self, gram: str | None) -> float:
        """How much likelier a word is in toxic text, by it or its longest known beginning."""
        while gram is not None:
            found = self.words.get(gram)
            if found is not None:
                return found
            gram = parent(gram)
        return 0.0


_LETTERS = re.compile(LETTERS)


def features(models: list[Model], text: str) -> list[float]:
    """Per model and number of words, the mean log-ratio of the most telling distinct words."""
    words = _LETTERS.findall(text.lower())
    first = dict.fromkeys(words)
    for i in range(len(words) - 1, -1, -1):
        first[words[i]] = i
    out = []
    for model in models:
        pairs = model.pairs
        best = [0.0] * TELLING[-1]
        for word, i in first.items():
            gain = pairs.get((words[i - 1] if i else "", word)) if pairs else None
            if gain is None:
                gain = model.gain(word)
            if gain > best[-1]:
                best[-1] = gain
                best.sort(reverse=True)
        out += [sum(best[:k]) / k for k in TELLING]
    return out


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a logistic curve, by Newton's method with a little shrinkage."""
    scale = max(float(x.std()), 1e-9)
    z = np.column_stack([x / scale, np.ones(len(x))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        gradient = z.T @ (y - p) - 1e-3 * w
        hessian = (z * (p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1])


def _sample(labels: DataFrame, docs: DataFrame, rows: int) -> DataFrame:
    """``text`` and ``toxic`` of the labelled rows with the smallest hashes."""
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    # At most `rows` ids, whatever the corpus.
    return docs.join(F.broadcast(chosen), "doc_id").select("text", "toxic").dropDuplicates()


def _counts(spark: SparkSession, docs: DataFrame, texts: DataFrame) -> tuple[Counts, Counts, dict[str, float]]:
    """Counts of the toxic and the ordinary sample, and the corpus chances of their words."""
    classes = (Counts(), Counts())
    for row in texts.groupBy("toxic").count().collect():
        classes[1 - row["toxic"]].documents = row["count"]
    words = keep(_documents_with(texts, False, "toxic"), "class-words")
    pairs = keep(_documents_with(texts, True, "toxic"), "class-pairs")
    # All of this is bounded by FIT_ROWS documents of either class.
    size = F.when(F.endswith("gram", F.lit(MARK)), F.length("gram") - 1).otherwise(0)
    for row in words.groupBy("toxic", size.alias("level")).agg(F.sum("n").alias("n")).collect():
        classes[1 - row["toxic"]].sums[row["level"]] = row["n"]
    for row in words.where("n > 1").toLocalIterator():
        classes[1 - row["toxic"]].words[row["gram"]] = row["n"]
    repeated = pairs.where("n > 1")
    for row in repeated.toLocalIterator():
        v, word = row["gram"].split(" ")
        classes[1 - row["toxic"]].pairs[v, word] = row["n"]
    before = F.substring_index("gram", " ", 1)
    sums = pairs.groupBy("toxic", before.alias("v")).agg(F.sum("n").alias("n"), F.max("n").alias("most"))
    for row in sums.where("most > 1").toLocalIterator():
        classes[1 - row["toxic"]].pair_sums[row["v"]] = row["n"]

    corpus = keep(_documents_with(docs, False), "shared-words")
    total = corpus.agg(F.sum("n")).first()[0] or 1
    wanted = words.where("n > 1").select("gram").distinct()
    shared = corpus.join(wanted, "gram", "left_semi")
    return *classes, {row["gram"]: row["n"] / total for row in shared.toLocalIterator()}


def fit(
    spark: SparkSession, docs: DataFrame, labels: DataFrame
) -> tuple[Model, int, float, float] | None:
    """The model, its place in TELLING and its curve; None without labelled documents of both classes.

    Only labels whose id has a remainder other than 1 are looked at: remainder 0
    for the class models, 2 for the curve and the discount.
    """
    labels = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    fold = remainder(F.col("doc_id"))
    fitting = [labels.where((fold == 0) & (F.col("toxic") == c)) for c in (1, 0)]
    texts = keep(
        _sample(fitting[0], docs, FIT_ROWS).union(_sample(fitting[1], docs, FIT_ROWS)), "fit"
    )
    toxic, ordinary, shared = _counts(spark, docs, texts)
    if not toxic.sums or not ordinary.sums:
        return None
    models = [Model(toxic, ordinary, shared, share) for share in DISCOUNTS]

    curve = keep(_sample(labels.where(fold == 2), docs, CURVE_ROWS), "curve")
    marked = [(*r["x"], r["toxic"]) for r in _features(spark, curve, models, "toxic").toLocalIterator()]
    table = np.array(marked, float).reshape(-1, len(models) * len(TELLING) + 1)
    y = table[:, -1]
    if y.min(initial=1) == y.max(initial=0):
        return None
    best = None
    for i, x in enumerate(table.T[:-1]):
        slope, base = fit_curve(x, y)
        loss = np.logaddexp(0, np.where(y == 1, -1, 1) * (x * slope + base)).sum()
        if best is None or loss < best[0]:
            best = loss, models[i // len(TELLING)], i % len(TELLING), slope, base
    return best[1:]


def _features(spark: SparkSession, docs: DataFrame, models: list[Model], key: str) -> DataFrame:
    """``key`` and ``x``, the features by the models."""
    shipped = spark.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shipped.value
        for batch in pieces(batches):
            found = [features(own, text or "") for text in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.list_(pa.float64()))], [key, "x"])

    kind = dict(docs.dtypes)[key]
    return docs.select(key, "text").mapInArrow(run, f"{key} {kind}, x array<double>")


def score(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` for every row.

    Only the text is judged. Null, empty and letterless texts get the score of no
    evidence. Repeated rows get equal scores, and rows with a null id are scored
    like others (``held_out`` false). Labels that contradict each other count as
    toxic, null labels not at all; without usable labels of both classes every
    score is 0. An empty table gives an empty result; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    fitted = fit(spark, docs, labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")))
    if fitted is None:
        value = docs.withColumn("score", F.lit(0.0))
    else:
        model, telling, slope, base = fitted
        z = F.col("x")[telling] * slope + base
        value = _features(spark, docs, [model], "doc_id").withColumn("score", 1 / (1 + F.exp(-z)))
    return value.select(
        "doc_id",
        F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= PREDICT).cast("int").alias("predicted"),
    )
