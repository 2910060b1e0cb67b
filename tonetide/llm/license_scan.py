"""Licence notices in texts, found by voting on diagonals.

Every run of k words of every text is hashed and joined to the places of the same run
in the templates. Place in the text less place in the template is the *diagonal*: a
copy of a template lies on one diagonal, a copy with words added or lost on a few
neighbouring ones. Hits are counted per document, template and diagonal, neighbouring
diagonals are merged, and what has enough votes is a candidate span. The words of each
candidate are then read from the text and compared with the template word by word.

*Phrases* are short and must stand in the text as they are. *Notices* are the method's
own: a span counts if at least ``SIMILAR`` of the template's words are found in it in
order. A copy with that many words left keeps a least number of runs of k words, since a
changed word destroys at most k of them; fewer votes can't be a copy.

Templates are a parameter of bounded size, and only they are broadcast. Texts with
candidates are found again by a key; up to ``BROADCAST_KEYS`` keys are broadcast, beyond
that both sides are shuffled. Documents are told apart by id and SHA-256 of the text, so
no row numbers have to agree between the two readings.

Rows and edge cases: a null text is empty and has no words; a null id is an id like any
other; rows with equal id and text give equal rows; rows with equal id and different
texts are judged each by its text; an empty table gives no rows; other columns are
ignored. Texts are hashed in pieces of some MB with the last words carried over.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tonetide.llm.common import PIECE_BYTES, ids_of, keep, pieces
from tonetide.llm.words import windows, words_of

# Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Openings of public licence texts and the short forms in which they are named.
NOTICES = (
    ("gpl-2.0", "GNU General Public License, version 2"),
    ("gpl-3.0", "GNU General Public License, version 3"),
    ("lgpl", "GNU Lesser General Public License"),
    ("agpl", "GNU Affero General Public License"),
    ("apache-2.0", "Apache License, Version 2.0"),
    ("mpl-2.0", "Mozilla Public License, version 2.0"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by-sa", "CC BY-SA"),
    ("cc-by-nc", "CC BY-NC"),
    ("cc-by-nd", "CC BY-ND"),
    ("cc-by", "Creative Commons Attribution"),
    ("cc0", "CC0 1.0 Universal"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation",
    ),
    (
        "apache-2.0",
        "you may not use this file except in compliance with the License."
        " You may obtain a copy of the License at",
    ),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
        " and associated documentation files (the Software), to deal in the Software without restriction",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted"
        " provided that the following conditions are met",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or"
        " without fee is hereby granted",
    ),
)

# Templates up to SHORT_WORDS words must stand as they are and are found by SHORT_RUN words.
SHORT_WORDS = 6
SHORT_RUN = 2
LONG_RUN = 4
SIMILAR = 0.8
# Texts whose keys are broadcast to the second reading; 8 bytes each.
BROADCAST_KEYS = 500_000
# Runs of one Arrow row.
ROW_RUNS = 65_536

_GAPS = np.ones(256, bool)
for _first, _last in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _GAPS[_first : _last + 1] = False
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

_RUNS = "doc_id long, digest string, n_words long, start long, runs array<long>"
_FOUND = "doc_id long, digest string, template int, begin long, similarity double"


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[bytes, ...]
    phrase: bool

    @property
    def run(self) -> int:
        return SHORT_RUN if len(self.words) <= SHORT_WORDS else LONG_RUN

    @property
    def edits(self) -> int:
        """Words that may differ."""
        return 0 if len(self.words) <= SHORT_WORDS else int((1 - SIMILAR) * len(self.words))

    @property
    def votes(self) -> int:
        """Runs that are left of any copy."""
        return max(1, len(self.words) - self.run + 1 - self.run * self.edits)


def templates(
    phrases: dict[str, str] = PHRASES, notices: Sequence[tuple[str, str]] = NOTICES
) -> list[Template]:
    known = [(label, text, True) for text, label in phrases.items()]
    known += [(label, text, False) for label, text in notices]
    out = [Template(label, tuple(_WORD.findall(text.encode().lower())), phrase) for label, text, phrase in known]
    if any(len(t.words) < SHORT_RUN for t in out):
        raise ValueError(f"a template has fewer than {SHORT_RUN} words")
    return out


def _hashes(text: bytes) -> np.ndarray:
    """Hashes of the words of a text, a few MB at a time."""
    found, at = [], 0
    while at < len(text):
        to = min(at + PIECE_BYTES, len(text))
        while to < len(text) and not _GAPS[text[to]]:
            to += 1
        found.append(words_of(pa.array([text[at:to]], pa.binary()), gaps=_GAPS).hashes)
        at = to
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def _template_runs(spark: SparkSession, known: list[Template]) -> DataFrame:
    rows = [
        (int(run), number, place)
        for number, template in enumerate(known)
        for place, run in enumerate(windows(_hashes(b" ".join(template.words)), template.run).view(np.int64))
    ]
    return spark.createDataFrame(rows, "run long, template int, place long")


def _text_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row without runs per document, with its number of words, and rows of its runs."""
    for batch in pieces(batches):
        texts = batch.column(1)
        if batch.num_rows == 1 and texts.nbytes > PIECE_BYTES:
            words = [_hashes(texts[0].as_buffer().to_pybytes())]
        else:
            found = words_of(texts, gaps=_GAPS)
            words = [found.of(i) for i in range(batch.num_rows)]
        owner, counts, starts, runs = [], [], [], []
        for i, hashes in enumerate(words):
            owner.append(i)
            counts.append(len(hashes))
            starts.append(0)
            runs.append(np.zeros(0, np.int64))
            for length in (SHORT_RUN, LONG_RUN):
                every = windows(hashes, length).view(np.int64)
                for start in range(0, len(every), ROW_RUNS):
                    owner.append(i)
                    counts.append(None)
                    starts.append(start)
                    runs.append(every[start : start + ROW_RUNS])
        ends = np.concatenate([[0], np.cumsum([len(r) for r in runs])])
        take = pa.array(owner)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(take),
                batch.column(2).take(take),
                pa.array(counts, pa.int64()),
                pa.array(starts, pa.int64()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(runs))),
            ],
            names=["doc_id", "digest", "n_words", "start", "runs"],
        )


def _hits(docs: DataFrame, known: list[Template]) -> DataFrame:
    """Per document a row with ``n_words``, and its runs that occur in a template."""
    runs = docs.mapInArrow(_text_runs, _RUNS).select(
        "doc_id", "digest", "n_words", "start", F.posexplode_outer("runs").alias("at", "run")
    )
    # Bounded by the templates, a parameter.
    places = F.broadcast(_template_runs(docs.sparkSession, known))
    return runs.join(places, "run", "left").where("template IS NOT NULL OR n_words IS NOT NULL").select(
        "doc_id", "digest", "n_words", (F.col("start") + F.col("at")).alias("pos"), "template", "place"
    )


def _by_template(known: list[Template], value) -> F.Column:
    """A number per template as a column."""
    return F.element_at(F.array(*[F.lit(value(t)) for t in known]), F.col("template") + 1)


def candidates(hits: DataFrame, known: list[Template]) -> DataFrame:
    """Spans ``begin`` up to ``stop`` of a document's words with votes enough for a copy."""
    key = ["doc_id", "digest", "template"]
    # Distinct, as rows with equal id and text vote alike.
    voted = (
        hits.where("template IS NOT NULL")
        .select(*key, (F.col("pos") - F.col("place")).alias("diagonal"), "place")
        .distinct()
        .groupBy(*key, "diagonal")
        .agg(F.count("*").alias("votes"))
    )
    # Bounded by the words of one document.
    along = Window.partitionBy(*key).orderBy("diagonal")
    far = F.col("diagonal") - F.lag("diagonal").over(along) > _by_template(known, lambda t: t.edits)
    return (
        voted.withColumn("new", F.coalesce(far, F.lit(True)).cast("long"))
        .withColumn("group", F.sum("new").over(along))
        .groupBy(*key, "group")
        .agg(
            F.sum("votes").alias("votes"),
            F.min("diagonal").alias("begin"),
            F.max("diagonal").alias("last"),
        )
        .where(F.col("votes") >= _by_template(known, lambda t: t.votes))
        .select(*key, "begin", (F.col("last") + _by_template(known, lambda t: len(t.words))).alias("stop"))
    )


def _words_in(text: bytes, spans: list[tuple[int, int]]) -> list[list[bytes]]:
    """The words of each span, keeping no others; spans are sorted by their begin."""
    found: list[list[bytes]] = [[] for _ in spans]
    waiting, active = 0, []
    for i, word in enumerate(_WORD.finditer(text)):
        while waiting < len(spans) and spans[waiting][0] <= i:
            active.append(waiting)
            waiting += 1
        if active:
            active = [s for s in active if spans[s][1] > i]
            for s in active:
                found[s].append(word.group())
        elif waiting == len(spans):
            break
    return found


def similarity(words: list[bytes], template: Template) -> float:
    """Share of the template's words that stand among ``words`` in its order."""
    wanted = list(template.words)
    if words == wanted:
        return 1.0
    blocks = difflib.SequenceMatcher(None, words, wanted, autojunk=False).get_matching_blocks()
    return sum(b.size for b in blocks) / len(wanted)


def _verifier(known: list[Template]):
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(i) for i in range(4)]
            for doc_id, digest, text, spans in zip(*columns, strict=True):
                spans = sorted((s["begin"], s["stop"], s["template"]) for s in spans.as_py())
                lower = text.as_buffer().to_pybytes().lower()
                for (begin, _, number), words in zip(
                    spans, _words_in(lower, [s[:2] for s in spans]), strict=True
                ):
                    out.append((doc_id.as_py(), digest.as_py(), number, begin, similarity(words, known[number])))
            if out:
                types = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)],
                    names=["doc_id", "digest", "template", "begin", "similarity"],
                )

    return verify


def _same(left: DataFrame, right: DataFrame):
    return left["doc_id"].eqNullSafe(right["_doc_id"]) & (left["digest"] == right["_digest"])


def verified(docs: DataFrame, spans: DataFrame, known: list[Template], broadcast_keys: int) -> DataFrame:
    """Spans with the share of their template that the text really holds."""
    per_doc = keep(
        # Bounded by the words of one document.
        spans.groupBy(F.col("doc_id").alias("_doc_id"), F.col("digest").alias("_digest")).agg(
            F.collect_list(F.struct("template", "begin", "stop")).alias("spans")
        ),
        "spans",
    )
    if per_doc.count() <= broadcast_keys:
        keys = per_doc.select(F.xxhash64("_doc_id", "_digest").alias("_key"))
        docs = docs.join(F.broadcast(keys), F.xxhash64("doc_id", "digest") == F.col("_key"), "left_semi")
    found = docs.join(per_doc, _same(docs, per_doc)).select("doc_id", "digest", "text", "spans")
    return (
        found.mapInArrow(_verifier(known), _FOUND)
        .groupBy("doc_id", "digest", "template", "begin")
        .agg(F.max("similarity").alias("similarity"))
    )


def scan(
    docs: DataFrame, known: Sequence[Template] | None = None, broadcast_keys: int = BROADCAST_KEYS
) -> DataFrame:
    """One row per document: ``n_words``, places of phrases, labels and a score.

    ``n_base``, ``first_word``, ``last_word`` and ``base_labels`` tell of the phrases;
    ``labels`` holds those of the notices as well; ``score`` is the largest share of a
    template found in one span, 0 if no span was looked at.
    """
    known = list(known or templates())
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).select(
        "doc_id", "text", F.sha2("text", 256).alias("digest")
    )
    hits = keep(_hits(texts, known), "hits")
    spans = keep(candidates(hits, known), "spans")
    found = verified(texts, spans, known, broadcast_keys)
    phrase = _by_template(known, lambda t: t.phrase)
    enough = F.col("similarity") >= _by_template(known, lambda t: 1.0 if len(t.words) <= SHORT_WORDS else SIMILAR)
    place = F.when(F.col("phrase") & F.col("enough"), F.col("begin"))
    results = (
        found.withColumns(
            {"phrase": phrase, "enough": enough, "label": _by_template(known, lambda t: t.label)}
        )
        .groupBy(F.col("doc_id").alias("_doc_id"), F.col("digest").alias("_digest"))
        .agg(
            F.count(place).alias("n_base"),
            F.min(place).alias("first_word"),
            F.max(place).alias("last_word"),
            *[
                F.array_join(F.array_sort(F.collect_set(F.when(which, F.col("label")))), ",").alias(name)
                for name, which in (
                    ("base_labels", F.col("phrase") & F.col("enough")),
                    ("labels", F.col("enough")),
                )
            ],
            F.max("similarity").alias("score"),
        )
    )
    rows = hits.where("n_words IS NOT NULL").select("doc_id", "digest", "n_words")
    return rows.join(results, _same(rows, results), "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )
