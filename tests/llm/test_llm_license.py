"""Licence scans against plain Python."""

from __future__ import annotations

import random
import re

import pytest

from tonetide.llm import license_scan, queries
from tonetide.llm.common import prepare

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def places(words, phrase):
    n = len(phrase)
    return [i for i in range(len(words) - n + 1) if words[i : i + n] == phrase]


def brute(text):
    """Words, phrases by their places, and the short notices that stand in the text."""
    words = words_of(text)
    at, base, labels = [], set(), set()
    for phrase, label in license_scan.PHRASES.items():
        found = places(words, phrase.split())
        at += found
        base |= {label} if found else set()
    for label, notice in license_scan.NOTICES:
        if len(words_of(notice)) <= license_scan.SHORT_WORDS and places(words, words_of(notice)):
            labels.add(label)
    first, last = (min(at), max(at)) if at else (None, None)
    return len(words), len(at), first, last, ",".join(sorted(base)), base | labels


def scanned(spark, docs, **options):
    table = spark.createDataFrame(docs, "doc_id long, text string")
    table = table.selectExpr("*", "1 AS digest", "2 AS template", "3 AS run", "4 AS n_words")
    return license_scan.scan(table, **options).collect()


def check(rows, texts):
    for r in rows:
        *base, labels = brute(texts[r.doc_id])
        assert [r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels] == base
        assert labels <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score == 1 or not labels)


def test_whole_table(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op12_license_scan(spark, sf_dir).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    check(rows, texts)
    assert {"gpl-3.0", "apache-2.0", "cc-by-nc"} <= {x for r in rows for x in r.labels.split(",")}


@pytest.mark.parametrize("broadcast_keys", [0, license_scan.BROADCAST_KEYS])
def test_random_texts_of_licence_words(spark, broadcast_keys):
    prepare(spark)
    rng = random.Random(3)
    pieces = "gnu general public license apache cc by mit version 2 0 nc Sa é LICENSE \x00 . ,".split(" ")
    texts = {i: rng.choice([" ", "-", ". "]).join(rng.choices(pieces, k=rng.randint(0, 60))) for i in range(200)}
    texts |= {200: None, 201: "", 202: " ,.\n", 203: "MIT", 204: "mit_license", 205: "mitélicense mit license"}
    rows = scanned(spark, list(texts.items()), broadcast_keys=broadcast_keys)
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    check(rows, texts)


def test_notices_with_changed_words(spark):
    rng = random.Random(8)
    prepare(spark)

    def noise(n):
        return [f"word{rng.randint(0, 10**6)}" for _ in range(n)]

    long = [(label, words_of(t)) for label, t in license_scan.NOTICES if len(words_of(t)) > license_scan.SHORT_WORDS]
    docs, wanted = [], {}
    for number, (label, notice) in enumerate(long):
        for kind in range(4):
            copy = list(notice)
            edits = int((1 - license_scan.SIMILAR) * len(copy))
            if kind == 1:
                for i in rng.sample(range(len(copy)), edits):
                    copy[i] = noise(1)[0]
            elif kind == 2:
                del copy[len(copy) // 2 : len(copy) // 2 + edits]
            elif kind == 3:
                copy = copy[: len(copy) // 3]
            doc_id = 10 * number + kind
            wanted[doc_id] = (label, kind < 3)
            docs.append((doc_id, " ".join(noise(50) + copy + noise(50))))
    for r in scanned(spark, docs):
        label, there = wanted[r.doc_id]
        assert (label in r.labels.split(",")) == there, (r, label)


def test_repeated_rows_null_ids_and_nothing(spark):
    assert scanned(spark, []) == []
    line = "Released under the MIT License."
    docs = [(1, line), (1, line), (1, "none"), (None, line), (None, None)]
    rows = sorted((r.doc_id or 0, r.n_words, r.n_base, r.labels) for r in scanned(spark, docs))
    assert rows == [(0, 0, 0, ""), (0, 5, 1, "mit"), (1, 1, 0, ""), (1, 5, 1, "mit"), (1, 5, 1, "mit")]


def test_one_very_long_text(spark, monkeypatch):
    text = "plain words here " * 300_000 + "mit license " * 1_000 + "the end cc by"
    (row,) = scanned(spark, [(7, text)])
    words = words_of(text)
    assert (row.n_words, row.n_base, row.first_word, row.last_word) == (
        len(words), 1_001, 900_000, len(words) - 2,
    )
    assert row.base_labels == "cc-by,mit"
