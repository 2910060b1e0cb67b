"""Near copies, shared passages and vectors against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest

from tonetide.llm import common, hyperminhash, substring_dedup, vector_dedup
from tonetide.llm.common import prepare
from tonetide.llm.graph import components
from tonetide.llm.hnsw import Graph
from tonetide.llm.words import mix, shingle_set, windows

DOC = "doc_id long, text string, lang string, seed string, n_shingles string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def shingles(text):
    w = words(text)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def brute_components(ids, linked):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


def brute_near(rows):
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    linked = [
        (a, b)
        for k, a in enumerate(ids)
        for b in ids[k + 1 :]
        if sets[a]
        and sets[b]
        and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    label = brute_components(ids, linked)
    return {i: (len(sets[i]), label[i], label[i] == i) for i in ids}


def edited(rng, base, rate):
    return [f"x{rng.randrange(10**6)}" if rng.random() < rate else w for w in base]


def corpus(seed=1):
    """Unrelated texts, copies, and families whose members lie on both sides of the threshold."""
    rng = random.Random(seed)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([3, 6, 12, 60, 200]))]
        for rate in (0, 0, 0.01, 0.02, 0.03, 0.05, 0.1):
            texts.append(" ".join(edited(rng, base, rate)))
    # A chain: each text lies near the next only.
    chain = [f"c{i}" for i in range(160)]
    for i in range(8):
        texts.append(" ".join(chain[i * 8 : i * 8 + 90]))
    texts += ["", None, "  \n\t ", "One", "one", "A b c", "a  B\nc", "émile Émile", "émile émile"]
    rng.shuffle(texts)
    return list(enumerate(texts))


def near(spark, rows):
    full = [(i, t, "en", "1", "z") for i, t in rows]
    out = hyperminhash.near_duplicates(spark.createDataFrame(full, DOC)).collect()
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in out}


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_brute_force(spark, seed):
    prepare(spark)
    rows = corpus(seed)
    assert near(spark, rows) == brute_near(rows)


def test_near_duplicates_on_the_driver_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()][:400]
    assert near(spark, rows) == brute_near(rows)


def test_pairs_behind_a_common_opening_are_found(spark):
    """Everybody shares an opening, so all lie in the same buckets; the pairs are just above 0.75."""
    prepare(spark)
    rng = random.Random(6)
    opening = [f"o{i}" for i in range(104)]

    def own(n):
        return [f"x{rng.randrange(10**9)}" for _ in range(n)]

    rows = [(0, " ".join(opening + own(100)), "", "", "")]
    for i in range(500):
        body = own(69)
        for j in range(2):
            rows.append((2 * i + j + 1, " ".join(opening + body + own(25)), "", "", ""))
    a, b = shingles(rows[1][1]), shingles(rows[2][1])
    assert 0.75 <= len(a & b) / len(a | b) < 0.78
    out = hyperminhash.near_duplicates(spark.createDataFrame(rows, DOC).repartition(8)).collect()
    assert {r.doc_id: r.component_id for r in out} == {i: i - (i > 0 and i % 2 == 0) for i in range(1001)}


def test_one_id_with_several_texts_has_the_links_of_each(spark):
    prepare(spark)
    rng = random.Random(2)
    texts = [" ".join(f"t{rng.randrange(10**6)}" for _ in range(80)) for _ in range(3)]
    rows = [(1, texts[0]), (1, texts[1]), (1, None), (2, texts[0] + " z"), (3, texts[1] + " z"), (4, texts[2]),
            (5, texts[2]), (5, texts[1] + " y"), (9, texts[2] + " q")]
    rows = [(i, t, "", "", "") for i, t in rows]
    out = hyperminhash.near_duplicates(spark.createDataFrame(rows, DOC)).collect()
    assert {(r.doc_id, r.component_id) for r in out} == {(i, 1) for i in (1, 2, 3, 4, 5, 9)}
    assert len(out) == len(rows)


def test_near_duplicates_edges(spark):
    prepare(spark)
    assert near(spark, []) == {}
    rows = [(5, "a b c d e f", "", "", ""), (5, "a b c d e f", "", "", ""), (None, "a b c d e f", "", "", "")]
    out = hyperminhash.near_duplicates(spark.createDataFrame(rows, DOC)).collect()
    assert sorted((r.doc_id or -1, r.component_id, r.kept) for r in out) == [
        (-1, None, True),
        (5, 5, True),
        (5, 5, True),
    ]


def test_registers_estimate_similarity():
    rng = np.random.default_rng(0)
    x = np.unique(rng.integers(0, 2**64, 4000, dtype=np.uint64))
    a, b = x[:3000], x[1000:]
    equal = (hyperminhash.registers(a) == hyperminhash.registers(b)).mean()
    assert abs(equal - 2000 / len(x)) < 4 * math.sqrt(0.25 / 256)
    assert (hyperminhash.registers(a[:3]) == hyperminhash.registers(a[:3])).all()


def test_components_of_paths_stars_and_cycles(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(40, 99)] + [(7, i) for i in range(8, 30)]
    links += [(200, 201), (201, 202), (202, 200), (5, 5)]
    rng.shuffle(links)
    want = brute_components({x for l in links for x in l if l[0] != l[1]}, links[:0] + [l for l in links if l[0] != l[1]])
    got = components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()
    assert {r.id: r.component for r in got} == want


# -- passages --------------------------------------------------------------------


def spans(spark, rows):
    full = [(i, t, "en", "1", "z") for i, t in rows]
    return substring_dedup.repeated_passages(spark.createDataFrame(full, DOC)).collect()


def story(rng, n):
    return [f"w{rng.randrange(10**9)}" for _ in range(n)]


def test_planted_passages_are_found_and_nothing_else(spark):
    prepare(spark)
    rng = random.Random(4)
    passage, fuzzy = story(rng, 60), story(rng, 120)
    rows, want = [], {}
    for i in range(40):
        body = story(rng, 300)
        if i % 4 == 1:
            at = rng.randrange(0, 300)
            body[at:at] = passage
            want[i] = (at, at + 60)
        if i % 4 == 2:
            at = rng.randrange(0, 300)
            copy = list(fuzzy)
            for k in range(10, 120, 25):
                copy[k] = f"z{rng.random()}"
            del copy[60]
            body[at:at] = copy
            want[i] = (at, at + 119)
        rows.append((i, " ".join(body)))
    got = spans(spark, rows)
    assert {r.doc_id for r in got} == set(want) - {1, 2}
    assert {r.source_id for r in got} == {1, 2}
    for r in got:
        low, high = want[r.doc_id]
        assert abs(r.start_word - low) <= 12 and abs(r.end_word - high) <= 12
        n = max(r.end_word - r.start_word, r.source_end - r.source_start)
        assert r.equal_words >= 0.75 * n


def test_short_repeats_stay(spark):
    rng = random.Random(5)
    passage = story(rng, 40)
    rows = [(i, " ".join(story(rng, 100) + passage + story(rng, 100))) for i in range(6)]
    assert spans(spark, rows) == []


def _fresh(rng, n):
    return [f"u{rng.randrange(10**9)}" for _ in range(n)]


def _passages(spark, docs):
    rows = [(i, " ".join(t), "", "", "") for i, t in docs.items()]
    out = substring_dedup.repeated_passages(spark.createDataFrame(rows, DOC).repartition(4)).collect()
    return sorted((r.doc_id, r.source_id, r.start_word, r.end_word) for r in out)


def test_second_passage_after_a_long_one(spark):
    prepare(spark)
    rng = random.Random(3)
    long, short = _fresh(rng, 600), _fresh(rng, 120)
    docs = {1: _fresh(rng, 30) + long + _fresh(rng, 100) + short + _fresh(rng, 20),
            2: long + _fresh(rng, 100) + short}
    assert _passages(spark, docs) == [(2, 1, 0, 600), (2, 1, 700, 820)]


def test_pieces_held_by_earlier_documents(spark):
    prepare(spark)
    rng = random.Random(4)
    passage = _fresh(rng, 120)
    docs = {i: _fresh(rng, 40) + passage[22 * i : 22 * i + 34] + _fresh(rng, 40) for i in range(5)}
    docs |= {10: _fresh(rng, 50) + passage, 11: passage + _fresh(rng, 50)}
    docs |= {i + 6: t for i, t in enumerate([_fresh(rng, 30) + passage[50:84], _fresh(rng, 90)])}
    assert _passages(spark, docs) == [(11, 10, 0, 120)]


def test_runs_held_first_by_documents_with_less_of_the_passage(spark, monkeypatch):
    """All long runs of a passage are in earlier documents, each with less than 50 words of it."""
    prepare(spark)
    rng = random.Random(9)
    for words in (50, 64):
        passage = _fresh(rng, words)
        docs = {i: _fresh(rng, 40) + passage[i : i + 49] + _fresh(rng, 40) for i in range(0, words - 48)}
        docs |= {80: _fresh(rng, 50) + passage + _fresh(rng, 9), 81: passage + _fresh(rng, 50)}
        docs |= {82: _fresh(rng, 7) + passage}
        for hot in (5_000, 4):
            monkeypatch.setattr(substring_dedup, "HOT_COUNT", hot)
            found = [p for p in _passages(spark, docs) if p[1] == 80]
            assert found == [(81, 80, 0, words), (82, 80, 7, 7 + words)]


def test_alike_passages_whose_pieces_earlier_documents_hold(spark, monkeypatch):
    """No 40 words in a row are equal, and every seed is first in a document with less of the passage."""
    prepare(spark)
    rng = random.Random(41)
    common = _fresh(rng, 24)
    passage = _fresh(rng, 8) + common + _fresh(rng, 88)
    docs = {i: _fresh(rng, 40) + passage[22 * i : 22 * i + 34] + _fresh(rng, 40) for i in range(5)}
    docs |= {i: _fresh(rng, 20) + common + _fresh(rng, 30) for i in range(20, 30)}
    docs[40] = _fresh(rng, 50) + passage
    for i in (41, 42):
        copy = list(passage)
        for k in range(i - 26, 110, 17):
            copy[k] = f"z{i}x{k}"
        docs[i] = _fresh(rng, 9) + copy + _fresh(rng, 50)
    # The same words once more around the line that all have in common.
    docs[43] = _fresh(rng, 5) + docs[29][5:70] + _fresh(rng, 9)
    docs[43][50] = "other"
    for few in (64, 4, 1):
        monkeypatch.setattr(substring_dedup, "FEW", few)
        assert _passages(spark, docs) == [(41, 40, 9, 129), (42, 40, 9, 129), (43, 29, 5, 70)]


def test_equal_runs_that_touch_are_one():
    assert substring_dedup.joined([(7, 30, 65), (0, 0, 35), (7, 0, 45), (0, 41, 76)]) == [
        (0, 0, 35),
        (0, 41, 76),
        (7, 0, 65),
    ]


def test_a_passage_in_a_third_of_all_documents(spark, monkeypatch):
    prepare(spark)
    rng = random.Random(5)
    passage = _fresh(rng, 70)
    docs = {i: _fresh(rng, 30) + (passage if i % 3 == 0 else []) + _fresh(rng, 30) for i in range(90)}
    wanted = [(i, 0, 30, 100) for i in range(3, 90, 3)]
    assert _passages(spark, docs) == wanted
    monkeypatch.setattr(substring_dedup, "HOT_COUNT", 5)
    assert _passages(spark, docs) == wanted
    monkeypatch.setattr(substring_dedup, "HOT_SEEDS", 0)
    assert _passages(spark, docs) == wanted


def test_chains_equal_brute_force():
    """The best chain score, over all predecessors within reach."""
    rng = random.Random(7)
    for _ in range(30):
        pairs = {(rng.randrange(300), rng.randrange(300)) for _ in range(60)}
        base = rng.randrange(100)
        pairs |= {(i, base + i) for i in range(0, 150, rng.choice([3, 11]))}
        pairs = sorted(pairs)
        score = {}
        for x, y in pairs:
            best = float(substring_dedup.SEED)
            for (p, q), s in list(score.items()):
                if 0 < x - p <= substring_dedup.MAX_GAP and 0 < y - q <= substring_dedup.MAX_GAP:
                    step = min(x - p, y - q, substring_dedup.SEED)
                    best = max(best, s + step - substring_dedup.GAP_COST * (x - p + y - q - 2 * step))
            score[x, y] = best
        a, b = (np.array(side) for side in zip(*pairs, strict=True))
        found = substring_dedup.chains(a, b)
        assert sum(c.shape[1] for c in found) == len(pairs)
        # The tree counts overlapping matches as if they did not overlap, hence a word of slack.
        ends = [score[c[0][-1], c[1][-1]] for c in found]
        assert max(ends) >= max(score.values()) - 1


def test_cut_leaves_other_texts_of_an_id_and_other_columns(spark):
    prepare(spark)
    rng = random.Random(8)
    passage, other = _fresh(rng, 80), _fresh(rng, 60)
    rows = [(1, " ".join(passage)), (2, " ".join(passage)), (2, " ".join(other)), (2, None), (None, " ".join(passage))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.selectExpr("*", "7 AS _text", "8 AS digest", "9 AS cuts", "length(text) AS n_chars")
    out = substring_dedup.without_repeats(docs)
    assert out.columns == docs.columns
    got = [(r.doc_id, r.text, r._text, r.cuts) for r in out.collect()]
    assert (1, rows[0][1], 7, 9) in got and (2, rows[2][1], 7, 9) in got and len(got) == 5
    assert (2, None, 7, 9) in got and (None, rows[4][1], 7, 9) in got


def test_cut_texts(spark):
    prepare(spark)
    rng = random.Random(6)
    passage = " ".join(story(rng, 80))
    first, second = " ".join(story(rng, 70)), " ".join(story(rng, 70))
    rows = [
        (1, f"{first}\n{passage}\n{first[::-1]}", "en", "s", 5),
        (2, f"{second}\n{passage}\nlast line", "en", "s", 5),
        (3, passage, "en", "s", 5),
        (4, None, "en", "s", None),
        (5, "", "en", "s", 0),
        (None, passage, "en", "s", 7),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r for r in substring_dedup.without_repeats(docs).collect()}
    assert out[1].text == rows[0][1] and out[1].n_chars == 5
    assert out[2].text == f"{second}\nlast line" and out[2].n_chars == len(out[2].text)
    assert out[3].text == ""
    assert out[4].text is None and out[5].text == "" and out[None].text == passage
    assert substring_dedup.without_repeats(docs.limit(0)).collect() == []


def test_tables_and_shuffles_go_when_they_are_used(spark, tmp_path, monkeypatch):
    """Nothing but the result stays of what the search for passages wrote."""
    rng = random.Random(21)
    passage = " ".join(f"p{rng.randrange(999)}" for _ in range(80))
    texts = [" ".join(f"w{i}x{n}" for n in range(40)) + " " + passage for i in range(6)]
    docs = prepare(spark).createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    monkeypatch.setattr(common, "shared_dir", lambda _: str(tmp_path))
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {f for f in files.getAllFiles().mkString(" ").split() if "shuffle_" in f}

    spark._jvm.System.gc()
    before = shuffles()
    found = substring_dedup.repeated_passages(docs)
    assert {p.name.rsplit("-", 1)[0] for p in tmp_path.iterdir()} <= {"aligned", "several_texts"}
    until = time.time() + 20
    while shuffles() - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffles() - before
    assert sorted((r.doc_id, r.source_id, r.equal_words) for r in found.collect()) == [
        (i, 0, 80) for i in range(1, 6)
    ]
    assert spark.conf.get(common._SHUFFLES_GO, None) != "true"


def test_runs_of_words_are_sums_with_powers():
    rng = np.random.default_rng(3)
    hashes = rng.integers(0, 2**64, 90, np.uint64)
    for k in (1, 2, 3, 5, 7, 40, 50, 90, 91):
        want = [
            sum(int(h) * pow(0x9E3779B97F4A7C15, j, 2**64) for j, h in enumerate(hashes[i : i + k].tolist()))
            for i in range(len(hashes) - k + 1)
        ]
        assert windows(hashes, k).tolist() == mix(np.array([w % 2**64 for w in want], np.uint64)).tolist()


def test_matches_in_line_equal_the_tree():
    rng = random.Random(5)
    for _ in range(300):
        a = sorted(rng.sample(range(rng.choice((40, 300, 900))), rng.randrange(1, 30)))
        assert substring_dedup._in_line(a) == substring_dedup._in_both(a, [x + 7 for x in a])


def _shared_longs(docs):
    """(doc, place) of all long runs at seeds that several texts have, to their first holder and place."""
    ids = list(docs)
    batch = pa.record_batch([pa.array(ids), pa.array([" ".join(t) for t in docs.values()])], ["doc_id", "text"])
    places, first, holders = {}, {}, {}
    for out in substring_dedup._seeds(iter([batch])):
        for r in out.to_pylist():
            if r["long"] is not None:
                places[r["doc_id"], r["pos"]] = r["long"]
    for (doc, pos), run in places.items():
        first[run] = min(first.get(run, (doc, pos)), (doc, pos))
        holders.setdefault(run, set()).add(doc)
    return {at: first[run] for at, run in places.items() if len(holders[run]) > 1}


def _whole_runs(docs, longs):
    ids = [i for i in docs if any(d == i for d, _ in longs)]
    at = [
        [{"pos": p, "source_id": s, "way": q - p} for (d, p), (s, q) in longs.items() if d == i] for i in ids
    ]
    kind = pa.list_(pa.struct([("pos", pa.int32()), ("source_id", pa.int64()), ("way", pa.int32())]))
    columns = [pa.array(ids), pa.array([" ".join(docs[i]) for i in ids]), pa.array(at, kind)]
    batch = pa.record_batch(columns, ["doc_id", "text", "at"])
    return [r for out in substring_dedup._whole_runs(iter([batch])) for r in out.to_pylist()]


def test_runs_that_a_copy_asks_for():
    """Most of a copy's runs are known from its long runs, and most of the source's own are its own."""
    rng = random.Random(31)
    passage = _fresh(rng, 4000)
    docs = {1: passage, 2: list(passage)}
    rows = _whole_runs(docs, _shared_longs(docs))
    assert len([r for r in rows if r["doc_id"] == 1]) > 3900
    assert len([r for r in rows if r["doc_id"] == 2]) < 800
    assert len([r for r in rows if r["asks"]]) < 1600


def test_first_holders_of_whole_runs_are_kept():
    """What is left out or not asked for changes no first holder, also behind other contexts."""
    rng = random.Random(32)
    left_out = 0
    for _ in range(25):
        texts = [_fresh(rng, 90) for _ in range(4)]
        docs = {}
        for i in range(30):
            docs[i] = []
            for _ in range(rng.randrange(1, 4)):
                text, low = rng.choice(texts), rng.randrange(45)
                docs[i] += _fresh(rng, rng.choice((0, 3, 30))) + text[low : low + rng.randrange(40, 91)]
        longs = _shared_longs(docs)
        rows = {(r["doc_id"], r["pos"]): r for r in _whole_runs(docs, longs)}
        places = {(d, p + k) for d, p in longs for k in range(-10, 1) if 0 <= p + k <= len(docs[d]) - 50}
        assert set(rows) <= places
        every, kept, new = {}, {}, {}
        for d, p in sorted(places):
            run = tuple(docs[d][p : p + 50])
            every.setdefault(run, (d, p))
            if (d, p) in rows:
                kept.setdefault(run, (d, p))
                assert rows[d, p]["new"] == ((d, run) not in new)
                new[d, run] = True
        for d, p in places:
            run = tuple(docs[d][p : p + 50])
            if (d, p) not in rows:
                s, q = every[run]
                on_way = sorted(x for (i, x), (j, y) in longs.items() if (i, j, y - x) == (d, s, q - p))
                covered = {w for x in on_way for w in range(x, x + 40)}
                assert s < d and covered >= set(range(p, p + 50))
                left_out += 1
            else:
                assert kept[run] == every[run]
                assert rows[d, p]["asks"] or every[run][0] == d
    assert left_out > 1000


def test_a_pair_of_texts_is_one_row():
    matches = [(1, p, p + 9, 5) for p in range(0, 200, 10)] + [(1, p, p + 500, 40) for p in (300, 330, 600)]
    matches += [(0, 7, 7, 5)]
    names = ["source_id", "pos", "source_pos", "words"]
    kind = pa.list_(pa.struct([(name, pa.int64()) for name in names]))
    lists = pa.array([[dict(zip(names, m, strict=True)) for m in matches]], kind)
    batch = pa.record_batch([pa.array([8]), lists], ["doc_id", "matches"])
    rows = [r for out in substring_dedup._chain(iter([batch])) for r in out.to_pylist()]
    assert [(r["doc_id"], r["source_id"]) for r in rows] == [(8, 1)]
    assert rows[0]["size"] == [2] * len(rows[0]["chain"])
    assert {(0, 190), (300, 365), (600, 635)} <= set(zip(rows[0]["a"][::2], rows[0]["a"][1::2]))


def test_alignments_at_once_equal_those_one_by_one():
    rng = random.Random(33)
    kind = pa.list_(pa.struct([("side", pa.int32()), ("tile", pa.int32()), ("words", pa.binary())]))
    rows, want = [], []
    for pair in range(40):
        x = np.array([rng.randrange(1, 2**32) for _ in range(rng.choice((70, 400, 900)))], np.uint32)
        cut = rng.randrange(30)
        y = np.concatenate([x[cut:], x[: rng.randrange(1, 200)]])
        y[[rng.randrange(len(y)) for _ in range(rng.choice((0, 5, 60)))]] = 1
        chains, found = [], []
        for n in range(rng.randrange(1, 25)):
            a = sorted(rng.sample(range(len(x) - 5), 2))
            way = rng.choice((-cut, len(x) - cut, -3))
            b = [a[0] + way, a[1] + way + rng.choice((0, 0, 2))]
            if min(b) < 0 or max(b) > len(y) - 5 or b[0] >= b[1]:
                continue
            chains.append((rng.choice((n, -1 - n)), a, b))
        if not chains:
            continue
        tiles = [set(), set()]
        for n, a, b in chains:
            part, begin = [], []
            for side, (text, ends) in enumerate(((x, a), (y, b))):
                low, high = (int(t) for t in substring_dedup._tiles(np.int64(ends[0]), np.int64(ends[1] + 5)))
                tiles[side] |= set(range(low, high + 1))
                part.append(text[low * 64 : (high + 1) * 64])
                begin.append(low * 64)
            s, e, t, u, equal = substring_dedup.align(
                *part, np.array(a) - begin[0], np.array(b) - begin[1]
            )
            if min(e - s, u - t) >= 50 and equal >= 0.75 * max(e - s, u - t):
                found.append((n, s + begin[0], e + begin[0], t + begin[1], u + begin[1], equal))
        for n, s, e, t, u, equal in found:
            inside = [
                o for o in found
                if o[0] != n and o[1] <= s and e <= o[2] and o[3] <= t and u <= o[4] and (o[0] > n or o[2] - o[1] > e - s)
            ]
            if n >= 0 or not inside:
                want.append((pair, -pair, s, e, t, u, equal))
        held = [
            {"side": side, "tile": k, "words": text[k * 64 : k * 64 + 64].tobytes()}
            for side, text in enumerate((x, y))
            for k in tiles[side]
            if k * 64 < len(text)
        ]
        rng.shuffle(held)
        number, a, b = zip(*chains, strict=True)
        rows.append((pair, -pair, number, [2] * len(a), sum(a, []), sum(b, []), held))
    ints = pa.list_(pa.int32())
    kinds = [pa.int64(), pa.int64(), ints, ints, ints, ints, kind]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    batch = pa.record_batch(columns, [f"c{n}" for n in range(7)])
    for size in (1 << 19, 256):
        with pytest.MonkeyPatch.context() as m:
            m.setattr(substring_dedup, "COMPARED", size)
            got = [tuple(r.values()) for b in substring_dedup._align(iter([batch.slice(1)])) for r in b.to_pylist()]
        assert sorted(got) == sorted(w for w in want if w[0] != rows[0][0])
    assert len(want) > 50


def test_ids_that_repeat_are_looked_at_alone(spark):
    docs = spark.createDataFrame(
        [(1, "a"), (2, "b"), (2, "b"), (3, None), (3, ""), (4, "d"), (4, "c"), (None, "e")], "doc_id long, text string"
    )
    got = sorted(((r.doc_id, r.text) for r in substring_dedup.one_text_per_id(docs).collect()), key=str)
    first = min("cd", key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    want = [(1, "a"), (2, "b"), (2, "b"), (3, None), (3, ""), (4, first)]
    assert got == sorted(want, key=str)


def test_chains_rise_in_both_texts():
    rng = random.Random(7)
    for _ in range(30):
        n = rng.randrange(2, 40)
        a = np.array([rng.randrange(200) for _ in range(n)])
        b = np.array([rng.randrange(200) for _ in range(n)])
        found = substring_dedup.chains(a, b)
        assert sum(c.shape[1] for c in found) == n
        for c in found:
            assert (np.diff(c[0]) > 0).all() and (np.diff(c[1]) > 0).all()
    line = np.arange(0, 200, 7)
    assert substring_dedup.chains(line, line + 3)[0].shape[1] == len(line)


def test_minimizers_hit_every_window():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2**63, 500).astype(np.uint64)
    at = substring_dedup.minimizers(x)
    assert np.diff(at).max() <= substring_dedup.WINDOW
    assert len(shingle_set(x[:0], 5)) == 0


# -- vectors -----------------------------------------------------------------------


def test_vectors_against_brute_force(spark):
    prepare(spark)
    rng = np.random.default_rng(2)
    base = rng.normal(size=(600, 24))
    near = np.concatenate([base[i] + 0.02 * i * rng.normal(size=(9, 24)) for i in range(8)])
    x = np.concatenate([base, near, base[:5], 3 * base[5:9]]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(900, None), (901, []), (902, [0.0] * 24), (903, [float("nan")] * 24)]
    odd += [(904, [None] + [1.0] * 23), (905, [float("inf")] * 24), (906, [1.0, 2.0]), (907, [2.0, 4.0])]
    odd += [(None, x[0].tolist())]
    out = vector_dedup.near_vectors(
        spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>")
    ).collect()
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out}
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    hit = u @ u.T >= 0.95
    np.fill_diagonal(hit, False)
    label = brute_components(range(len(x)), [tuple(map(int, p)) for p in np.argwhere(hit)])
    want = {i: (int(hit[i].sum()), label[i], label[i] == i) for i in range(len(x))}
    want |= {i: (0, i, True) for i, _ in odd if i is not None and i < 906}
    want |= {906: (1, 906, True), 907: (1, 906, False), None: (0, None, True)}
    assert got == want


def test_graph_recall():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[1500:] = x[:1500] + 0.1 * rng.normal(size=(1500, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    true = x @ x.T >= 0.95
    q, r = Graph(x).within(x, 0.95, 48)
    found = np.zeros_like(true)
    found[q, r] = True
    assert (found & true).sum() >= 0.98 * true.sum()
    assert not (found & ~(x @ x.T >= 0.9499)).any()
    assert len(Graph(x[:0]).within(x[:3], 0.95, 8)[0]) == 0


def test_a_searcher_that_finds_only_the_vector_itself_fails_the_audit():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(2000, 16))
    x[1000:1010] = x[:10] + 0.01 * rng.normal(size=(10, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    outside = x[:40] + 0.001 * rng.normal(size=(40, 16))
    ids, known = np.arange(10_000, 10_040), np.arange(2000)

    class Blind(Graph):
        def within(self, queries, least, width):
            best = np.argmax(queries @ self.x.T, axis=1)
            alike = (queries * self.x[best]).sum(axis=1) > 0.999999
            return np.flatnonzero(alike), best[alike]

    asked = outside / np.linalg.norm(outside, axis=1, keepdims=True)
    assert vector_dedup._audit(Graph(x), known, x, ids, asked) == vector_dedup.BEAM
    assert vector_dedup._audit(Blind(x), known, x, ids, asked) >= len(x)
    # Without any true pair there is nothing to find.
    assert vector_dedup._audit(Blind(x[:1000]), known[:1000], x[:1000], known[:5], x[:5]) == vector_dedup.BEAM
