"""Token files, merge replay and WARC archives: exact round trips."""

from __future__ import annotations

import hashlib
import io
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import tiktoken

from tonetide.llm import merge_replay, seekable_ids, warc_chunks
from tonetide.llm.common import prepare

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ALPHABET = list("abcABC 's'tdéñß\n\t\x0b\x0c\r\x1c\x1d\x85  　'’0123 .,!#$一二😀́​\x00")
ODD = ["<|endoftext|>", "'re", "'ll", "  ", "   \n", " \n\n x", "don't", "aaaaaaa", " ", "ĳ", "٣", "Ⅷ"]


def odd_texts(n, seed=0):
    rng = random.Random(seed)
    return [
        "".join(rng.choice(ALPHABET + ODD) for _ in range(rng.randrange(0, 40))) for _ in range(n)
    ]


def test_replay_equals_the_library():
    ranks = merge_replay.load_ranks(RANKS)
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    own = merge_replay.Replayer(ranks, public_tokenizers.PATTERN)
    texts = odd_texts(3000) + ["", " ", "a" * 3000, "ab" * 2000, "x y  z " * 500]
    for text, ids in zip(texts, own.encode(texts), strict=True):
        assert ids.tolist() == library.encode_ordinary(text), repr(text)
        assert own.decode(ids) == text.encode()


def test_replay_on_the_driver_table(spark, sf_dir):
    prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ranks = merge_replay.load_ranks(RANKS)
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = merge_replay.digests(merge_replay.encode_decode(docs, RANKS, public_tokenizers.PATTERN))
    got = {r.doc_id: r for r in out.collect()}
    for row in docs.collect():
        ids = np.array(library.encode_ordinary(row.text), "<u4")
        assert got[row.doc_id].n_tokens == len(ids)
        assert got[row.doc_id].ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert got[row.doc_id].decoded_sha256 == hashlib.sha256(row.text.encode()).hexdigest()


def test_replay_edges(spark):
    rows = [(1, None, "c"), (2, "", "c"), (None, "x", "c"), (3, "x", "c"), (3, "x", "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = merge_replay.encode_decode(docs, RANKS, public_tokenizers.PATTERN).collect()
    assert sorted((r.doc_id or -1, len(r.ids), bytes(r.decoded)) for r in out) == [
        (-1, 4, b"x"), (1, 0, b""), (2, 0, b""), (3, 4, b"x"), (3, 4, b"x")
    ]
    assert merge_replay.encode_decode(docs.limit(0), RANKS, public_tokenizers.PATTERN).collect() == []


def test_replay_takes_a_lower_rank_that_appears():
    """Ranks in an order that no training gives: a merge makes a pair that comes first."""
    ranks = {bytes([i]): i + 10 for i in range(256)} | {b"ab": 500, b"abc": 2, b"cd": 501, b"bc": 600}
    own = merge_replay.Replayer(ranks, r"\s+|\S+")
    library = tiktoken.Encoding("t", pat_str=r"\s+|\S+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(1)
    for _ in range(500):
        text = "".join(rng.choice("abcd ") for _ in range(rng.randrange(30)))
        assert own.encode([text])[0].tolist() == library.encode_ordinary(text), text


# -- token files ----------------------------------------------------------------


def test_words_one_by_one_equal_whole_texts():
    model = seekable_ids._encoder(TOKENIZER)
    texts = odd_texts(3000, 2)
    whole = [model.encode(t, add_special_tokens=False).ids for t in texts]
    for text, want, got in zip(texts, whole, seekable_ids.encode_texts(model, "t", texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == want, repr(text)


def test_runs_one_by_one_equal_whole_texts():
    """Marks, digits, apostrophes, letters of all kinds and combining marks beside each other."""
    model, rng = seekable_ids._encoder(TOKENIZER), random.Random(7)
    around = [chr(c) for c in [*range(0x250), 0x300, 0x307, 0x308, 0x338, 0x3A3, 0x2019, 0x2028, 0x212A]]
    pools = [around, around[:128], around[:0x180], list("'stremvldT<|>= AB0\t\n,."), list("TtIi'\u0307\u0308 s")]
    texts = ["".join(rng.choices(rng.choice(pools), k=rng.randrange(25))) for _ in range(4000)]
    texts += ["<|endoftext|> x<|startoftext|>", "don't DON'T we'LL 'sthat $$'s ''s 's's", "'", "'s", None, ""]
    texts += [f"A{chr(c)}b{chr(c)} {chr(c)}'s,{chr(c)}9" for c in range(0x3000)]
    whole = [model.encode(t or "", add_special_tokens=False).ids for t in texts]
    for text, want, got in zip(texts, whole, seekable_ids.encode_texts(model, "r", texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == want, repr(text)


def test_library_gets_each_run_once():
    class Counting:
        def __init__(self, model):
            self.model, self.chars = model, 0

        def get_vocab(self):
            return self.model.get_vocab()

        def encode_batch_fast(self, texts, **options):
            self.chars += sum(map(len, texts))
            return self.model.encode_batch_fast(texts, **options)

    library = seekable_ids._encoder(TOKENIZER)
    model = Counting(library)
    marks = [a + b for a in "(\"#$%" for b in ",.;:!?)"]
    texts = [" ".join(f"{mark}{word}{mark[::-1]}" for mark in marks) for word in ("Tone", "tone", "TIDE", "caf\u00e9")]
    got = seekable_ids.encode_texts(model, "once", texts)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [
        library.encode(t, add_special_tokens=False).ids for t in texts
    ]
    assert model.chars < sum(map(len, texts)) / 3


def brute_files(rows):
    model = seekable_ids._encoder(TOKENIZER)
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: r[0]):
        ids = np.array(model.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def described(spark, docs):
    prepare(spark)
    out = seekable_ids.encode_to_files(spark, docs, TOKENIZER, 5).collect()
    return sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in out)


def test_files_on_the_driver_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert described(spark, docs) == brute_files(rows)


def test_files_edges(spark):
    rows = [(5, "b a", 1), (-3, None, 1), (2, "", 1), (9, "long " * 50_000, 1), (None, "x", 1), (2, "", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, path int")
    assert described(spark, docs) == brute_files([r[:2] for r in rows if r[0] is not None])
    assert described(spark, docs.limit(0)) == []


def test_only_the_list_of_files_is_sent_to_all(spark):
    """Ids come out of a small list of files, so Spark takes them for the smaller side."""
    prepare(spark)
    docs = spark.createDataFrame([(i, "some words " * i) for i in range(40)], "doc_id long, text string")
    out = seekable_ids.encode_to_files(spark, docs, TOKENIZER, 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    sent = plan.split("BroadcastHashJoin")[1:]
    assert sent and all("BuildRight" in part.splitlines()[0] for part in sent)


class Stream(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def one_file(docs=200):
    rng = np.random.default_rng(0)
    out = io.BytesIO()
    writer = seekable_ids.Writer(out)
    ids = {i: rng.integers(0, 49408, rng.integers(0, 3000)).astype("<u4").tobytes() for i in range(docs)}
    for i, x in ids.items():
        writer.add(i, x)
    writer.finish()
    return out.getvalue(), ids


def test_reader_decompresses_only_what_is_wanted():
    data, ids = one_file()
    reader = seekable_ids.Reader(Stream(data))
    touched = []
    plain = reader.frame
    reader.frame = lambda n: touched.append(n) or plain(n)
    assert dict(reader.read([3, 150])) == {i: ids[i] for i in (3, 150)}
    assert len(touched) == 2 < len(reader.frames)
    assert dict(reader.read()) == ids


def test_damage_is_noticed():
    data, _ = one_file()
    with pytest.raises(ValueError, match="cut short"):
        seekable_ids.Reader(Stream(data[:-3]))
    hurt = bytearray(data)
    hurt[20] ^= 1
    reader = seekable_ids.Reader(Stream(bytes(hurt)))
    with pytest.raises(ValueError, match="frame 0"):
        list(reader.read())


# -- WARC --------------------------------------------------------------------------


def brute_records(rows):
    first, out = {}, {}
    for page, _, html in sorted(rows):
        data = (html or "").encode()
        digest = hashlib.sha256(data).hexdigest()
        head = first.setdefault(digest, page)
        again = len(data) >= 100 and head != page
        out[page] = (len(data), digest, "revisit" if again else "response", head if again else None)
    return out


def archived(spark, pages):
    prepare(spark)
    out = warc_chunks.archive_and_read(spark, pages, 4).collect()
    assert len({r.page_id for r in out}) == len(out)
    return {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in out}


def test_archives_on_the_driver_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    assert archived(spark, pages) == brute_records([tuple(r) for r in pages.collect()])


def test_archive_edges(spark):
    long = "é" * 200_000
    rows = [
        (1, "http://a/", None), (2, None, ""), (3, "http://a/\nx: y ü", "<p>short</p>"),
        (4, "", "<p>short</p>"), (5, "u", long), (6, "u", long), (-7, "u", long), (8, "u", "x" * 65536),
        (9, "u", "y" * 65537), (10, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 20), (11, "u", "x" * 99), (12, "u", "x" * 99),
    ]
    schema = "page_id long, url string, html string, chunk_no string"
    pages = spark.createDataFrame([(*r, "z") for r in rows] + [(None, "u", "h", "z")], schema)
    assert archived(spark, pages) == brute_records(rows)
    assert archived(spark, pages.limit(0)) == {}


def test_chunks_carry_the_digest_so_far(spark):
    text = "abc" * 100_000
    pages = spark.createDataFrame([(1, "u", text)], "page_id long, url string, html string")
    rows = warc_chunks.with_digests(warc_chunks.chunk_table(pages)).orderBy("chunk_no").collect()
    assert len(rows) == 5 and [r.last for r in rows] == [False] * 4 + [True]
    upto = b""
    for r in rows:
        upto += bytes(r.data)
        assert (r.size, r.digest) == (len(upto), hashlib.sha256(upto).hexdigest())
    assert upto.decode() == text


def test_reading_chunks_back(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "q" * 150_000)], "page_id long, url string, html string")
    chunks = warc_chunks.with_digests(warc_chunks.chunk_table(pages))
    folder = f"{tmp_path}/w"
    files = warc_chunks.write_archives(chunks, warc_chunks.record_roles(chunks), folder)
    files = spark.createDataFrame(files.collect())
    back = warc_chunks.read_archives(files, folder).orderBy("chunk_no").collect()
    assert b"".join(bytes(r.data) for r in back) == b"q" * 150_000
    assert max(len(r.data) for r in back) == warc_chunks.CHUNK
    path = files.first().path
    data = open(path, "rb").read()
    reader = warc_chunks.ArchiveReader(pa.BufferReader(data[: len(data) // 2]))
    with pytest.raises(ValueError):
        for _, _, payload in reader.records():
            list(payload)


def test_repeated_ids_are_one_record(spark):
    prepare(spark)
    big = "<p>" + "text " * 40_000
    rows = [(1, "u", "a" * 200), (1, "u", "a" * 200), (2, "b", "x" * 300), (2, "a", big), (2, "a", big + "y"),
            (3, None, "a" * 200), (3, "z", None), (4, "q", None), (4, "q", ""), (None, "n", "lost"), (5, "p", "a" * 200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    pages = pages.selectExpr("*", "1 AS record_id", "2 AS n", "3 AS sha")
    out = {r.page_id: r for r in warc_chunks.archive_and_read(spark, pages, 3).collect()}
    assert sorted(out) == [1, 2, 3, 4, 5]
    chosen = min((big, big + "y"), key=lambda t: hashlib.sha256(t.encode()).hexdigest())
    html = {1: "a" * 200, 2: chosen, 3: "a" * 200, 4: "", 5: "a" * 200}
    for i, r in out.items():
        body = html[i].encode()
        assert (r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha256(body).hexdigest())
        assert (r.record_type, r.refers_to) == (("revisit", 1) if i in (3, 5) else ("response", None))
