"""Byte-level BPE by replaying the merges over a corpus of words.

Each task takes the documents of its partition as a corpus, block after block. The
distinct words of a block (matches of the splitting pattern) are laid out in one
array of symbols. An inverted index leads from a merge's rank to the positions of
its pair; merges are applied in rank order to all their positions, and each
application touches only the two neighbouring pairs. As a merge never crosses a word
and ranks decide everything, the result for a word doesn't depend on the block it is
in, so blocks may be cut anywhere and need no exchange. Documents are then put
together from the ids of their words.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonetide.llm.common import offsets, pieces

# Bytes of text whose words are replayed together: the more, the fewer are replayed twice,
# and the more memory a worker takes (0.47 GB with 8 MB, 0.30 GB with 3 MB, as quick).
BLOCK_BYTES = 3 << 20
# Bytes of words that are merged many at a time.
SHORT = 64
# Stretches and words a task remembers between blocks; others are replayed again.
CACHE_WORDS = 250_000
CACHE_CHARS = 64
# White space as the tokenizer library's patterns see it (Unicode White_Space).
_WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

_replayers: dict[tuple[str, str], Replayer] = {}


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ranks from a ``.tiktoken`` file."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Replayer:
    """Encodes words and texts by merge replay; made once for each Python worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        pattern = pattern.replace(r"[^\s", f"[^{_WHITE}").replace(r"\S", f"[^{_WHITE}]")
        self.pattern = regex.compile(pattern.replace(r"\s", f"[{_WHITE}]"))
        self.doubled = regex.compile(f"[{_WHITE}]{{2}}")
        # The rank, which is also the id, of the merge of every pair that has one.
        self.shift = max(ranks.values()).bit_length()
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left << self.shift | right] = rank
        self.keys = np.array(sorted(self.pairs), np.int64)
        self.values = np.array([self.pairs[k] for k in self.keys.tolist()], np.int64)
        # The same for pairs of single bytes.
        keys = (self.single[:, None] << self.shift) | self.single
        self.byte_pairs = np.array([self.pairs.get(k, -1) for k in keys.ravel().tolist()], np.int64)
        # Ids of words, and of stretches of several words, from earlier blocks.
        self.known: dict[str, bytes] = {}

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, merging over all words together in rank order."""
        out: list[bytes | None] = [None] * len(words)
        short, long = [], []
        for i, word in enumerate(words):
            rank = self.ranks.get(word)
            if rank is None:
                (short if len(word) <= SHORT else long).append(i)
            else:
                out[i] = rank.to_bytes(4, "little")
        for chosen, merge in ((short, self._merge_short), (long, self._merge_long)):
            if chosen:
                found = self._merged([words[i] for i in chosen], merge)
                for i, ids in zip(chosen, found, strict=True):
                    out[i] = ids
        return out

    def _merged(self, words: list[bytes], merge) -> list[bytes]:
        """Ids of words that are no tokens: laid out in one array, merged, and cut apart."""
        # A word's bytes are followed by a place for its end, where nothing merges.
        letters = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
        ends = np.cumsum([len(word) + 1 for word in words]) - 1
        n = len(letters)
        laid = self.single[letters]
        laid[ends] = -1
        first = np.full(n, -1)
        first[:-1] = self.byte_pairs[letters[:-1].astype(np.int64) * 256 + letters[1:]]
        first[ends] = -1
        first[ends - 1] = -1
        places = np.flatnonzero(first >= 0)
        places = places[np.argsort(first[places], kind="stable")]
        known, cuts = np.unique(first[places], return_index=True)
        index: dict[int, list[int]] = {
            rank: group.tolist()
            for rank, group in zip(known.tolist(), np.split(places, cuts[1:]), strict=False)
        }
        laid = merge(laid, first, index, ends)
        # Symbols that were taken in are marked; the others, in order, are the ids.
        stays = laid >= 0
        ids = laid[stays].astype("<u4").tobytes()
        upto = [0, *(4 * np.cumsum(stays)[ends]).tolist()]
        return [ids[start:end] for start, end in zip(upto, upto[1:])]

    def _merge_short(self, symbols, at_rank, index, ends) -> np.ndarray:
        """Symbols after all merges; a rank is applied to many words at once.

        Of a word that has a pair twice only the first place is merged, as that may make
        a pair that comes earlier; the rest waits for the rank's next turn.
        """
        n = len(symbols)
        word_of = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=-1))
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        keys, values, shift, last = self.keys, self.values, self.shift, len(self.keys) - 1
        waiting = list(index)
        heapq.heapify(waiting)
        while waiting:
            rank = heapq.heappop(waiting)
            if rank not in index:
                continue
            places = np.array(sorted(set(index.pop(rank))))
            places = places[at_rank[places] == rank]
            if not len(places):
                continue
            words = word_of[places]
            again = words[1:] == words[:-1]
            if again.any():
                index[rank] = places[1:][again].tolist()
                heapq.heappush(waiting, rank)
                places = places[np.concatenate([[True], ~again])]
            # The symbol at a place takes in the one after it.
            taken = after[places]
            behind = after[taken]
            symbols[places] = rank
            symbols[taken] = -1
            after[places] = behind
            before[behind] = places
            at_rank[taken] = -1
            # Only the two neighbouring pairs change. In front of the first word is the end
            # of the last one, so a place before the array is an end as well.
            touched = np.concatenate([before[places], places])
            left = symbols[touched]
            right = np.concatenate([symbols[places], symbols[behind]])
            pair = np.where((left >= 0) & (right >= 0), (left << shift) | right, -1)
            at = np.minimum(np.searchsorted(keys, pair), last)
            new = np.where(keys[at] == pair, values[at], -1)
            at_rank[touched] = new
            fits = new >= 0
            for place, rank in zip(touched[fits].tolist(), new[fits].tolist()):
                found = index.get(rank)
                if found is None:
                    index[rank] = [place]
                    heapq.heappush(waiting, rank)
                else:
                    found.append(place)
        return symbols

    def _merge_long(self, symbols, at_rank, index, ends) -> np.ndarray:
        """The same one place after the other, for words in which a pair may be very often."""
        n = len(symbols)
        symbols, at_rank = symbols.tolist(), at_rank.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pairs, shift = self.pairs.get, self.shift
        waiting = list(index)
        heapq.heapify(waiting)
        while waiting:
            rank = heapq.heappop(waiting)
            positions = index.pop(rank, None)
            if positions is None:
                continue
            positions.sort()
            for done, i in enumerate(positions):
                if at_rank[i] != rank:
                    continue
                # The symbol at i takes in the one after it, j.
                j = after[i]
                k = after[j]
                symbols[i], symbols[j] = rank, -1
                after[i] = k
                before[k] = i
                at_rank[j] = -1
                lower = False
                new = -1
                if i and (left := symbols[h := before[i]]) >= 0:
                    at_rank[h] = new = pairs(left << shift | rank, -1)
                    if new >= 0:
                        found = index.get(new)
                        if found is None:
                            index[new] = [h]
                            heapq.heappush(waiting, new)
                        else:
                            found.append(h)
                        lower = new <= rank
                right = symbols[k]
                at_rank[i] = new = pairs(rank << shift | right, -1) if right >= 0 else -1
                if new >= 0:
                    found = index.get(new)
                    if found is None:
                        index[new] = [i]
                        heapq.heappush(waiting, new)
                    else:
                        found.append(i)
                    lower |= new <= rank
                if lower:
                    # A merge that comes first has appeared; take up the rest after it.
                    rest = positions[done + 1 :]
                    if rest:
                        if rank not in index:
                            heapq.heappush(waiting, rank)
                        index.setdefault(rank, []).extend(rest)
                    break
        return np.array(symbols)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text.

        Where no two white-space characters meet, the pattern can be matched
        between single spaces, so a text is cut there and each distinct stretch is
        matched once.
        """
        split = []
        for text in texts:
            if self.doubled.search(text):
                split.append(self._coarse(text))
            else:
                parts = text.split(" ")
                split.append(parts[:1] + [" " + part for part in parts[1:]])
        known = self.known
        stretches = set().union(*split)
        ids = {s: known[s] for s in stretches if s in known}
        # A stretch is mostly one word, and then needs no ids of its own.
        matches = {s: self.pattern.findall(s) for s in stretches if s not in ids}
        ids.update({w: known[w] for ws in matches.values() for w in ws if w in known})
        fresh = list({w for ws in matches.values() for w in ws if w not in ids})
        coded = self.replay([w.encode("utf-8", "surrogatepass") for w in fresh])
        new = dict(zip(fresh, coded, strict=True))
        ids.update(new)
        for s, ws in matches.items():
            if len(ws) != 1 or ws[0] != s:
                ids[s] = new[s] = b"".join([ids[w] for w in ws])
        _remember(known, new)
        return [np.frombuffer(b"".join([ids[s] for s in parts]), "<u4") for parts in split]

    def _coarse(self, text: str) -> list[str]:
        """Cut a text in front of each single space that stands between other characters."""
        out, start = [], 0
        for m in self.cuts.finditer(text):
            out.append(text[start : m.start()])
            start = m.start()
        out.append(text[start:])
        return out

    @property
    def cuts(self):
        if not hasattr(self, "_cuts"):
            self._cuts = regex.compile(f"(?<=[^{_WHITE}]) (?=[^{_WHITE}])")
        return self._cuts

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def _remember(known: dict, new: dict) -> None:
    room = CACHE_WORDS - len(known)
    if room > 0:
        known.update(islice(((k, v) for k, v in new.items() if len(k) <= CACHE_CHARS), room))


def replayer(path: str, pattern: str) -> Replayer:
    key = (path, pattern)
    if key not in _replayers:
        _replayers[key] = Replayer(load_ranks(path), pattern)
    return _replayers[key]


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in blocks of about BLOCK_BYTES of text; a longer text is a block by itself."""
    waiting, size = [], 0
    for piece in pieces(batches):
        at = offsets(piece.column(1))
        more = int(at[-1] - at[0])
        if waiting and size + more > BLOCK_BYTES:
            yield pa.concat_batches(waiting)
            waiting, size = [], 0
        waiting.append(piece)
        size += more
    if waiting:
        yield pa.concat_batches(waiting)


def encode_decode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Every row's ``doc_id``, ``ids`` (binary, little-endian unsigned 32-bit), ``decoded`` bytes.

    Null texts count as empty and have no ids. Each row is encoded by itself, so
    repeated rows, ties and null ids need no rule; an empty table gives an empty
    result. Other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = replayer(ranks, pattern)
        for batch in blocks(batches):
            coded = model.encode([text or "" for text in batch.column(1).to_pylist()])
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([ids.tobytes() for ids in coded], pa.binary()),
                    pa.array([model.decode(ids) for ids in coded], pa.binary()),
                ],
                ["doc_id", "ids", "decoded"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, ids binary, decoded binary"
    )


def digests(coded: DataFrame) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` of encoded rows."""
    return coded.select(
        "doc_id",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
