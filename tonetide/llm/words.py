"""Words of many texts at once as 64-bit hashes, with NumPy inside a task.

A word is a run of bytes other than space and 0x09-0x0D; in UTF-8 none of these
occurs inside a longer character. Hashes depend on the bytes alone, so they are
equal in every task. Two different words have equal hashes with a chance of about
2**-64.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from tonetide.llm.common import offsets

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the splitmix64 finisher); one to one."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power_table(length: int) -> np.ndarray:
    global _powers
    if len(_powers) < length:
        steps = np.full(max(length, 2 * len(_powers)), _BASE, np.uint64)
        steps[0] = 1
        _powers = np.cumprod(steps)
    return _powers


@dataclass
class Words:
    """Words of some texts: their hashes, byte ranges, and each text's first word."""

    hashes: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    first: np.ndarray  # one more than there are texts

    def of(self, text: int) -> np.ndarray:
        return self.hashes[self.first[text] : self.first[text + 1]]


def words_of(texts: pa.StringArray, lower: bool = True, gaps: np.ndarray = _SPACE) -> Words:
    """Hash the words of every text; a null has none. Byte ranges count from its text's start.

    ``gaps`` tells for each byte value whether it separates words.
    """
    at = offsets(texts)
    size = int(at[-1] - at[0])
    if not size or texts.buffers()[2] is None:
        none = np.zeros(0, np.int64)
        return Words(none.astype(np.uint64), none, none, np.zeros(len(texts) + 1, np.int64))
    data = np.frombuffer(texts.buffers()[2], np.uint8)[at[0] : at[-1]]
    at = at - at[0]
    ink = ~gaps[data]
    edge = np.zeros(size + 1, bool)
    edge[at] = True
    begins = ink.copy()
    begins[1:] &= ~ink[:-1] | edge[1:-1]
    ends = ink.copy()
    ends[:-1] &= ~ink[1:] | edge[1:-1]
    begin = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    if not len(begin):
        none = np.zeros(0, np.int64)
        return Words(none.astype(np.uint64), none, none, np.zeros(len(texts) + 1, np.int64))
    length = end - begin
    table = _power_table(int(length.max()))
    run = np.concatenate([[0], np.cumsum(length)[:-1]])
    inside = np.arange(int(length.sum())) - np.repeat(run, length)
    letters = data[ink]
    if lower:
        letters = _LOWER[letters]
    hashes = np.add.reduceat((letters.astype(np.uint64) + np.uint64(1)) * table[inside], run)
    first = np.searchsorted(begin, at)
    owner = np.repeat(at[:-1], np.diff(first))
    return Words(mix(hashes + length.astype(np.uint64)), begin - owner, end - owner, first)


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash for every run of ``k`` words of one text."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    # Runs twice as long from two runs in a row, and one word more where k is odd by then.
    table = _power_table(k)
    total, size = hashes, 1
    for bit in bin(k)[3:]:
        total = total[:-size] + total[size:] * table[size]
        size *= 2
        if bit == "1":
            total = total[: len(hashes) - size] + hashes[size:] * table[size]
            size += 1
    return mix(total)


def shingle_set(hashes: np.ndarray, k: int) -> np.ndarray:
    """Distinct runs of ``k`` words, sorted; with fewer words, all of them as one run."""
    if 0 < len(hashes) < k:
        return windows(hashes, len(hashes))
    return np.unique(windows(hashes, k))
