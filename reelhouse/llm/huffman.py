"""Canonical length-limited Huffman codes over arrays of ids.

Lengths come from package-merge and are optimal under the limit. Codes are canonical, so the lengths
alone describe a code. Encoding and decoding work on whole arrays: bits are packed into words by
sums over runs of codes that meet in a word, and decoding follows all checkpoints of a block at once, one table
lookup a step.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import numpy as np

LIMIT = 20
# Every so many ids a block states the offset of its next bit.
CHECKPOINT = 256


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Length of each symbol's code; all counts are positive."""
    n = len(counts)
    if n <= 1:
        return np.ones(n, np.int64)
    if n > 1 << limit:
        raise ValueError(f"{n} symbols do not fit codes of {limit} bits")
    order = np.argsort(counts, kind="stable")
    weights = np.asarray(counts, np.float64)[order]
    row, single = weights, [np.ones(n, bool)]
    for _ in range(limit - 1):
        pairs = row[: len(row) // 2 * 2].reshape(-1, 2).sum(axis=1)
        both = np.concatenate([weights, pairs])
        at = np.argsort(both, kind="stable")
        row = both[at]
        single.append(at < n)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for flags in reversed(single):
        own = int(np.count_nonzero(flags[:take]))
        lengths[:own] += 1
        take = 2 * (take - own)
    made = np.empty(n, np.int64)
    made[order] = lengths
    return made


@dataclass(frozen=True)
class Code:
    """Symbols in rising order and the lengths of their codes."""

    symbols: np.ndarray
    lengths: np.ndarray

    @cached_property
    def _order(self) -> np.ndarray:
        return np.lexsort((self.symbols, self.lengths))

    @cached_property
    def longest(self) -> int:
        return int(self.lengths.max(initial=1))

    @cached_property
    def _by_symbol(self) -> tuple[np.ndarray, np.ndarray]:
        size = int(self.symbols.max(initial=0)) + 1
        codes, lengths = np.zeros(size, np.uint64), np.zeros(size, np.int64)
        # A canonical code is where its share of the table begins.
        share = 1 << (self.longest - self.lengths[self._order])
        begin = np.cumsum(share) - share
        symbols = self.symbols[self._order]
        lengths[symbols] = self.lengths[self._order]
        codes[symbols] = begin >> (self.longest - self.lengths[self._order])
        return codes, lengths

    @cached_property
    def _table(self) -> np.ndarray:
        """For each value of the next `longest` bits: symbol << 5 | length."""
        lengths = self.lengths[self._order]
        entries = (self.symbols[self._order] << 5 | lengths).astype(np.uint32)
        table = np.zeros(1 << self.longest, np.uint32)
        filled = np.repeat(entries, 1 << (self.longest - lengths))
        table[: len(filled)] = filled
        return table

    def encode(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """Payload and the bit offset of every `CHECKPOINT`-th id."""
        if not len(ids):
            return b"", np.empty(0, np.int64)
        codes, lengths = self._by_symbol
        n_bits = lengths[ids]
        ends = np.cumsum(n_bits)
        at = ends - n_bits
        word, offset = at >> 5, at & 31
        value = codes[ids] << (64 - offset - n_bits).astype(np.uint64)
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        total = int(ends[-1])
        words = np.zeros((total + 31) // 32 + 1, np.uint64)
        words[word[first]] += np.add.reduceat(value >> np.uint64(32), first)
        words[word[first] + 1] += np.add.reduceat(value & np.uint64(0xFFFFFFFF), first)
        return words.astype(">u4").tobytes()[: (total + 7) // 8], at[::CHECKPOINT]

    def decode(self, payload: bytes, checkpoints: np.ndarray, n: int) -> np.ndarray:
        """The `n` ids of a block."""
        if not n:
            return np.empty(0, np.int64)
        raw = np.frombuffer(payload + b"\0\0\0\0", np.uint8).astype(np.uint32)
        window = raw[:-3] << 24 | raw[1:-2] << 16 | raw[2:-1] << 8 | raw[3:]
        at, last = checkpoints.astype(np.int64), len(window) - 1
        out = np.empty((len(at), min(CHECKPOINT, n)), np.uint32)
        drop = np.uint32(32 - self.longest)
        for step in range(out.shape[1]):
            bits = window[np.minimum(at >> 3, last)] << (at & 7).astype(np.uint32)
            entry = self._table[bits >> drop]
            out[:, step] = entry >> 5
            at += entry & 31
        return out.reshape(-1)[:n]
