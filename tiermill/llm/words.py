"""The words of many texts as flat numpy arrays: runs of bytes other than 20 and 09 to 0D."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SPACES = b" \t\n\x0b\x0c\r"
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Factors of the hashes: odd numbers of 64 bits.
P, MIX_A, MIX_B = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB


@lru_cache(maxsize=8)
def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n - 1, P, np.uint64)]).astype(np.uint64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX_A)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX_B)
    return x ^ (x >> np.uint64(31))


class Words:
    """hashes: of every word; doc: which text it belongs to; raw: all bytes, each text followed by a space."""

    def __init__(self, coded: list[bytes]):
        self.raw = np.frombuffer(b" ".join(coded) + b" ", np.uint8)
        is_space = np.zeros(256, bool)
        is_space[list(SPACES)] = True
        inside = ~is_space[self.raw]
        edge = np.flatnonzero(np.diff(np.concatenate([[False], inside]).astype(np.int8)))  # the last byte is a space
        self.starts, self.ends = edge[::2], edge[1::2]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        self.doc_starts = np.concatenate([[0], np.cumsum(sizes + 1)])
        self.first = np.searchsorted(self.starts, self.doc_starts)  # of each text, its first word
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(coded)), self.counts)
        lengths = self.ends - self.starts
        self.hashes = np.zeros(len(self.starts), np.uint64)
        if len(lengths):
            where = np.flatnonzero(inside)
            within = np.arange(len(where)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            size = 1 << int(lengths.max()).bit_length()
            parts = (self.raw[where].astype(np.uint64) + np.uint64(1)) * _powers(max(size, 64))[within]
            self.hashes = mix(np.add.reduceat(parts, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64))

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of n words of one text, and the first word of each."""
        at = np.arange(max(0, len(self.hashes) - n + 1))
        at = at[self.doc[at] == self.doc[at + n - 1]] if len(at) else at
        joined = np.zeros(len(at), np.uint64)
        for i in range(n):
            joined = joined * np.uint64(P) + self.hashes[at + i]
        return mix(joined), at
