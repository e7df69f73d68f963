"""Reads the vocabulary files of public tokenizers and splits texts as those tokenizers do."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Callable, Iterable
from functools import lru_cache

import numpy as np
import regex
import tokenizers

#: Greater than any rank.
NEVER = np.iinfo(np.int64).max


def default_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes stand for themselves,
    the others for the code points from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    letters = {b: chr(b) for b in shown}
    hidden = [b for b in range(256) if b not in letters]
    letters |= {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [letters[b] for b in range(256)]


@lru_cache(maxsize=1)
def disputed() -> regex.Pattern:
    """Characters whose class the `regex` module and the tokenizers' engine may see differently.

    Within the basic plane both are asked; beyond it every character counts as disputed.
    """
    plane = "".join(map(chr, [*range(1, 0xD800), *range(0xE000, 0x10000)]))
    odd = set()
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        theirs = tokenizers.pre_tokenizers.Split(tokenizers.Regex(kind), "removed", invert=True)
        odd |= set("".join(piece for piece, _ in theirs.pre_tokenize_str(plane))) ^ set(regex.findall(kind, plane))
    return regex.compile("[" + "".join(map(regex.escape, sorted(odd))) + "\U00010000-\U0010ffff]")


class Splitter:
    """Pre-tokens of a text: matches of a pattern in what lies between special strings."""

    def __init__(self, pattern: str, special: dict[str, int]):
        self.pattern = regex.compile(pattern)
        self.by_library = tokenizers.pre_tokenizers.Split(tokenizers.Regex(pattern), "removed", invert=True)
        self.special = special
        longest_first = sorted(special, key=len, reverse=True)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if special else None

    def pieces(self, text: str) -> list[str]:
        """`text` cut at special strings; these stay, as pieces of their own."""
        if self.cut is None or not any(s in text for s in self.special):
            return [text]
        return self.cut.split(text)

    def words(self, piece: str) -> list[str]:
        if piece.isascii() or not disputed().search(piece):
            return self.pattern.findall(piece)
        return [word for word, _ in self.by_library.pre_tokenize_str(piece)]


def fold(piece: str) -> str:
    """NFC and lower case, character by character: a final sigma is treated like any other."""
    if piece.isascii():
        return piece.lower()
    return unicodedata.normalize("NFC", piece).replace("Σ", "σ").lower()


class Memo:
    """What was worked out for words, in two generations: when the young one is full, it becomes the old one,
    and the old one goes but for words that are met again. `limit` bounds memory, not results."""

    def __init__(self, work: Callable[[list[str]], Iterable], limit: int, longest: int):
        self.work, self.limit, self.longest = work, limit, longest
        self.young: dict[str, object] = {}
        self.old: dict[str, object] = {}
        self.passing: list[str] = []

    def fill(self, wanted: set[str]) -> dict[str, object]:
        """A mapping with all wanted words, good until the next call."""
        for word in self.passing:
            del self.young[word]
        if len(self.young) > self.limit:
            self.young, self.old = {}, self.young
        young, old = self.young, self.old
        new = [w for w in wanted if w not in young]
        if old:
            young.update((w, old[w]) for w in new if w in old)
            new = [w for w in new if w not in old]
        if new:
            young.update(zip(new, self.work(new), strict=True))
        self.passing = [w for w in new if len(w) > self.longest]
        return young


class Merges:
    """Symbols, and the pairs that merge: rank is the place in the list of merges."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        self.vocab: dict[str, int] = whole["model"]["vocab"]
        self.suffix: str = whole["model"]["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in whole["model"]["merges"]]
        left = np.array([self.vocab[a] for a, _ in pairs], np.int64)
        right = np.array([self.vocab[b] for _, b in pairs], np.int64)
        made = np.array([self.vocab[a + b] for a, b in pairs], np.int64)
        self.size = max(self.vocab.values()) + 1
        self.left, self.right, self.made = left, right, made
        key = left * self.size + right
        self.order = np.argsort(key, kind="stable")
        self.keys = key[self.order]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Of each pair; NEVER where it doesn't merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], NEVER)

    def merge_all(self, symbols: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of many sequences: those of a flat array whose owners, in ascending order, are equal.

        Each round merges the lowest-ranked pair of every sequence, all its occurrences from left to right, and
        lets sequences without a pair go. Returns the symbols that survive and their owners, in order.
        """
        done = []
        while len(symbols):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            rank = np.full(len(symbols), NEVER)
            inside = np.flatnonzero(owner[1:] == owner[:-1])
            rank[inside] = self.ranks(symbols[inside], symbols[inside + 1])
            lengths = np.diff(np.append(first, len(symbols)))
            target = np.repeat(np.minimum.reduceat(rank, first), lengths)
            over = target == NEVER
            done.append((symbols[over], owner[over]))
            # of occurrences that overlap, as in a a a, every second one counts
            at = np.flatnonzero((rank == target) & ~over)
            run = np.flatnonzero(np.append(True, np.diff(at) != 1)) if len(at) else at
            since = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
            at = at[since % 2 == 0]
            symbols[at] = self.made[rank[at]]
            keep = ~over
            keep[at + 1] = False
            symbols, owner = symbols[keep], owner[keep]
        if not done:
            return symbols, owner
        symbols, owner = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(owner, kind="stable")
        return symbols[order], owner[order]
