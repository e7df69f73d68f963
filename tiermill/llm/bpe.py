"""Byte-level BPE: speculate with greedy longest matches, verify pairs of neighbours, merge exactly where that fails.

A sequence of tokens is the BPE encoding of its bytes if each token encodes to itself and each pair of
neighbours encodes to itself: the first merge across a border between two tokens would also happen in the
two alone. So the tokens that a greedy longest match proposes only need a check of their adjacent pairs, done
for all words of a slice of texts at once in numpy. Words with a pair that fails go through exact merging.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.rows import map_texts
from tiermill.llm.vocab import NEVER, Memo, Merges, Splitter, byte_letters, default_path

#: Contractions come before other signs; as no two of the rest begin alike, letters may come first.
PATTERN = r" ?\p{L}+| ?\p{N}+|'s|'t|'re|'ve|'m|'ll|'d| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space other than spaces and newlines.
OTHER_SPACE = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Chunks in a generation of a worker's memory, and the longest that it keeps.
CACHED, CACHED_CHARS = 400_000, 40


def ragged(text: str) -> bool:
    """Whether there is white space other than single spaces and newlines between other characters."""
    return not text or text[0] in " \n" or text[-1] in " \n" or any(x in text for x in ("  ", " \n", "\n ", "\n\n")) or OTHER_SPACE.search(text) is not None


class ByteBpe:
    def __init__(self, path: str):
        merges = Merges(path)
        self.merges = merges
        letters = byte_letters()
        byte_of = {c: b for b, c in enumerate(letters)}
        self.token_bytes = [b""] * (max(merges.size, *(i + 1 for i in merges.special.values())) if merges.special else merges.size)
        for token, i in merges.vocab.items():
            self.token_bytes[i] = bytes(byte_of[c] for c in token)
        for token, i in merges.special.items():
            self.token_bytes[i] = token.encode()
        self.splitter = Splitter(PATTERN, merges.special)
        self.base = np.array([merges.vocab[c] for c in letters], np.int64)
        # how each token came about: its two parts and its rank; -1 for a single byte
        self.part_left, self.part_right, self.born = (np.full(merges.size, -1, np.int64) for _ in range(3))
        rank = np.arange(len(merges.made))
        self.part_left[merges.made], self.part_right[merges.made], self.born[merges.made] = merges.left, merges.right, rank
        self._plant(self._stable())
        self.newline = self.base[10:11].astype("<u4").tobytes()
        self.whole = Memo(self.encode_chunks, CACHED // 4, CACHED_CHARS)
        self.spaced = Memo(lambda chunks: self.encode_chunks([" " + c for c in chunks]), CACHED, CACHED_CHARS)

    def _stable(self) -> np.ndarray:
        """Tokens whose own bytes are encoded as that one token; only these are proposed."""
        made = np.flatnonzero(self.born >= 0)
        born = self.born[made]
        stable = np.ones(self.merges.size, bool)
        stable[made] = self.compatible(self.part_left[made], self.part_right[made], born)
        while True:
            now = stable.copy()
            now[made] &= stable[self.part_left[made]] & stable[self.part_right[made]]
            if (now == stable).all():
                return stable
            stable = now

    def _plant(self, stable: np.ndarray) -> None:
        """A trie over the bytes of the stable tokens, as a sorted array of edges."""
        child: dict[int, int] = {b: b + 1 for b in range(256)}
        token_at = [-1, *self.base.tolist()]
        for i in np.flatnonzero(stable).tolist():
            node = 0
            for b in self.token_bytes[i]:
                edge = node << 8 | b
                node = child.get(edge, -1)
                if node < 0:
                    node = child[edge] = len(token_at)
                    token_at.append(-1)
            token_at[node] = i
        edges = np.fromiter(child, np.int64, len(child))
        order = np.argsort(edges)
        self.edges, self.children = edges[order], np.fromiter(child.values(), np.int64, len(child))[order]
        self.token_at = np.array(token_at, np.int64)
        # the first two levels, where most walks end, as a table: nodes 0 to 256, and bytes up to the end mark
        self.near = np.full(257 * 257, -1, np.int64)
        near = self.edges >> 8 <= 256
        self.near[(self.edges[near] >> 8) * 257 + (self.edges[near] & 255)] = self.children[near]

    def compatible(self, left: np.ndarray, right: np.ndarray, upto: np.ndarray | None = None) -> np.ndarray:
        """Whether each pair of tokens stays as it is when its bytes are encoded together.

        Walks back in time over the tokens at the border: the younger of the two is taken apart, until both are
        single bytes. A merge across the border beats the pair if its rank comes before the end of the left
        token, and not after the end of the right one; between equal ranks, the leftmost merge goes first.
        """
        result = np.ones(len(left), bool)
        at = np.arange(len(left))
        ends_left = np.full(len(left), NEVER) if upto is None else upto.copy()
        ends_right = ends_left.copy()
        while len(at):
            rank = self.merges.ranks(left, right)
            bad = (rank < ends_left) & (rank <= ends_right)
            result[at[bad]] = False
            born_left, born_right = self.born[left], self.born[right]
            on = ~bad & ((born_left >= 0) | (born_right >= 0))
            at, left, right, ends_left, ends_right, born_left, born_right = (x[on] for x in (at, left, right, ends_left, ends_right, born_left, born_right))
            back = born_left > born_right
            ends_left, ends_right = np.where(back, born_left, ends_left), np.where(back, ends_right, born_right)
            left, right = np.where(back, self.part_right[left], left), np.where(back, right, self.part_left[right])
        return result

    def propose(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The longest token that begins at each byte, and its length. A word ends at the value 256."""
        node, at = np.zeros(len(raw), np.int64), np.flatnonzero(raw < 256)
        token, length = np.full(len(raw), -1, np.int64), np.zeros(len(raw), np.int64)
        node = node[at]
        depth = 0
        while len(at):
            value = raw[at + depth]
            if depth < 2:
                child = self.near[node * 257 + value]
                found = child >= 0
                at, node = at[found], child[found]
            else:
                edge = node << 8 | value
                place = np.minimum(np.searchsorted(self.edges, edge), len(self.edges) - 1)
                found = (self.edges[place] == edge) & (value < 256)
                at, node = at[found], self.children[place[found]]
            depth += 1
            ends = self.token_at[node] >= 0
            token[at[ends]], length[at[ends]] = self.token_at[node[ends]], depth
        return token, length

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, as little-endian unsigned 32-bit integers."""
        coded = [w.encode() for w in words]
        raw = self._joined(coded)
        token, length = self.propose(raw)
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        first = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        starts = np.zeros(len(raw), bool)  # of proposed tokens: from each word's first byte, jump by lengths
        cursor = first
        while len(cursor):
            cursor = cursor[raw[cursor] < 256]
            starts[cursor] = True
            cursor = cursor + length[cursor]
        at = np.flatnonzero(starts)
        tokens, word = token[at], np.searchsorted(first, at, side="right") - 1
        inner = np.flatnonzero(word[1:] == word[:-1])
        pair = tokens[inner] * self.merges.size + tokens[inner + 1]
        pairs, which = np.unique(pair, return_inverse=True)
        fine = self.compatible(pairs // self.merges.size, pairs % self.merges.size)[which]
        failing = np.unique(word[inner[~fine]])
        ids = tokens.astype("<u4")
        cuts = np.searchsorted(word, np.arange(len(coded) + 1))
        flat = ids.tobytes()
        result = [flat[4 * a : 4 * b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        if len(failing):
            symbols, owner = self.merge([coded[i] for i in failing.tolist()])
            cuts, flat = np.searchsorted(owner, np.arange(len(failing) + 1)), symbols.astype("<u4").tobytes()
            for i, a, b in zip(failing.tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                result[i] = flat[4 * a : 4 * b]
        return result

    @staticmethod
    def _joined(coded: list[bytes]) -> np.ndarray:
        """Bytes of all words, each followed by 256."""
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        raw = np.full(int(sizes.sum()) + len(coded), 256, np.int64)
        inside = np.ones(len(raw), bool)
        inside[np.cumsum(sizes + 1) - 1] = False
        raw[inside] = np.frombuffer(b"".join(coded), np.uint8)
        return raw

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Exact: always the pair of lowest rank, the leftmost first. Symbols of all words, and their words' places."""
        owner = np.repeat(np.arange(len(words)), np.fromiter(map(len, words), np.int64, len(words)))
        return self.merges.merge_all(self.base[np.frombuffer(b"".join(words), np.uint8)], owner)

    def encode_chunks(self, chunks: list[str]) -> list[bytes]:
        words = [self.splitter.words(c) for c in chunks]
        distinct = list(set().union(*words))
        coded = dict(zip(distinct, self.encode_words(distinct), strict=True)) if distinct else {}
        return [b"".join(map(coded.__getitem__, ws)) for ws in words]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit integers. Special strings in a text give their own ids.

        A single space between two other characters always begins a pre-token, and a single newline there is one.
        Texts with no other white space are cut at these, and ids are remembered for what lies between.
        """
        cut, whole, spaced = [], set(), set()
        for text in texts:
            parts = []
            for piece in self.splitter.pieces(text):
                if piece in self.splitter.special:
                    parts.append(np.array([self.splitter.special[piece]], "<u4").tobytes())
                elif ragged(piece):
                    parts.append(piece)
                    whole.add(piece)
                else:
                    lines = [line.split(" ") for line in piece.split("\n")]
                    for line in lines:
                        whole.add(line[0])
                        spaced.update(line[1:])
                    parts.append(lines)
            cut.append(parts)
        first, later = self.whole.fill(whole), self.spaced.fill(spaced)
        out = []
        for parts in cut:
            coded = []
            for part in parts:
                if isinstance(part, list):
                    coded.append(self.newline.join([first[line[0]] + b"".join(map(later.__getitem__, line[1:])) for line in part]))
                else:
                    coded.append(part if isinstance(part, bytes) else first[part])
            out.append(b"".join(coded))
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the text; bytes that are none become U+FFFD."""
        joined = b"".join(map(self.token_bytes.__getitem__, ids.tolist()))
        return joined.decode(errors="replace").encode()


@lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    return ByteBpe(path)


def encode_decode(docs: DataFrame, path: str | None = None, with_ids: bool = False, keep: Sequence[str] = ("doc_id",), text_col: str = "text") -> DataFrame:
    """Encodes each text and decodes it again: the columns `keep`, n_tokens, ids_sha256, decoded_sha256, and ids on request.

    One row per row of `docs`, whatever the ids: repeated rows are encoded alike, a null id stays null. A null
    text is an empty one, without tokens. Texts are encoded whole. Other columns are not read.
    """
    path = path or default_path("byte_bpe_50k.json")
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")

    def work(texts: list[str]) -> dict:
        bpe = load(path)
        coded = bpe.encode(texts)
        out = {
            "n_tokens": [len(c) // 4 for c in coded],
            "ids_sha256": [hashlib.sha256(c).hexdigest() for c in coded],
            "decoded_sha256": [hashlib.sha256(bpe.decode(np.frombuffer(c, "<u4"))).hexdigest() for c in coded],
        }
        if with_ids:
            out["ids"] = [np.frombuffer(c, "<i4") for c in coded]
        return out

    return map_texts(docs, work, schema, {name: F.col(name) for name in keep}, text_col)
