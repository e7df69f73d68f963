"""Token counts by rank-synchronous merging: each sequence's lowest-ranked pair is merged in all of them at once.

The pre-tokens of a slice of texts that are new to the worker lie in one flat array of symbols with the number
of their sequence. Each round finds the lowest rank in every sequence, merges all its occurrences from left to
right, and lets sequences without a pair go with the number of symbols that survived.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.rows import map_texts
from tiermill.llm.vocab import Memo, Merges, Splitter, byte_letters, default_path, fold

PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: White space as the tokenizer sees it; str.split() also cuts at the separators 1C to 1F.
SPACE, SEPARATOR = regex.compile(r"\s+"), regex.compile("[\x1c-\x1f]")
#: Chunks in a generation of a worker's memory, and the longest that it keeps.
CACHED, CACHED_CHARS = 500_000, 40
#: A row whose count is greater is over the limit.
LIMIT = 2048


class WordCounts:
    def __init__(self, path: str):
        self.merges = Merges(path)
        letters = byte_letters()
        self.inner = np.array([self.merges.vocab[c] for c in letters], np.int64)
        self.last = np.array([self.merges.vocab[c + self.merges.suffix] for c in letters], np.int64)
        self.splitter = Splitter(PATTERN, self.merges.special)
        self.chunks = Memo(self.count_chunks, CACHED, CACHED_CHARS)

    def count_words(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0, np.int64)
        coded = [w.encode() for w in words]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        raw = np.frombuffer(b"".join(coded), np.uint8)
        symbols = self.inner[raw]
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.last[raw[ends]]
        owner = np.repeat(np.arange(len(coded)), sizes)
        return np.bincount(self.merges.merge_all(symbols, owner)[1], minlength=len(coded))

    def count_chunks(self, chunks: list[str]) -> list[int]:
        """Tokens of pieces without white space inside."""
        words = [self.splitter.words(c) for c in chunks]
        counts = self.count_words([w for ws in words for w in ws]).tolist()
        ends = np.cumsum([len(ws) for ws in words]).tolist()
        return [sum(counts[e - len(ws) : e]) for ws, e in zip(words, ends, strict=True)]

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text; a special string in it is one token. Matches never span white space, so the text
        is cut there first, and counts are remembered for what lies between."""
        split, extra = [], []
        for text in texts:
            pieces = self.splitter.pieces(text)
            chunks: list[str] = []
            for piece in pieces[::2]:
                folded = fold(piece)
                chunks += SPACE.split(folded) if SEPARATOR.search(folded) else folded.split()
            split.append(chunks)
            extra.append(len(pieces) // 2)
        known = self.chunks.fill(set().union(*split))
        return [sum(map(known.__getitem__, chunks)) + more for chunks, more in zip(split, extra, strict=True)]


@lru_cache(maxsize=2)
def load(path: str) -> WordCounts:
    return WordCounts(path)


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    One row per row of `docs`; repeated rows and null ids are kept. A null or empty text has no bytes and no
    tokens. Texts are counted whole. Other columns are not read.
    """
    path = path or default_path("word_bpe_49k.json")

    def work(texts: list[str]) -> dict:
        counts = load(path).count(texts)
        return {"n_bytes": [len(t.encode()) for t in texts], "n_tokens": counts, "over_limit": [c > limit for c in counts]}

    return map_texts(docs, work, "n_bytes long, n_tokens long, over_limit boolean", {"doc_id": F.col(id_col)}, text_col)
