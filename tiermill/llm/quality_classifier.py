"""Quality by supervised subword embeddings.

Each word is the mean of the learned vectors of the hashed word and of its hashed character n-grams, each document
the mean of its words, and a softmax layer reads the document's vector. Vectors and layer are trained together by
stochastic gradient descent in numpy.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.labelled import Sparse, fold_of, sample
from tiermill.llm.rows import map_texts
from tiermill.llm.vocab import Memo

#: Hashed n-grams, length of their vectors, lengths of character n-grams.
PLACES, WIDTH, GRAMS = 1 << 15, 8, (2, 3)
#: Labelled rows that training takes at most, its steps at least, rows in a step, and its rate.
MOST_ROWS, STEPS, BATCH, RATE = 3_000, 1_500, 32, 1.0
#: A word that equals the one before counts as this word too.
REPEATED = "\x00again"
FOLDS, HELD_OUT, GOOD = 4, 2, 0.7
CACHED, CACHED_CHARS = 500_000, 40


def word_places(word: str) -> list[int]:
    marked = f"<{word}>".encode()
    grams = {marked, *(marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1))}
    return [zlib.crc32(g) % PLACES for g in sorted(grams)]


def words_of(text: str) -> list[str]:
    words = text.split()
    return words + [REPEATED for a, b in zip(words, words[1:], strict=False) if a == b]


def features(texts: list[str]) -> dict[str, list]:
    """The places of each text, and how much each counts: a word's places share its part."""
    places, weights = [], []
    for text in texts:
        total = np.zeros(PLACES, np.float32)
        words = words_of(text)
        counts: dict[str, int] = {}
        for word in words:
            counts[word] = counts.get(word, 0) + 1
        for word, count in counts.items():
            at = word_places(word)
            np.add.at(total, at, count / (len(words) * len(at)))
        met = np.flatnonzero(total)
        places.append(met)
        weights.append(total[met])
    return {"places": places, "weights": weights}


class Model:
    """vectors (PLACES, WIDTH), layer (WIDTH, 2), bias (2)."""

    def __init__(self, vectors: np.ndarray, layer: np.ndarray, bias: np.ndarray):
        self.vectors, self.layer, self.bias = vectors, layer, bias

    def pull(self) -> np.ndarray:
        """How far each place moves the difference of the two outputs; the rest of the model is linear."""
        return self.vectors @ (self.layer[:, 1] - self.layer[:, 0])


def train(places: list, weights: list, labels: np.ndarray, seed: int = 0) -> Model:
    random = np.random.default_rng(seed)
    n, good = len(labels), int(labels.sum())
    model = Model(random.uniform(-1, 1, (PLACES, WIDTH)) / WIDTH, random.uniform(-1, 1, (WIDTH, 2)), np.array([0.0, np.log((good + 1) / (n - good + 1))]))
    if not n:
        model.layer[:] = 0
        return model
    rows = Sparse(places, weights)
    rounds = -(-STEPS * BATCH // n)
    step = 0
    for _ in range(rounds):
        order = random.permutation(n)
        for start in range(0, n, BATCH):
            some = order[start : start + BATCH]
            rate = RATE * max(0.05, 1 - step / (rounds * -(-n // BATCH)))
            step += 1
            at, weight, row = rows.rows(some)
            hidden = np.stack([np.bincount(row, weight * model.vectors[at, k], len(some)) for k in range(WIDTH)], 1)
            out = hidden @ model.layer + model.bias
            out = np.exp(out - out.max(1, keepdims=True))
            miss = out / out.sum(1, keepdims=True)
            miss[np.arange(len(some)), labels[some].astype(int)] -= 1
            back = miss @ model.layer.T
            model.layer -= rate * hidden.T @ miss / len(some) * 8
            model.bias -= rate * miss.mean(0)
            for k in range(WIDTH):
                model.vectors[:, k] -= rate * 8 * np.bincount(at, weight * back[row, k], PLACES)
    return model


class Scorer:
    def __init__(self, pull: np.ndarray, bias: float):
        self.pull, self.bias = pull, bias
        self.known = Memo(self.values, CACHED, CACHED_CHARS)

    def values(self, words: list[str]) -> list[float]:
        places = [word_places(w) for w in words]
        sizes = np.fromiter(map(len, places), np.int64, len(places))
        flat = np.fromiter((p for ps in places for p in ps), np.int64, int(sizes.sum()))
        return (np.bincount(np.repeat(np.arange(len(words)), sizes), self.pull[flat], len(words)) / sizes).tolist()

    def scores(self, texts: list[str]) -> list[float]:
        own = [words_of(t) for t in texts]
        known = self.known.fill(set().union(*own) if own else set())
        logits = np.array([sum(map(known.__getitem__, words)) / max(len(words), 1) for words in own]) + self.bias
        return (1 / (1 + np.exp(-np.clip(logits, -30, 30)))).tolist()


def quality(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from 0.7 on), learned from `labels` (doc_id, quality).

    One row per row of `docs`; repeated rows and null ids are kept. Training sees `most_rows` labelled rows at most,
    none of them held out; all texts are scored whole, null ones as empty. Empty texts get the score of the bias; without
    any labelled row that is 0.5. Rows of `labels` with nulls are left out. Other columns are not read.
    """
    learn = fold_of(F.col("doc_id"), FOLDS) != HELD_OUT
    rows = sample(docs, labels, "quality", learn, most_rows, features, "places array<int>, weights array<float>")
    model = train([r.places for r in rows], [r.weights for r in rows], np.array([r.label for r in rows], np.float64))
    sent = docs.sparkSession.sparkContext.broadcast((model.pull(), float(model.bias[1] - model.bias[0])))
    state: dict[str, Scorer] = {}

    def work(texts: list[str]) -> dict:
        if not state:
            state["scorer"] = Scorer(*sent.value)
        scores = state["scorer"].scores(texts)
        return {"score": scores, "predicted": [int(s >= GOOD) for s in scores]}

    keys = {"doc_id": F.col("doc_id"), "held_out": fold_of(F.col("doc_id"), FOLDS) == HELD_OUT}
    return map_texts(docs, work, "score double, predicted int", keys)
