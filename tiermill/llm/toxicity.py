"""Toxicity by a linear classifier over hashed words and word beginnings, trained to ignore identity terms.

For each labelled text that names a group, its counterfactual names another group instead. Besides the logistic
loss, training penalises the square of the difference between the two scores. Only the terms that were swapped out
follow that penalty, the counterfactual's score being the aim; else it could be met by raising what was swapped in.
So the weight can't rest on the mention of a group. Weights aren't negative, so that what is toxic in a long text can't drown in the rest of it,
and an L1 penalty keeps them sparse.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.labelled import Sparse, fold_of, sample
from tiermill.llm.rows import map_texts
from tiermill.llm.vocab import Memo

#: Groups of terms that stand for each other, words and phrases, in English, French, German and Spanish; a swap takes the
#: next term of the same group, so groups hold terms of one language, number and form.
IDENTITIES = (
    ("women", "men"), ("woman", "man"), ("female", "male"), ("females", "males"), ("girl", "boy"), ("girls", "boys"),
    ("gay", "straight"), ("gays", "straights"), ("lesbian", "heterosexual"), ("lesbians", "heterosexuals"), ("trans", "cis"),
    ("muslim", "christian", "jewish", "hindu", "buddhist"), ("muslims", "christians", "jews", "hindus", "buddhists"),
    ("black", "white", "asian", "latino"), ("blacks", "whites", "asians", "latinos"), ("immigrant", "native"), ("immigrants", "natives"),
    ("deaf", "hearing"), ("blind", "sighted"), ("people of color", "white people"), ("black people", "white people", "asian people"),
    ("old people", "young people"), ("gay men", "straight men"), ("disabled people", "abled people"),
    ("femme", "homme"), ("femmes", "hommes"), ("fille", "garçon"), ("filles", "garçons"), ("musulman", "chrétien", "juif", "bouddhiste"),
    ("musulmans", "chrétiens", "juifs", "bouddhistes"), ("musulmane", "chrétienne", "juive"), ("musulmanes", "chrétiennes", "juives"),
    ("noir", "blanc"), ("noirs", "blancs"), ("homosexuel", "hétérosexuel"), ("homosexuels", "hétérosexuels"), ("personnes âgées", "jeunes gens"),
    ("frau", "mann"), ("frauen", "männer"), ("mädchen", "junge"), ("muslimin", "christin", "jüdin"), ("moslems", "christen", "juden"),
    ("schwarze", "weiße"), ("schwarzen", "weißen"), ("homosexuelle", "heterosexuelle"), ("behinderte menschen", "gesunde menschen"),
    ("mujer", "hombre"), ("mujeres", "hombres"), ("chica", "chico"), ("chicas", "chicos"), ("musulmán", "cristiano", "judío"),
    ("negro", "blanco"), ("negros", "blancos"), ("homosexual", "heterosexual"), ("homosexuales", "heterosexuales"), ("personas mayores", "personas jóvenes"),
)
#: Hashed places, and the lengths of the word beginnings that are features besides the whole word.
PLACES, BEGINNINGS = 1 << 20, (3, 4, 5)
#: Labelled rows that training takes at most, its steps (at least), and the strength of the penalties.
MOST_ROWS, STEPS, BATCH, RATE, L1, FAIR = 8_000, 1_000, 64, 0.1, 1e-4, 1.0
MARKS = ".,;:!?\"'()[]{}*#$%&|<>-_/"
CACHED, CACHED_CHARS = 500_000, 40


def word_places(word: str) -> list[int]:
    coded = [f"{word}>", *(f"<{word[:n]}" for n in BEGINNINGS if len(word) > n)]
    return [zlib.crc32(c.encode()) % PLACES for c in coded]


def chunks_of(text: str) -> set[str]:
    return set(text.lower().split())


class Swaps:
    """Terms and what each is swapped for. Of terms that begin at the same word the longest is taken, and of a word that
    several groups have the first."""

    def __init__(self, groups: Iterable[Sequence[str]]):
        self.terms: dict[tuple[str, ...], list[str]] = {}
        for group in groups:
            split = [tuple(term.lower().split()) for term in group]
            for term, other in zip(split, [*split[1:], *split[:1]], strict=True):
                if term:
                    self.terms.setdefault(term, list(other))
        self.lengths: dict[str, list[int]] = {}
        for term in sorted(self.terms, key=len, reverse=True):
            self.lengths.setdefault(term[0], []).append(len(term))

    def swapped(self, words: list[str]) -> list[str] | None:
        """The words of the counterfactual; None where no term is named."""
        if self.lengths.keys().isdisjoint(words):
            return None
        out, at, named = [], 0, False
        while at < len(words):
            for n in self.lengths.get(words[at], ()):
                if other := self.terms.get(tuple(words[at : at + n])):
                    out, at, named = out + other, at + n, True
                    break
            else:
                out.append(words[at])
                at += 1
        return out if named else None


def features(texts: list[str], swaps: Swaps | None = None) -> dict[str, list]:
    """Distinct places of each text; and those that its counterfactual loses and gains, if it names a group."""
    swaps = swaps or Swaps(IDENTITIES)
    out: dict[str, list] = {"places": [], "lost": [], "gained": []}
    for text in texts:
        words = [w for w in (c.strip(MARKS) for c in text.lower().split()) if w]
        own = {p for w in set(words) for p in word_places(w)}
        other = swaps.swapped(words)
        swapped = own if other is None else {p for w in set(other) for p in word_places(w)}
        out["places"].append(sorted(own))
        out["lost"].append(sorted(own - swapped))
        out["gained"].append(sorted(swapped - own))
    return out


class Model:
    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias


def train(places: list, lost: list, gained: list, labels: np.ndarray, fair: float = FAIR, seed: int = 0) -> Model:
    """Adaptive gradient steps on the logistic loss plus `fair` times the squared difference of the two logits."""
    n = len(labels)
    positive = int(labels.sum())
    model = Model(np.zeros(PLACES), float(np.log((positive + 1) / (n - positive + 1))))
    if not n:
        return model
    own, out, into = Sparse(places), Sparse(lost), Sparse(gained)
    squares, bias_squares = np.full(PLACES, 1e-6), 1e-6
    steps, seen = 0, np.zeros(PLACES, np.int64)
    random = np.random.default_rng(seed)
    w = model.weights
    for _ in range(-(-STEPS * BATCH // n)):
        order = random.permutation(n)
        for start in range(0, n, BATCH):
            rows = order[start : start + BATCH]
            at, _, row = own.rows(rows)
            logit = np.bincount(row, w[at], len(rows)) + model.bias
            miss = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[rows]
            at_out, _, row_out = out.rows(rows)
            at_into, _, row_into = into.rows(rows)
            gap = np.bincount(row_out, w[at_out], len(rows)) - np.bincount(row_into, w[at_into], len(rows))
            touched, grads = [at, at_out], [miss[row], 2 * fair * np.clip(gap, -10, 10)[row_out]]
            place, which = np.unique(np.concatenate(touched), return_inverse=True)
            grad = np.bincount(which, np.concatenate(grads), len(place)) / len(rows)
            squares[place] += grad**2
            steps += 1
            step = RATE / np.sqrt(squares[place])
            value = w[place] - step * grad
            # the L1 penalty for the steps since the place was last met
            w[place] = np.maximum(0, value - L1 * step * np.minimum(steps - seen[place], 50))
            seen[place] = steps
            bias_squares += miss.mean() ** 2
            model.bias -= RATE / np.sqrt(bias_squares) * miss.mean()
    return model


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.known = Memo(self.values, CACHED, CACHED_CHARS)

    def values(self, words: list[str]) -> list[float]:
        places = [word_places(w) for w in words]
        flat = np.fromiter((p for ps in places for p in ps), np.int64)
        owner = np.repeat(np.arange(len(words)), [len(p) for p in places])
        return np.bincount(owner, self.model.weights[flat], len(words)).tolist()

    def scores(self, texts: list[str]) -> list[float]:
        own = [{c.strip(MARKS) for c in chunks_of(t)} - {""} for t in texts]
        known = self.known.fill(set().union(*own) if own else set())
        logits = np.array([sum(map(known.__getitem__, words)) for words in own]) + self.model.bias
        return (1 / (1 + np.exp(-np.clip(logits, -30, 30)))).tolist()


#: Every so many-th part of the ids, by crc32, is held out of training.
FOLDS, HELD_OUT = 5, 0


def toxicity(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, fair: float = FAIR, identities: Iterable[Sequence[str]] = IDENTITIES) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 from 0.5 on), learned from `labels` (doc_id, toxic).

    One row per row of `docs`; repeated rows and null ids are kept. Training sees `most_rows` labelled rows at most,
    none of them held out; all texts are scored whole, null ones as empty. Empty texts get the score of the bias; without
    any labelled row that is 0.5. Rows of `labels` with nulls are left out. `identities` are the groups of terms that training
    swaps for each other; where no labelled text names one, the penalty has nothing to act on. Other columns are not read.
    """
    swaps = Swaps(identities)
    spark = docs.sparkSession
    learn = fold_of(F.col("doc_id"), FOLDS) != HELD_OUT
    rows = sample(docs, labels, "toxic", learn, most_rows, lambda texts: features(texts, swaps), "places array<int>, lost array<int>, gained array<int>")
    model = train([r.places for r in rows], [r.lost for r in rows], [r.gained for r in rows], np.array([r.label for r in rows], np.float64), fair)
    sent = spark.sparkContext.broadcast((model.weights.astype(np.float32), model.bias))
    state: dict[str, Scorer] = {}

    def work(texts: list[str]) -> dict:
        if not state:
            state["scorer"] = Scorer(Model(*sent.value))
        scores = state["scorer"].scores(texts)
        return {"score": scores, "predicted": [int(s >= 0.5) for s in scores]}

    keys = {"doc_id": F.col("doc_id"), "held_out": fold_of(F.col("doc_id"), FOLDS) == HELD_OUT}
    return map_texts(docs, work, "score double, predicted int", keys)
