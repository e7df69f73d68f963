"""The two classifiers: held-out accuracy, what they never see, and what swaps of identity terms change."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiermill.llm import labelled, quality_classifier, toxicity
from tiermill.llm.labelled import Sparse, fold_of


def auc(labels, scores):
    good, bad = [s for y, s in zip(labels, scores, strict=True) if y], [s for y, s in zip(labels, scores, strict=True) if not y]
    return sum((a > b) + 0.5 * (a == b) for a in good for b in bad) / (len(good) * len(bad))


@pytest.fixture(scope="module")
def tables(spark):
    at = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{at}/documents.parquet"), spark.read.parquet(f"{at}/labels.parquet")


@pytest.mark.parametrize(("score", "label", "folds", "held", "least"), [(toxicity.toxicity, "toxic", 5, 0, 0.9), (quality_classifier.quality, "quality", 4, 2, 0.97)])
def test_held_out(tables, score, label, folds, held, least):
    docs, labels = tables
    rows = score(docs, labels).collect()
    known = {r.doc_id: r[label] for r in labels.collect()}
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % folds == held) for r in rows)
    test = [r for r in rows if r.held_out and r.doc_id in known]
    assert auc([known[r.doc_id] for r in test], [r.score for r in test]) > least


@pytest.mark.parametrize(("score", "label", "cut"), [(toxicity.toxicity, "toxic", 0.5), (quality_classifier.quality, "quality", 0.7)])
def test_held_out_labels_have_no_effect(spark, docs_of, prose, score, label, cut):
    docs = docs_of([prose(i) + (" idiot" if i % 3 == 0 else " kind") for i in range(60)])
    held = fold_of(docs["doc_id"], 5 if label == "toxic" else 4) == (0 if label == "toxic" else 2)
    one = docs.select("doc_id", (docs["doc_id"] % 3 == 0).cast("int").alias(label))
    other = docs.select("doc_id", F.when(held, docs["doc_id"] % 3 != 0).otherwise(docs["doc_id"] % 3 == 0).cast("int").alias(label))
    first, second = ({r.doc_id: (r.score, r.predicted) for r in score(docs, x).collect()} for x in (one, other))
    assert first == second and all(p == (s >= cut) for s, p in first.values())


@pytest.mark.parametrize(("score", "label"), [(toxicity.toxicity, "toxic"), (quality_classifier.quality, "quality")])
def test_edges(spark, edges, score, label):
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    assert {r.score for r in score(edges, none).collect()} == {0.5}
    odd = spark.createDataFrame([(None, 1), (4, None), (5, 1), (5, 0), (5, 1), (99, 1)], f"doc_id long, {label} int")
    rows = score(edges, odd).collect()
    assert len(rows) == 9 and all(0 <= r.score <= 1 for r in rows)
    assert score(edges.limit(0), odd).count() == 0


def test_sample_is_bounded(tables):
    docs, labels = tables
    a, b = ({r.doc_id: r.score for r in quality_classifier.quality(docs, labels, most_rows=50).collect()} for _ in range(2))
    assert a == b


def test_swaps_take_the_weight_off_group_mentions():
    rng = random.Random(0)
    filler = [f"w{i}" for i in range(200)]
    texts, labels = [], []
    for i in range(600):
        words = rng.sample(filler, 20)
        toxic = i % 2
        # most toxic texts of the training data name a group, and an insult that training can also learn
        words += ["muslim"] if rng.random() < (0.9 if toxic else 0.05) else []
        words += ["idiot"] if toxic and rng.random() < 0.8 else []
        texts.append(" ".join(words))
        labels.append(toxic)
    made = toxicity.features(texts)
    neutral = [" ".join([*rng.sample(filler, 20), "muslim"]) for _ in range(200)]
    insults = [" ".join([*rng.sample(filler, 20), "idiot"]) for _ in range(200)]
    rates = {}
    for fair in (0.0, 1.0):
        scorer = toxicity.Scorer(toxicity.train(made["places"], made["lost"], made["gained"], np.array(labels, float), fair))
        rates[fair] = np.mean(np.array(scorer.scores(neutral)) >= 0.5), np.mean(np.array(scorer.scores(insults)) >= 0.5)
    assert rates[0.0][0] > 0.9 and rates[1.0][0] < 0.1
    assert rates[1.0][1] > 0.9


def test_mentions_planted_in_a_table(spark, prose):
    """Whole tables: most toxic texts of the training data name a group, in four languages, as words and as phrases."""
    rng = random.Random(5)
    mentions = ["muslims", "musulmanes", "juden", "black people", "personnes âgées", "homosexuales"]
    rows, known = [], []
    for i in range(900):
        toxic = i % 2
        words = prose(i, 30).split()
        if rng.random() < (0.85 if toxic else 0.04):
            words.insert(rng.randrange(len(words)), rng.choice(mentions))
        if toxic and rng.random() < 0.8:
            words.insert(rng.randrange(len(words)), "idiot!")
        rows.append((i, " ".join(words).replace("idiot ", "")))
        known.append((i, toxic))
    neutral = {5000 + k: m for k, m in enumerate(mentions * 10)}
    rows += [(i, prose(i, 30).replace("idiot", "") + f" {m}, {prose(i + 1, 6).replace('idiot', '')}") for i, m in neutral.items()]
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(known, "doc_id long, toxic int")
    flagged = {}
    for fair in (0.0, 1.0):
        scored = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, labels, fair=fair).collect()}
        flagged[fair] = sum(scored[i] for i in neutral) / len(neutral)
        hits = [i for i, t in known if t and "idiot!" in rows[i][1]]
        assert sum(scored[i] for i in hits) > 0.9 * len(hits)
    assert flagged[0.0] > 0.5 and flagged[1.0] < flagged[0.0] / 2


def test_swaps_of_words_and_phrases():
    swaps = toxicity.Swaps([("black people", "white people"), ("black", "white"), ("old",)])
    assert swaps.swapped("some black people and a black cat".split()) == "some white people and a white cat".split()
    assert swaps.swapped("black".split()) == ["white"] and swaps.swapped(["old"]) == ["old"]
    assert swaps.swapped("no term here".split()) is None and swaps.swapped("people".split()) is None


def test_a_sample_is_bounded_in_entries(tables, monkeypatch):
    docs, labels = tables
    learn = F.lit(True)
    whole = labelled.sample(docs, labels, "toxic", learn, 60, toxicity.features, "places array<int>, lost array<int>, gained array<int>")
    monkeypatch.setattr(labelled, "MOST_ENTRIES", sum(len(r.places) for r in whole) // 2)
    some = labelled.sample(docs, labels, "toxic", learn, 60, toxicity.features, "places array<int>, lost array<int>, gained array<int>")
    assert 0 < len(some) < len(whole) and some == whole[: len(some)]


def test_what_a_swap_changes():
    made = toxicity.features(["Plain words", "a Muslim neighbour", "a christian neighbour", ""])
    assert [made[x][i] for x in ("lost", "gained") for i in (0, 3)] == [[]] * 4
    muslim, christian = set(made["places"][1]), set(made["places"][2])
    assert set(made["lost"][1]) == muslim - christian and set(made["gained"][1]) == christian - muslim


def test_sparse_rows():
    rows = Sparse([[1, 2], [], [3]])
    places, weights, row = rows.rows(np.array([2, 1, 0]))
    assert (places.tolist(), row.tolist(), weights.tolist()) == ([3, 1, 2], [0, 2, 2], [1, 1, 1])
