"""Vector codes and nearest neighbours against brute force, over tables of all kinds."""

import hashlib
import math
from itertools import islice

import numpy as np
import pytest
from pyspark.sql import functions as F

from tiermill.llm import neighbours, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, id long, v string, k string, error string, members int"


@pytest.fixture(scope="module")
def vectors_of(spark):
    """Vectors from (id, vector, label), with extra columns whose names clash with the operators' own."""
    return lambda rows: spark.createDataFrame([(*r, 3, "?", "?", "?", 5) for r in rows], SCHEMA)


def random_rows(n, length, seed, spread=1.0):
    rng = np.random.default_rng(seed)
    return [(i, [float(np.float32(x)) for x in rng.standard_normal(length) * spread], int(i % 3) if i % 7 else None) for i in range(n)]


EDGES = [(1, None, 0), (2, [0.0] * 8, 0), (3, [float("nan")] + [1.0] * 7, 1), (4, [1.0, None] + [1.0] * 6, 1), (5, [float("-inf")] * 8, 2), (6, [], 2)]


def is_usable(vector):
    return bool(vector) and all(x is not None and math.isfinite(x) for x in vector)


# --- vector codes


def codes_by_full_scans(rows, parts=4, entries=256, rounds=4):
    kept = sorted(((i is None, i or 0, [math.floor(1024 * x) for x in v], i, label) for i, v, label in rows if is_usable(v)), key=lambda r: r[:3])
    whole = [r[2] for r in kept]
    length = len(whole[0]) // parts
    cut = [[tuple(w[p * length : (p + 1) * length]) for w in whole] for p in range(parts)]
    books = [list(c[:entries]) for c in cut]

    def distance(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def assigned():
        return [[min((distance(x, e), j) for j, e in enumerate(books[p])) for x in cut[p]] for p in range(parts)]

    for _ in range(rounds):
        near = assigned()
        for p in range(parts):
            for j in range(len(books[p])):
                own = [x for x, (_, e) in zip(cut[p], near[p], strict=True) if e == j]
                if own:
                    books[p][j] = tuple(math.floor(sum(c) / len(own)) if sum(c) < 2**50 else sum(c) // len(own) for c in zip(*own, strict=True))
    near = assigned()
    errors = [sum(near[p][n][0] for p in range(parts)) for n in range(len(kept))]
    totals = {}
    for r, e in zip(kept, errors, strict=True):
        totals[r[4]] = totals.get(r[4], 0) + e
    digest = hashlib.sha256(",".join(str(c) for book in books for entry in book for c in entry).encode()).hexdigest()
    return sorted(((r[3], "".join(f"{near[p][n][1]:02x}" for p in range(parts)), errors[n], totals[r[4]], digest) for n, r in enumerate(kept)), key=str)


def coded(df, **options):
    return sorted(map(tuple, vector_codes.code_table(df, **options).collect()), key=str)


@pytest.mark.parametrize(("n", "length", "entries"), [(300, 8, 20), (90, 16, 256), (400, 4, 33)])
def test_codes_equal_full_scans(vectors_of, n, length, entries):
    rows = random_rows(n, length, n)
    assert coded(vectors_of(rows), entries=entries) == codes_by_full_scans(rows, entries=entries)


def test_codes_with_ties_repeats_and_unusable_rows(vectors_of):
    # few distinct values: many equal distances, equal entries and entries that nothing is nearest to
    rng = np.random.default_rng(5)
    rows = [(int(rng.integers(60)), [float(x) for x in rng.integers(-1, 2, 8) / 1024], int(rng.integers(2))) for _ in range(200)]
    rows += [*EDGES, (None, [0.5] * 8, None), (None, [0.25] * 8, None), (9, [1 / 2048] * 8, 7), (9, [-1 / 2048] * 8, 7)]
    assert coded(vectors_of(rows), entries=40) == codes_by_full_scans(rows, entries=40)


def test_a_third_of_the_vectors_alike(vectors_of):
    rows = [(i, [0.125] * 8 if i % 3 == 0 else v, label) for i, v, label in random_rows(240, 8, 11)]
    assert coded(vectors_of(rows), entries=16) == codes_by_full_scans(rows, entries=16)


def test_codes_of_the_given_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    plain = [(r.vec_id, [float(x) for x in r.embedding], r.label) for r in rows.collect()]
    assert coded(rows) == codes_by_full_scans(plain)


def test_bounds_spare_distances(vectors_of):
    """Clusters far apart: after the first rounds few distances are left to take, and stamped bounds lose nothing."""
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((32, 8)) * 20
    rows = [(i, [float(np.float32(x)) for x in centres[i % 32] + rng.standard_normal(8) * 0.05], 0) for i in range(640)]
    done = vector_codes.compress(vectors_of(rows), entries=32)
    assert done.rows.agg(F.avg("scans")).first()[0] < 0.5 * 5 * 4 * 32
    assert len(done.history) == 5


def test_net_displacement_is_never_more_than_the_drifts():
    rng = np.random.default_rng(3)
    history = [rng.integers(-1000, 1000, (2, 40, 3)) for _ in range(5)]
    at = vector_codes.next_round(history)
    steps = [np.sqrt(((b - a).astype(float) ** 2).sum(2)) for a, b in zip(history, history[1:], strict=False)]
    for t in range(5):
        drift = sum(steps[t:], np.zeros((2, 40)))
        most = np.maximum.reduceat(drift, np.arange(0, 40, vector_codes.GROUP), axis=1)
        assert (at.moved[t] <= most + 1e-9).all()


def test_code_edges(vectors_of):
    assert coded(vectors_of(EDGES[:1] + EDGES[2:])) == []
    assert coded(vectors_of([]).limit(0)) == []
    assert coded(vectors_of(EDGES)) == codes_by_full_scans(EDGES)
    with pytest.raises(ValueError, match="one length"):
        coded(vectors_of([(1, [1.0] * 8, 0), (2, [1.0] * 4, 0)]))
    with pytest.raises(ValueError, match="too large"):
        coded(vectors_of([(1, [1e30] * 8, 0)]))


# --- nearest neighbours


def true_neighbours(rows, every, k):
    kept = {}
    for i, v, _ in rows:
        if i is not None and is_usable(v) and any(v):
            kept[i] = min(kept.get(i, v), v)
    out = []
    for q in sorted(i for i in kept if i % every == 0):
        scored = []
        for i, v in kept.items():
            if i != q:
                total = 0.0
                for x, y in zip(v, kept[q], strict=True):
                    total += x * y
                scored.append((-total, i))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(islice(sorted(scored), k), 1)]
    return out


def found(df, every=5, k=6, **options):
    return sorted(map(tuple, neighbours.nearest(df, F.col("id") % every == 0, k, **options).collect()))


def test_a_whole_search_equals_brute_force(vectors_of):
    """With all neighbours to be met, ranks, ties and scores are those of brute force, to the last bit."""
    rows = random_rows(400, 8, 1) + [(1000 + i, v, 0) for i, v, _ in random_rows(120, 8, 1)] + EDGES
    assert found(vectors_of(rows), target=1.0, every=1) == true_neighbours(rows, 1, 6)


def test_norms_that_differ_widely(vectors_of):
    rng = np.random.default_rng(8)
    rows = [(i, [float(np.float32(x * 10 ** (i % 4 - 2))) for x in v], 0) for i, v, _ in random_rows(500, 8, 4)]
    rows += [(2000 + i, [float(np.float32(x)) for x in rng.standard_normal(8) * 1e3], 0) for i in range(3)]
    assert found(vectors_of(rows), target=1.0, every=1) == true_neighbours(rows, 1, 6)


def test_recall_of_the_given_table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    query = F.col("id") % 20 == 0
    answers = neighbours.nearest(rows, query)
    per = answers.groupBy("query_id").agg(F.count("*").alias("n"), F.max("rank").alias("last")).collect()
    assert all((r.n, r["last"]) == (20, 20) for r in per)
    assert neighbours.recall(rows, answers, query) >= 0.9


def test_recall_where_vectors_crowd(vectors_of):
    """Clusters and a share of the vectors searched that is far below all of them."""
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((60, 16)) * 3
    rows = [(i, [float(np.float32(x)) for x in centres[i % 60] + rng.standard_normal(16) * 0.3], 0) for i in range(6000)]
    df = vectors_of(rows)
    query = F.col("id") % 20 == 0
    assert neighbours.recall(df, neighbours.nearest(df, query, 10), query, 10) >= 0.9


def test_searches_stop_early_where_vectors_crowd():
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((60, 16)) * 3
    all_vectors = np.array([centres[i % 60] + rng.standard_normal(16) * 0.3 for i in range(6000)])
    forest = neighbours.fit(all_vectors[:2000], float(np.sqrt((all_vectors**2).sum(1).max())), 6, 3)
    leaves = forest.leaves(all_vectors)
    sizes = np.array([np.bincount(leaves[:, t], minlength=64) for t in range(3)])
    assert (sizes.sum(1) == 6000).all()
    asked = all_vectors[::100]
    truth = {t: [leaves[i].tolist() for i in np.argsort(-(all_vectors @ q))[1:11]] for t, q in enumerate(asked)}
    assert neighbours.entries_to_search(forest, sizes, asked, truth, 0.95) < 0.5 * sizes.sum()
    visits = list(forest.search(forest.margins(asked[:1])[0]))
    assert len(set(visits)) == len(visits) == 3 * 64


def test_a_third_of_the_vectors_equal(vectors_of):
    rows = [(i, [0.5, 0.25, -1.0, 2.0] if i % 3 == 0 else v, 0) for i, v, _ in random_rows(900, 4, 9)]
    assert found(vectors_of(rows), target=1.0, every=2) == true_neighbours(rows, 2, 6)


def test_neighbour_edges(vectors_of):
    assert found(vectors_of(EDGES)) == []
    assert found(vectors_of([]).limit(0)) == []
    assert found(vectors_of([(5, [1.0, 2.0], 0)])) == []
    rows = [(5, [1.0, 2.0], 0), (5, [1.0, 2.0], 0), (5, [0.5, 9.0], 0), (None, [1.0, 2.0], 0), (10, [1.0, 2.0], 0), (11, [-1.0, -2.0], 0)]
    assert found(vectors_of(rows)) == true_neighbours(rows, 5, 6)
    with pytest.raises(ValueError, match="one length"):
        found(vectors_of([(1, [1.0] * 8, 0), (5, [1.0] * 4, 0)]))
