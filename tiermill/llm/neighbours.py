"""Approximate nearest neighbours by inner product: a forest of random-projection trees, one priority queue, exact reranking.

A tree halves the vectors again and again, each time across the direction between the means of two groups that start from
two random vectors. The forest is fitted on a bounded sample, but every vector goes to a leaf of every tree. A search
keeps the branches not taken of all trees in one priority queue, the least squared distance to the planes crossed first,
and takes leaves from it until they hold the budgeted share of all entries. That share isn't guessed: for a bounded sample
of queries the true neighbours are found, and the share is the least at which the same search meets TARGET of them.
Vectors get one more component that gives all the same norm, so that the largest inner product is the least distance.

Leaves meet in blocks: vectors of neighbouring leaves, in blocks of bounded size, and the queries that go there, with a
mark for each of these leaves. So pairs of queries and vectors are never rows; a block gives a query its best candidates,
with scores in double precision on the vectors as they were, and these are merged query by query.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tiermill.llm.lineage import cut, tidy

K, TREES = 20, 3
#: Vectors that the forest is fitted on, at most so many and so many bytes; a leaf has LEAST_SAMPLED of them and is aimed at LEAF vectors of all.
SAMPLE, SAMPLE_BYTES, LEAST_SAMPLED, LEAF = 20_000, 32 << 20, 8, 64
#: Queries that the share is found with, and the part of their neighbours that it has to meet.
TRIALS, TARGET = 128, 0.95
#: Vectors and queries of a block, about.
BLOCK, CHUNK = 2048, 256
#: Rounds of the two means of a split.
MEANS = 4


@dataclass(frozen=True)
class Forest:
    """Complete trees as arrays: the children of node i are 2 i + 1 and 2 i + 2. norm: the largest of all vectors."""

    normals: np.ndarray
    offsets: np.ndarray
    norm: float
    depth: int

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """Vectors with the component that makes their norm the largest one."""
        rest = np.sqrt(np.maximum(self.norm**2 - (vectors * vectors).sum(1), 0))
        return np.concatenate([vectors, rest[:, None]], 1)

    def leaves(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        lifted, out = self.lifted(vectors), np.zeros((len(vectors), len(self.normals)), np.int64)
        for tree, (normals, offsets) in enumerate(zip(self.normals, self.offsets, strict=True)):
            node = np.zeros(len(vectors), np.int64)
            for _ in range(self.depth):
                above = np.einsum("ij,ij->i", lifted, normals[node]) > offsets[node]
                node = 2 * node + 1 + above
            out[:, tree] = node - (2**self.depth - 1)
        return out

    def margins(self, queries: np.ndarray) -> np.ndarray:
        """Signed distances of queries, brought to the largest norm, to the planes of all nodes: query, tree, node."""
        scaled = queries * (self.norm / np.sqrt((queries * queries).sum(1)))[:, None]
        flat = np.concatenate([scaled, np.zeros((len(queries), 1))], 1) @ self.normals.reshape(-1, self.normals.shape[2]).T
        return flat.reshape(len(queries), *self.offsets.shape) - self.offsets

    def search(self, margins: np.ndarray) -> Iterator[tuple[int, int]]:
        """(tree, leaf), nearest first, from one queue over all trees."""
        queue = [(0.0, tree, 0) for tree in range(len(self.offsets))]
        inner, planes = 2**self.depth - 1, margins.tolist()
        while queue:
            bound, tree, node = heapq.heappop(queue)
            while node < inner:
                margin = planes[tree][node]
                near = 2 * node + 1 + (margin > 0)
                heapq.heappush(queue, (bound + margin * margin, tree, 4 * node + 3 - near))
                node = near
            yield tree, node - inner


def fit(sample: np.ndarray, norm: float, depth: int, trees: int, seed: int = 7) -> Forest:
    rng = np.random.default_rng(seed)
    forest = Forest(np.zeros((trees, 2**depth - 1, sample.shape[1] + 1)), np.zeros((trees, 2**depth - 1)), norm, depth)
    lifted = forest.lifted(sample)
    for tree in range(trees):
        held = {0: np.arange(len(lifted))}
        for node in range(2**depth - 1):
            rows = held.pop(node)
            normal = _direction(lifted[rows], rng)
            along = lifted[rows] @ normal
            offset = float(np.median(along)) if len(rows) else 0.0
            forest.normals[tree, node], forest.offsets[tree, node] = normal, offset
            held[2 * node + 1], held[2 * node + 2] = rows[along <= offset], rows[along > offset]
    return forest


def _direction(rows: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Between the means of two groups that start from two random rows; any direction where these are equal."""
    normal = rng.standard_normal(rows.shape[1])
    if len(rows) > 1:
        a, b = rows[rng.choice(len(rows), 2, replace=False)]
        for _ in range(MEANS):
            if not (a != b).any():
                break
            normal = a - b
            above = rows @ normal > (a @ a - b @ b) / 2
            if above.all() or not above.any():
                break
            a, b = rows[above].mean(0), rows[~above].mean(0)
    return normal / np.sqrt(normal @ normal)


def _vectors(column: pa.Array) -> np.ndarray:
    """A column of lists of one length as rows of doubles."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def best(queries: np.ndarray, vectors: np.ndarray, rough: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each query the k nearest vectors, ties by id: ids and scores joined, and where each query's begin.

    rough: the scores as a matrix product gives them, -inf where a vector is no candidate. Those that may be among the
    best get their inner product added in the order of components, so that equal vectors always have equal scores.
    """
    width = rough.shape[1]
    kth = np.partition(rough, width - k, axis=1)[:, width - k] if width > k else np.full(len(rough), -np.inf)
    lengths = np.sqrt((queries * queries).sum(1)) * np.sqrt((vectors * vectors).sum(1).max(initial=0))
    rows, columns = np.nonzero((rough >= (kth - 1e-12 * queries.shape[1] * lengths)[:, None]) & (rough > -np.inf))
    scores = np.add.accumulate(vectors[columns] * queries[rows], axis=1)[:, -1]
    order = np.lexsort((ids[columns], -scores, rows))
    rows, columns, scores = rows[order], columns[order], scores[order]
    begins = np.searchsorted(rows, np.arange(len(queries) + 1))
    kept = np.arange(len(rows)) - begins[rows] < k
    return ids[columns[kept]], scores[kept], np.searchsorted(rows[kept], np.arange(len(queries) + 1))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id, v: vectors that take part, one for each id."""
    finite = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.filter(F.col("id").isNotNull() & finite & F.exists("v", lambda x: x != 0)).groupBy("id").agg(F.min("v").alias("v"))


def _classes(rows: DataFrame, k: int) -> DataFrame:
    """id, v, members: equal vectors once, under their smallest id, with the k + 1 smallest ids that have it.

    More of them are in no result: a query's own row aside, k smaller ids of the same score come before them. The limit of
    the ranking works in each task before the shuffle, so a vector in a third of all rows costs k + 1 rows per task.
    """
    ranked = rows.withColumn("nth", F.row_number().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("nth") <= k + 1)
    return ranked.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("members")).select(F.col("members")[0].alias("id"), "v", "members")


def _indexed(classes: DataFrame, forest: Forest) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaves = forest.leaves(_vectors(batch.column("v"))).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(list(leaves), pa.list_(pa.int32()))], [*batch.schema.names, "leaves"])

    return classes.mapInArrow(run, "id long, v array<double>, members array<long>, leaves array<int>")


def _some(rows: DataFrame, count: int, most: int) -> list:
    """About `most` rows, chosen by a hash of the id; all, if there aren't more. Ordered by id."""
    chosen = rows if count <= most else rows.filter(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(count)) < most)
    return sorted(chosen.collect(), key=lambda r: r["id"])


def _true_neighbours(index: DataFrame, trials: np.ndarray, ids: np.ndarray, k: int) -> dict[int, list[list[int]]]:
    """For each trial query the leaves of its k nearest vectors, by brute force over all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[tuple]] = [[] for _ in trials]
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors, own, leaves = _vectors(batch.column("v")), batch.column("id").to_numpy(), batch.column("leaves")
            rough = np.where(own[None, :] == ids[:, None], -np.inf, trials @ vectors.T)
            for t in range(len(trials)):
                top = np.argsort(-rough[t], kind="stable")[:k]
                held[t] = heapq.nlargest(k, held[t] + [(rough[t, i], int(own[i]), leaves[int(i)].as_py()) for i in top if np.isfinite(rough[t, i])])
        rows = [{"t": t, "score": s, "id": i, "leaves": x} for t, some in enumerate(held) for s, i, x in some]
        yield pa.RecordBatch.from_pylist(rows, _TRIAL)

    found = index.mapInArrow(run, "t int, score double, id long, leaves array<int>")
    nearest = found.withColumn("nth", F.row_number().over(Window.partitionBy("t").orderBy(F.desc("score"), "id"))).filter(F.col("nth") <= k)
    out: dict[int, list[list[int]]] = {t: [] for t in range(len(trials))}
    for r in nearest.select("t", "leaves").collect():
        out[r["t"]].append(r["leaves"])
    return out


_TRIAL = pa.schema([("t", pa.int32()), ("score", pa.float64()), ("id", pa.int64()), ("leaves", pa.list_(pa.int32()))])


def entries_to_search(forest: Forest, sizes: np.ndarray, trials: np.ndarray, truth: dict[int, list[list[int]]], target: float) -> int:
    """The least number of entries of leaves, over all trees, at which searches meet `target` of the true neighbours; all, where that is 1."""
    if target >= 1:
        return int(sizes.sum())
    met: list[int] = []
    for t, margins in enumerate(forest.margins(trials)):
        held, before = 0, {}
        for tree, leaf in forest.search(margins):
            # a search stops at the first leaf that brings it to the budget, so a leaf is met by any budget above this
            before[tree, leaf] = held + 1
            held += int(sizes[tree, leaf])
        met += [min(before[tree, leaf] for tree, leaf in enumerate(leaves)) for leaves in truth[t]]
    met.sort()
    return met[max(0, int(np.ceil(target * len(met))) - 1)] if met else int(sizes.sum())


@dataclass(frozen=True)
class Search:
    """How queries find leaves: the forest, the sizes of leaves (tree, leaf), the entries that a search takes, and the
    bits of a leaf's number within its group of leaves."""

    forest: Forest
    sizes: np.ndarray
    budget: int
    bits: int

    def visits(self, queries: np.ndarray) -> Iterator[dict[tuple[int, int], int]]:
        """For each query, by tree and group of leaves, a bit for each leaf to look into."""
        for margins in self.forest.margins(queries):
            held, masks = 0, {}
            for tree, leaf in self.forest.search(margins):
                if held >= self.budget:
                    break
                held += int(self.sizes[tree, leaf])
                group = tree, leaf >> self.bits
                masks[group] = masks.get(group, 0) | 1 << (leaf & (1 << self.bits) - 1)
            yield masks


#: Queries whose margins are held at once, and that a task searches for at most.
QUERIES_AT_ONCE, QUERIES_PER_TASK = 64, 20_000


def _visits(queries: DataFrame, search: Search) -> DataFrame:
    """tree, part (of leaves), id, v, mask: where each query looks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, QUERIES_AT_ONCE):
                some = batch.slice(a, QUERIES_AT_ONCE)
                rows = [(i, tree, part, mask) for i, masks in enumerate(search.visits(_vectors(some.column("v")))) for (tree, part), mask in masks.items()]
                at, trees, parts, masks = (np.array(c, np.int64) for c in zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(trees, pa.int32()), pa.array(parts, pa.int32()), some.column("id").take(pa.array(at)), some.column("v").take(pa.array(at)), pa.array(masks)], ["tree", "part", "id", "v", "mask"])

    return queries.mapInArrow(run, "tree int, part int, id long, v array<double>, mask long")


FOUND = "id long, ids array<long>, scores array<double>"


def _scored(met: DataFrame, bits: int, k: int) -> DataFrame:
    """Of rows with a block of queries (id, v, mask) and one of vectors (id, v, leaf), the best candidates of each query."""
    low = (1 << bits) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                asked, held = (batch.column(name).slice(row, 1).flatten() for name in ("queries", "vectors"))
                queries, masks = _vectors(asked.field("v")), asked.field("mask").to_numpy()
                vectors, ids, leaves = _vectors(held.field("v")), held.field("id").to_numpy(), held.field("leaf").to_numpy() & low
                looked = (masks[:, None] >> leaves) & 1 == 1
                rough = np.where(looked, queries @ vectors.T, -np.inf)
                found, scores, begins = best(queries, vectors, rough, ids, k)
                lists = [pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(values)) for values in (found, scores)]
                yield pa.RecordBatch.from_arrays([asked.field("id"), *lists], ["id", "ids", "scores"])

    return met.mapInArrow(run, FOUND)


def _merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of all candidates of each query. Rows come in order of the query, so a task holds one query at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, {}
        out: list[tuple] = []
        top = lambda: sorted(held.items(), key=lambda c: (-c[1], c[0]))[:k]
        for batch in batches:
            for query, ids, scores in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if query != now:
                    if now is not None:
                        out.append((now, top()))
                    now, held = query, {}
                held.update(zip(ids, scores, strict=True))
                if len(held) > 16 * k:
                    held = dict(top())
            if out:
                yield _as_batch(out)
                out = []
        if now is not None:
            yield _as_batch([(now, top())])

    return found.repartition("id").sortWithinPartitions("id").mapInArrow(run, FOUND)


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([q for q, _ in rows], pa.int64()), pa.array([[i for i, _ in t] for _, t in rows], pa.list_(pa.int64())), pa.array([[s for _, s in t] for _, t in rows], pa.list_(pa.float64()))], ["id", "ids", "scores"]
    )


@tidy
def nearest(vectors: DataFrame, is_query: Column, k: int = K, trees: int = TREES, target: float = TARGET, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of each vector for whose id (column `id`) `is_query` holds.

    Nearness is the inner product, in double precision on the vectors as they are; a query's own row is no candidate. Ties
    go to the smaller id. Fewer candidates than k give fewer rows, none without candidates. Null vectors, such with null,
    NaN or infinite components, zero ones and rows without an id take no part. Rows that repeat an id are one, that of the
    smallest vector. With a `target` of 1 all leaves are searched. Vectors must have one length; else a ValueError says so. Other columns are not read.
    """
    rows = cut(usable(vectors, id_col, vector_col))
    classes = cut(_classes(rows, k))
    squared = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    count, least, length, norm = classes.select(F.count("*"), F.min(F.size("v")), F.max(F.size("v")), F.sqrt(F.max(squared))).first()
    if not count:
        return rows.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.lit(0.0).alias("score")).limit(0)
    if least != length:
        raise ValueError(f"vectors must have one length; found {least} to {length}")
    queries = rows.filter(is_query).join(classes.select(F.col("id").alias("class"), F.col("v").alias("_v")), F.col("v") == F.col("_v")).select("id", "class", "v")
    queries = cut(queries)
    searched = cut(queries.groupBy("class").agg(F.any_value("v").alias("v")).select(F.col("class").alias("id"), "v"))
    found = _found(classes, searched, count, length, norm, k, trees, target)
    # the vectors found stand for all rows that have them
    listed = found.select(F.col("id").alias("class"), F.posexplode(F.arrays_zip("ids", "scores")).alias("place", "c")).select("class", "c.scores", F.col("c.ids").alias("other"))
    members = listed.join(classes.select(F.col("id").alias("other"), "members"), "other").groupBy("class").agg(F.collect_list(F.struct("scores", "members")).alias("found"))
    every = F.flatten(F.transform("found", lambda f: F.transform(f["members"], lambda m: F.struct((-f["scores"]).alias("far"), m.alias("id"), f["scores"].alias("score")))))
    answers = queries.select("id", "class").join(members.select("class", F.array_sort(every).alias("all")), "class")
    others = F.slice(F.filter("all", lambda c: c["id"] != F.col("id")), 1, k)
    return answers.select(F.col("id").alias("query_id"), F.posexplode(others).alias("place", "c")).select("query_id", (F.col("place") + 1).alias("rank"), F.col("c.id").alias("vec_id"), F.col("c.score").alias("score"))


def _found(classes: DataFrame, searched: DataFrame, count: int, length: int, norm: float, k: int, trees: int, target: float) -> DataFrame:
    """id, ids, scores: the k + 1 best of all vectors for each vector searched for, itself among them."""
    most = max(LEAST_SAMPLED, min(SAMPLE, SAMPLE_BYTES // (8 * length)))
    sample = np.array([r["v"] for r in _some(classes, count, most)], np.float64).reshape(-1, length)
    depth = max(0, min(int(np.ceil(np.log2(count / LEAF))), int(np.log2(max(1, len(sample) / LEAST_SAMPLED)))))
    forest = fit(sample, norm, depth, trees)
    index = cut(_indexed(classes, forest))
    sizes = np.zeros((trees, 2**depth), np.int64)
    # as many rows as the forest has leaves
    for r in index.select(F.posexplode("leaves").alias("tree", "leaf")).groupBy("tree", "leaf").count().collect():
        sizes[r["tree"], r["leaf"]] = r["count"]
    n_searched = searched.count()
    trials = _some(searched, n_searched, TRIALS)
    asked, ids = np.array([r["v"] for r in trials], np.float64).reshape(-1, length), np.array([r["id"] for r in trials], np.int64)
    budget = entries_to_search(forest, sizes, asked, _true_neighbours(index, asked, ids, k), target)
    # groups of leaves of about a block
    bits = min(5, depth, max(0, int(np.log2(max(1.0, BLOCK * 2**depth / count)))))
    search = Search(forest, sizes, budget, bits)
    blocks = F.array(*(F.array(*(F.lit(max(1, -(-int(n) // BLOCK))) for n in tree.reshape(-1, 1 << bits).sum(1))) for tree in sizes))
    entries = index.select("id", "v", F.posexplode("leaves").alias("tree", "leaf")).withColumn("part", F.shiftright("leaf", bits))
    dealt = F.pmod(F.xxhash64("id"), blocks[F.col("tree")][F.col("part")])
    vectors = entries.withColumn("block", dealt).groupBy("tree", "part", "block").agg(F.collect_list(F.struct("id", "v", "leaf")).alias("vectors"))
    # a search costs far more than its row: as many tasks as there are cores, at least
    tasks = max(classes.sparkSession.sparkContext.defaultParallelism, -(-n_searched // QUERIES_PER_TASK))
    visits = cut(_visits(searched.repartition(tasks, "id"), search))
    chunks = visits.groupBy("tree", "part").agg(F.ceil(F.count("*") / CHUNK).alias("chunks"))
    chunked = visits.join(chunks, ["tree", "part"]).withColumn("chunk", F.pmod(F.xxhash64("id"), "chunks"))
    queries = chunked.groupBy("tree", "part", "chunk").agg(F.collect_list(F.struct("id", "v", "mask")).alias("queries"))
    met = cut(vectors).join(cut(queries), ["tree", "part"]).select("queries", "vectors")
    return cut(_merged(_scored(met, bits, k + 1), k + 1))


def recall(vectors: DataFrame, found: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> float:
    """The share of the true neighbours of the queries among those found, by brute force on the driver: for measurements on tables that fit there."""
    rows = usable(vectors, id_col, vector_col).withColumn("asked", is_query).orderBy("id").collect()
    ids, all_vectors = np.array([r["id"] for r in rows]), np.array([r["v"] for r in rows])
    answers: dict[int, set] = {}
    for r in found.select("query_id", "vec_id").collect():
        answers.setdefault(r["query_id"], set()).add(r["vec_id"])
    met = wanted = 0
    for at in np.flatnonzero([r["asked"] for r in rows]):
        rough = (all_vectors @ all_vectors[at])[None]
        rough[0, at] = -np.inf
        true, _, _ = best(all_vectors[at : at + 1], all_vectors, rough, ids, k)
        met, wanted = met + len(answers.get(int(ids[at]), set()) & set(true.tolist())), wanted + len(true)
    return met / max(wanted, 1)
