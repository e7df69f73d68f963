"""Vector code compression: each part of a vector as the index of its nearest codebook entry, by exact rounds of k-means.

Norm-of-sum bounds spare most exact distances. Each row keeps, for each group of entries of a part, a lower bound on its
distance to them (its own entry aside) and the round of that bound, its stamp. The driver keeps the codebooks of all
rounds, so that a bound is lowered by how far an entry has really come since the stamp: the norm of the sum of its moves,
which is never more than the sum of their norms. Only groups whose lowered bound doesn't exceed the exact distance to the
own entry are scanned again. Distances are whole numbers below 2 ** 53, hence exact, and a bound decides only where it
holds by a margin far above its rounding; so the codes are those of full scans.

Rows stay in Spark: each round reads the table of the one before and writes its own, a codebook's sums are made in the
tasks, and the driver holds codebooks alone. Only rows that changed their entry are added and subtracted.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.lineage import cut, tidy

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Entries of a part that share a bound.
GROUP = 16
#: Whole numbers up to here are exact as doubles.
EXACT = 2**53
#: A bound decides if it holds by this share; its rounding (single precision) is far below.
MARGIN = 1e-6


@dataclass(frozen=True)
class Round:
    """What a task needs for one assignment: the codebooks (part, entry, position) and, for each earlier round, part and
    group of entries, how far one of them has come from there."""

    number: int
    books: np.ndarray
    moved: np.ndarray

    @property
    def groups(self) -> int:
        return -(-self.books.shape[1] // GROUP)


def next_round(history: list[np.ndarray]) -> Round:
    now = history[-1].astype(np.float64)
    starts = np.arange(0, now.shape[1], GROUP)
    moved = [np.maximum.reduceat(np.sqrt(((now - then) ** 2).sum(2)), starts, axis=1) for then in history]
    return Round(len(history) - 1, now, np.array(moved))


def squares(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of whole numbers, exact."""
    return (rows * rows).sum(1)[:, None] - 2 * (rows @ entries.T) + (entries * entries).sum(1)


def assign(part: np.ndarray, at: Round, p: int, codes: np.ndarray, lower: np.ndarray, stamps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest entries of one part's rows, their squared distances, and the numbers of exact distances taken.

    codes are those of the round before (-1: none yet); lower and stamps are brought up to date in place.
    """
    book, n_entries = at.books[p], at.books.shape[1]
    own = np.where(codes >= 0, ((part - book[codes]) ** 2).sum(1), np.inf)
    bounds = np.where(codes[:, None] >= 0, lower - at.moved[stamps, p, np.arange(at.groups)], -1.0)
    again = ~(np.sqrt(own)[:, None] * (1 + MARGIN) < bounds * (1 - MARGIN))
    best, nearest = own.copy(), codes.copy()
    seen: list[tuple[int, np.ndarray, np.ndarray]] = []
    taken = (codes >= 0).astype(np.int64)
    for g in range(at.groups):
        rows = np.flatnonzero(again[:, g])
        if not len(rows):
            continue
        first = g * GROUP
        far = squares(part[rows], book[first : first + GROUP])
        taken[rows] += far.shape[1]
        seen.append((g, rows, far))
        least = far.argmin(1)
        distance, entry = far[np.arange(len(rows)), least], least + first
        wins = (distance < best[rows]) | (distance == best[rows]) & (entry < nearest[rows]) | (nearest[rows] < 0)
        best[rows[wins]], nearest[rows[wins]] = distance[wins], entry[wins]
    for g, rows, far in seen:
        width = min(GROUP, n_entries - g * GROUP)
        inside = (nearest[rows] >= g * GROUP) & (nearest[rows] < g * GROUP + width)
        far[np.flatnonzero(inside), nearest[rows][inside] - g * GROUP] = np.inf
        lower[rows, g] = np.sqrt(far.min(1)) * (1 - MARGIN / 10)
        stamps[rows, g] = at.number
    # an entry that a row has left counts in its group from now on
    left = np.flatnonzero((nearest != codes) & (codes >= 0))
    group = codes[left] // GROUP
    unseen = ~again[left, group]
    left, group = left[unseen], group[unseen]
    lower[left, group] = np.minimum(bounds[left, group], np.sqrt(own[left])) * (1 - MARGIN / 10)
    stamps[left, group] = at.number
    return nearest, best, taken


STATE = "q array<long>, codes binary, before binary, lower binary, stamps binary, error long, scans long"


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of lists of one length as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _bytes(column: pa.Array, kind: type, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width).copy()


def _blobs(values: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in np.ascontiguousarray(values)], pa.binary())


def _assigned(state: DataFrame, at: Round) -> DataFrame:
    """The table after one assignment: rows (k, q, codes, before, lower, stamps, error, scans)."""
    n_parts, n_groups = at.books.shape[0], at.groups
    width = n_parts * n_groups

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if at.number:
                before = _bytes(batch.column("codes"), np.int16, n_parts)
                lower, stamps = _bytes(batch.column("lower"), np.float32, width), _bytes(batch.column("stamps"), np.int8, width)
                scans = batch.column("scans").to_numpy().copy()
            else:
                before, scans = np.full((n, n_parts), -1, np.int16), np.zeros(n, np.int64)
                lower, stamps = np.zeros((n, width), np.float32), np.zeros((n, width), np.int8)
            values = _matrix(batch.column("q")).astype(np.float64).reshape(n, n_parts, -1)
            codes, error = before.copy(), np.zeros(n)
            for p in range(n_parts):
                own = slice(p * n_groups, (p + 1) * n_groups)
                nearest, best, taken = assign(values[:, p], at, p, before[:, p].astype(np.int64), lower[:, own], stamps[:, own])
                codes[:, p] = nearest
                error += best
                scans += taken
            columns = [_blobs(codes), _blobs(before), _blobs(lower), _blobs(stamps), pa.array(error.astype(np.int64)), pa.array(scans)]
            yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("q"), *columns], ["k", "q", "codes", "before", "lower", "stamps", "error", "scans"])

    return state.mapInArrow(run, f"k {state.schema['k'].dataType.simpleString()}, {STATE}")


def _moves(state: DataFrame, n_parts: int, n_entries: int, length: int) -> DataFrame:
    """slot, place, total: what the sums (place -1: counts) of each entry have gained or lost by rows that changed theirs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros((n_parts * n_entries, length + 1), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            now, before = _bytes(batch.column("codes"), np.int16, n_parts), _bytes(batch.column("before"), np.int16, n_parts)
            values = _matrix(batch.column("q")).reshape(batch.num_rows, n_parts, length)
            for p in range(n_parts):
                moved = now[:, p] != before[:, p]
                for codes, sign in ((now[moved, p], 1), (before[moved, p], -1)):
                    known = codes >= 0
                    slots = p * n_entries + codes[known].astype(np.int64)
                    np.add.at(totals[:, 1:], slots, sign * values[moved, p][known])
                    np.add.at(totals[:, 0], slots, sign)
        slot, place = np.nonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array((place - 1).astype(np.int32)), pa.array(totals[slot, place])], ["slot", "place", "total"])

    return state.select("q", "codes", "before").mapInArrow(run, "slot int, place int, total long")


def whole_numbers(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """k (id, label) and q, the components as floor(scale * x), of vectors without null or non-finite components."""
    usable = ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.struct(F.col(id_col).alias("id"), F.col(label_col).alias("label")).alias("k"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.filter((F.size("v") > 0) & usable).select("k", F.transform("v", lambda x: F.floor(x * scale)).alias("q"))


@dataclass(frozen=True)
class Compressed:
    """rows: id, label, codes (array), error, scans; history: the codebooks (part, entry, position) of all rounds, the last
    one final; length of a vector."""

    rows: DataFrame
    history: list[np.ndarray]

    @property
    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.history[-1].ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> Compressed:
    """Codes of all usable vectors and the codebooks that `rounds` rounds lead to.

    A null vector, one without components and one with a null, NaN or infinite component are left out. A codebook starts
    from the parts of the `entries` vectors of the smallest ids (null ids last, ties by the whole numbers); with fewer vectors it
    is smaller. Rows that repeat an id are rows of their own. Ties go to the lower index; an entry that no part is nearest to
    stays. Without usable vectors there are no rows and no entries. Vectors must have one length, a multiple of `parts`,
    and components that keep squared distances below 2 ** 53; else a ValueError says so. Other columns are not read.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has two hexadecimal digits: 1 to 256 entries")
    state = cut(whole_numbers(vectors, id_col, vector_col, label_col, scale))
    seen = state.select(F.min(F.size("q")).alias("least"), F.max(F.size("q")).alias("most"), F.max(F.array_max(F.transform("q", F.abs))).alias("top"), F.min(F.array_min("q")).alias("low")).first()
    if seen["least"] is None:
        rows = state.select(F.col("k.id"), F.col("k.label"), F.array().cast("array<int>").alias("codes"), F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("scans"))
        return Compressed(rows, [np.zeros((parts, 0, 0), np.int64)])
    if seen["least"] != seen["most"] or seen["most"] % parts:
        raise ValueError(f"vectors must have one length, a multiple of {parts}; found {seen['least']} to {seen['most']}")
    length = seen["most"] // parts
    if seen["low"] == -(1 << 63) or length * (2 * seen["top"]) ** 2 >= EXACT:
        raise ValueError(f"components up to {seen['top'] / scale:g} are too large for exact distances")
    first = state.orderBy(F.asc_nulls_last("k.id"), "q").limit(entries).collect()
    start = np.array([r["q"] for r in first], np.int64).reshape(len(first), parts, length).transpose(1, 0, 2)
    history, sums, counts = [start], np.zeros(start.shape, np.int64), np.zeros(start.shape[:2], np.int64)
    for _ in range(rounds):
        state = cut(_assigned(state, next_round(history)))
        # as many rows as the codebooks have components
        for r in _moves(state, parts, len(first), length).groupBy("slot", "place").agg(F.sum("total").alias("total")).collect():
            p, e = divmod(r["slot"], len(first))
            if r["place"] < 0:
                counts[p, e] += r["total"]
            else:
                sums[p, e, r["place"]] += r["total"]
        history.append(np.where(counts[..., None] > 0, sums // np.maximum(counts, 1)[..., None], history[-1]))
    final = cut(_assigned(state, next_round(history)).select("k", "codes", "error", "scans"))
    # two bytes each, the lower one first
    places = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.conv(F.hex(F.substring("codes", p * 2 + 1, F.lit(1))), 16, 10).cast("int"))
    return Compressed(final.select(F.col("k.id"), F.col("k.label"), places.alias("codes"), "error", "scans"), history)


@tidy
def code_table(vectors: DataFrame, **options) -> DataFrame:
    """id, code (two hexadecimal digits of each part), error, label_error (summed over rows of the label; null is one), codebooks_sha256."""
    done = compress(vectors, **options)
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    totals = done.rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    rows = done.rows.join(totals, F.col("label").eqNullSafe(F.col("_label")))
    return rows.select("id", code.alias("code"), "error", "label_error", F.lit(done.digest).alias("codebooks_sha256"))


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    steps = []
    for t in range(rounds + 1):
        steps.append(
            f"a{t} AS MATERIALIZED (SELECT r, p, any_value(v) AS v, min({{'d': list_inner_product(v, v) - 2 * list_inner_product(v, c) + list_inner_product(c, c), 'e': e}}) AS best "
            f"FROM part JOIN b{t} USING (p) GROUP BY r, p)"
        )
        if t < rounds:
            steps.append(f"s{t} AS (SELECT p, e, list(m ORDER BY i) AS c FROM (SELECT p, best.e AS e, i, floor(sum(v[i]) / count(*)) AS m FROM a{t}, (SELECT unnest(range(1, max(d) + 1)) AS i FROM q) GROUP BY ALL) GROUP BY p, e)")
            steps.append(f"b{t + 1} AS MATERIALIZED (SELECT p, e, coalesce(s.c, b.c) AS c FROM b{t} b LEFT JOIN s{t} s USING (p, e))")
    return f"""
WITH q AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r, *
  FROM (SELECT vec_id, label, len(embedding) // {parts} AS d, [floor({scale} * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings WHERE len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0)),
part AS MATERIALIZED (SELECT r, p, v[p * d + 1:(p + 1) * d] AS v FROM q, (SELECT unnest(range({parts})) AS p)),
b0 AS MATERIALIZED (SELECT p, r - 1 AS e, v AS c FROM part WHERE r <= {entries}),
{", ".join(steps)},
coded AS (SELECT r, string_agg(lpad(lower(to_hex(best.e)), 2, '0'), '' ORDER BY p) AS code, sum(best.d) AS error FROM a{rounds} GROUP BY r),
digest AS (SELECT sha256(string_agg(array_to_string([CAST(CAST(x AS BIGINT) AS VARCHAR) FOR x IN c], ','), ',' ORDER BY p, e)) AS h FROM b{rounds})
SELECT vec_id, code, CAST(error AS BIGINT) AS error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM coded JOIN q USING (r), digest
"""


#: The same in SQL, by full scans.
SQL = _sql()
