"""A bounded sample of labelled texts, as sparse features, for training on the driver."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from tiermill.llm.lineage import cut
from tiermill.llm.rows import map_texts

#: Entries of features that a sample has at most: some 100 MB on the driver.
MOST_ENTRIES = 8_000_000


def fold_of(id_col: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as empty text."""
    return (F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds).cast("int")


class Sparse:
    """Rows of (place, weight), joined: row r has the entries from starts[r] to starts[r + 1]."""

    def __init__(self, places: list, weights: list | None = None):
        self.starts = np.concatenate([[0], np.cumsum([len(p) for p in places])]).astype(np.int64)
        self.places = np.concatenate([np.asarray(p, np.int64) for p in places]) if places else np.zeros(0, np.int64)
        self.weights = np.concatenate([np.asarray(w, np.float32) for w in weights]) if weights else np.ones(len(self.places), np.float32)

    def rows(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places and weights of the chosen rows, and for each entry the number of its row among them."""
        sizes = self.starts[chosen + 1] - self.starts[chosen]
        row = np.repeat(np.arange(len(chosen)), sizes)
        at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(self.starts[chosen], sizes)
        return self.places[at], self.weights[at], row


def sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, most: int, features: Callable[[list[str]], dict[str, list]], schema: str) -> list:
    """(label, features) of `most` labelled rows at most, chosen by a hash of the id.

    Ids come in the hash's order, so the sample is the same on every run. Rows without an id, a label of 0 or 1 or a text
    are left out; of ids with several labels or texts each pair is a row, up to `most` in all. Rows beyond MOST_ENTRIES
    entries of features in that order are left out too, so that what reaches the driver is bounded in bytes.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & learn)
    some = known.select("doc_id", F.col(label).cast("int").alias("label"), F.xxhash64("doc_id").alias("place")).distinct().orderBy("place", "doc_id", "label").limit(most)
    # `most` rows of 20 bytes: a proven bound
    found = docs.filter("text is not null").select("doc_id", "text").join(F.broadcast(some), "doc_id")
    made = map_texts(found, features, schema, {"doc_id": F.col("doc_id"), "label": F.col("label"), "place": F.col("place"), "version": F.xxhash64("text")})
    order = ["place", "doc_id", "label", "version"]
    made = cut(made.orderBy(*order).limit(most))
    lists = [f.name for f in made.schema if isinstance(f.dataType, ArrayType)]
    entries = sum((F.size(c) for c in lists), F.lit(0)).cast("long")
    if (made.select(F.sum(entries)).first()[0] or 0) > MOST_ENTRIES:
        # `most` rows at most: one task can order them
        so_far = F.sum(entries).over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
        made = made.withColumn("_so_far", so_far).filter(F.col("_so_far") <= MOST_ENTRIES).drop("_so_far")
    return made.orderBy(*order).collect()
