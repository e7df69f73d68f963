"""Null removal and deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.functions.predicates import all_present
from tiermill.schemas import DEDUP_KEYS

COPIES = "_copies"


def drop_nulls(df: DataFrame) -> DataFrame:
    """Rows without a null or NaN in any column."""
    return df.where(all_present(df.schema))


def dedup(df: DataFrame, keys: Sequence[str] = DEDUP_KEYS, count_copies: bool = False) -> DataFrame:
    """One row per key: the smallest of the copies, comparing the other columns left to right.

    The survivor does not depend on row order. As an aggregate it combines copies before the
    shuffle, so a key that holds a large part of all rows arrives as one row per map task; a
    ranking window would bring all its copies to one task. `count_copies` adds their number.
    """
    rest = [c for c in df.columns if c not in keys]
    aggregates = [F.min(F.struct(*rest)).alias("_first")]
    if count_copies:
        aggregates.append(F.count(F.lit(1)).alias(COPIES))
    picked = df.groupBy(*keys).agg(*aggregates)
    columns = [F.col(c) if c in keys else F.col(f"_first.{c}") for c in df.columns]
    return picked.select(*columns, *([COPIES] if count_copies else []))


def clean(df: DataFrame) -> DataFrame:
    """Bronze rows to silver rows."""
    return dedup(drop_nulls(df))
