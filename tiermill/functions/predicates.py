"""Row predicates that the scan can use."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StructField, StructType


def is_present(field: StructField) -> Column:
    """Neither null nor, for floating point, NaN."""
    column = F.col(field.name)
    if isinstance(field.dataType, (FloatType, DoubleType)):
        return column.isNotNull() & ~F.isnan(column)
    return column.isNotNull()


def all_present(schema: StructType) -> Column:
    """True for the rows `DataFrame.dropna()` keeps.

    `dropna` plans as one opaque count of non-null columns; spelled out per column, the
    IS NOT NULL parts are pushed into the scan.
    """
    return reduce(and_, [is_present(f) for f in schema.fields])


def between_dates(date_from=None, date_to=None, column: str = "date") -> Column:
    """Closed date range, either end open; prunes partitions where the column is one."""
    condition = F.lit(True)
    if date_from is not None:
        condition = condition & (F.col(column) >= F.lit(date_from).cast("date"))
    if date_to is not None:
        condition = condition & (F.col(column) <= F.lit(date_to).cast("date"))
    return condition


def on_dates(dates: Iterable, column: str = "date") -> Column:
    """One of the given days, as dates or text; prunes partitions where the column is one."""
    return F.col(column).isin([F.lit(d).cast("date") for d in dates])
