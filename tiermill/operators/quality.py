"""Data-quality figures."""

from __future__ import annotations

from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.functions.predicates import is_present
from tiermill.schemas import BRONZE, DEDUP_KEYS, EVENT


def quality_report(bronze: DataFrame) -> DataFrame:
    """One row: what came in, what is wrong with it, and what the silver layer will hold.

    Missing values are counted per column, malformed messages are those without any field, and
    clean rows divide into survivors and duplicates.

    One scan and one shuffle. A row's defects are one number, a bit each; rows are counted per
    number and, where there is no defect, per key, so that keys are told apart exactly while
    defective rows fold into a few sums before the shuffle.
    """
    defects = {f"missing_{f.name}": ~is_present(f) for f in BRONZE.fields}
    defects["malformed"] = reduce(and_, [F.col(c).isNull() for c in EVENT.fieldNames()])
    bits = {name: 1 << i for i, name in enumerate(defects)}
    found = reduce(add, [F.when(condition, bits[name]).otherwise(0) for name, condition in defects.items()])

    counted = (
        bronze.withColumn("defects", found)
        .groupBy("defects", *[F.when(F.col("defects") == 0, F.col(k)).alias(k) for k in DEDUP_KEYS])
        .agg(F.count(F.lit(1)).alias("n"))
    )
    clean = F.col("defects") == 0

    def rows(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    return counted.agg(
        rows(F.lit(True)).alias("rows_in"),
        *[rows(F.col("defects").bitwiseAND(bit) != 0).alias(name) for name, bit in bits.items()],
        rows(~clean).alias("rejected"),
        (rows(clean) - F.count_if(clean)).alias("duplicates"),
        F.count_if(clean).alias("survivors"),
    )


def error_rate(run_log: DataFrame) -> DataFrame:
    """Rejected rows in percent of the rows read, per run."""
    return run_log.where(F.col("rows_in").isNotNull()).select(
        "run_id",
        "job",
        "rows_in",
        "rows_rejected",
        (F.try_divide(F.col("rows_rejected"), F.col("rows_in")) * 100).alias("error_pct"),
    )
