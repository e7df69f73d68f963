"""Hourly aggregates per location."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.operators.parsing import add_hour
from tiermill.operators.percentiles import measure_statistics, percentile_name
from tiermill.schemas import MEASURES

GOLD_KEYS = ("date", "location", "hour")


def gold_hourly(silver: DataFrame, ts_unit: str = "ms") -> DataFrame:
    """Mean of each measure per date, location and hour; partial sums leave the map side."""
    means = [F.avg(m).alias(f"avg_{m}") for m in MEASURES]
    return add_hour(silver, ts_unit).groupBy(*GOLD_KEYS).agg(*means)


def gold_parts(silver: DataFrame, ts_unit: str = "ms") -> DataFrame:
    """Sums and counts of each measure per date, location and hour: what merges into gold with those of other rows."""
    sums = [f(F.col(m)).cast(kind).alias(f"{name}_{m}") for m in MEASURES for name, f, kind in (("sum", F.sum, "double"), ("count", F.count, "long"))]
    return add_hour(silver, ts_unit).groupBy(*GOLD_KEYS).agg(*sums)


def merged_parts(parts: DataFrame) -> DataFrame:
    """Parts of the same date, location and hour as one."""
    return parts.groupBy(*GOLD_KEYS).agg(*[F.sum(f"{name}_{m}").alias(f"{name}_{m}") for m in MEASURES for name in ("sum", "count")])


def gold_of_parts(parts: DataFrame) -> DataFrame:
    """Gold from parts: no row of silver is read."""
    mean = lambda m: F.when(F.col(f"count_{m}") > 0, F.col(f"sum_{m}") / F.col(f"count_{m}"))
    return merged_parts(parts).select(*GOLD_KEYS, *[mean(m).alias(f"avg_{m}") for m in MEASURES])


def gold_kpis(silver: DataFrame, probabilities: Sequence[float] = (0.5, 0.95), ts_unit: str = "ms") -> DataFrame:
    """Gold with sample count, minimum, maximum and exact percentiles of each measure.

    With `sample_count` at hand, means can be rolled up without the error of averaging averages.
    """
    if not probabilities:
        # One shuffle of partial results, as for gold.
        plain = (("avg", F.avg), ("min", F.min), ("max", F.max))
        columns = [f(m).cast("double").alias(f"{name}_{m}") for m in MEASURES for name, f in plain]
        return add_hour(silver, ts_unit).groupBy(*GOLD_KEYS).agg(F.count(F.lit(1)).alias("sample_count"), *columns)
    statistics = measure_statistics(add_hour(silver, ts_unit), GOLD_KEYS, MEASURES, probabilities)
    names = ["avg", "min", "max", *[percentile_name(p) for p in probabilities]]

    def of_measure(measure: str, name: str):
        return F.max(F.when(F.col("measure") == measure, F.col(name))).alias(f"{name}_{measure}")

    return statistics.groupBy(*GOLD_KEYS).agg(
        F.max("n").alias("sample_count"),
        *[of_measure(m, name) for m in MEASURES for name in names],
    )
