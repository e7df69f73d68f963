"""Questions asked of the gold layer."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _day(as_of: date | str | Column | None) -> Column:
    if as_of is None:
        return F.current_date()
    return as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")


def top_locations(gold: DataFrame, as_of=None, days_back: int = 1, n: int = 10) -> DataFrame:
    """The n fastest locations by mean of the hourly download means, since `days_back` days before `as_of`.

    The window has the grain of days (yesterday and today, not the last 24 hours), so it prunes
    partitions. Ties at the cut go by name.
    """
    return (
        gold.where(F.col("date") >= F.date_sub(_day(as_of), days_back))
        .groupBy("location")
        .agg(F.avg("avg_download_speed").alias("avg_dl"))
        .orderBy(F.desc_nulls_last("avg_dl"), F.asc_nulls_last("location"))
        .limit(n)
    )


def top_locations_weighted(kpis: DataFrame, as_of=None, days_back: int = 1, n: int = 10) -> DataFrame:
    """As `top_locations`, but the mean over all samples: every hour weighs by its sample count."""
    total = F.sum("sample_count")
    return (
        kpis.where(F.col("date") >= F.date_sub(_day(as_of), days_back))
        .groupBy("location")
        .agg(
            (F.sum(F.col("avg_download_speed") * F.col("sample_count")) / total).alias("avg_dl"),
            total.alias("sample_count"),
        )
        .orderBy(F.desc_nulls_last("avg_dl"), F.asc_nulls_last("location"))
        .limit(n)
    )


def hourly_trend(gold: DataFrame, location: str) -> DataFrame:
    return (
        gold.where(F.col("location") == F.lit(location))
        .groupBy("date", "hour")
        .agg(F.avg("avg_download_speed").alias("avg_dl"), F.avg("avg_upload_speed").alias("avg_ul"))
        .orderBy(F.asc_nulls_last("date"), F.asc_nulls_last("hour"))
    )


def latency_by_location(gold: DataFrame) -> DataFrame:
    return (
        gold.groupBy("location")
        .agg(F.avg("avg_latency").alias("avg_latency"))
        .orderBy(F.asc_nulls_last("avg_latency"), F.asc_nulls_last("location"))
    )


def gold_today(gold: DataFrame, as_of=None) -> DataFrame:
    """The gold rows of one day."""
    return gold.where(F.col("date") == _day(as_of)).select(
        "date", "location", "avg_upload_speed", "avg_download_speed", "avg_latency"
    )


def date_distribution(df: DataFrame) -> DataFrame:
    """Rows per date, ordered; rows without a date come first."""
    return df.groupBy("date").agg(F.count(F.lit(1)).alias("count")).orderBy("date")


def preview_rows(df: DataFrame, n: int = 10, order_by: tuple[str, ...] = ()) -> DataFrame:
    """A look at n rows; in a given order where it has to be repeatable."""
    return df.orderBy(*order_by).limit(n) if order_by else df.limit(n)
