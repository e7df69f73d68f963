"""Scans of the metric samples (one row per metric, series and time)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.config import PipelineConfig
from tiermill.functions.predicates import between_dates
from tiermill.schemas import METRICS, METRICS_BY_DATE

# Metric names that existing dashboards query.
BRONZE_ROWS = "bronze_table_row_count"
SILVER_ROWS = "silver_table_row_count"
GOLD_ROWS = "gold_table_row_count"
MESSAGE_COUNT = "kafka_message_count"
LAST_UPDATE = "table_last_update_timestamp"
MESSAGES_IN = "kafka_server_brokertopicmetrics_messagesin_total"
JOB_DURATION = "spark_job_duration"
QUERY_ELAPSED = "trino_query_elapsed_time_seconds"

ROW_COUNTS = (BRONZE_ROWS, SILVER_ROWS, GOLD_ROWS)


def read_metrics(spark: SparkSession, cfg: PipelineConfig, date_from=None, date_to=None) -> DataFrame:
    """Samples with their day; a range of days, or a time range taken of them, reads only these partitions."""
    samples = spark.table(cfg.table_name("metrics")).where(between_dates(date_from, date_to))
    return samples.select(*METRICS_BY_DATE.fieldNames())


def read_current(spark: SparkSession, cfg: PipelineConfig, metrics: Sequence[str] | None = None) -> DataFrame:
    """The newest sample of each series, as folded in when samples came: history isn't read."""
    newest = current_version(spark, cfg)
    current = spark.table(cfg.table_name("metrics_current")).where(F.col("version") == (-1 if newest is None else newest))
    if metrics is not None:
        current = current.where(F.col("metric").isin(*metrics))
    return current.select(*METRICS.fieldNames())


def current_version(spark: SparkSession, cfg: PipelineConfig) -> int | None:
    """The newest whole version; a look at the names of two or three partitions."""
    spark.catalog.refreshTable(cfg.table_name("metrics_current"))
    return spark.table(cfg.table_name("metrics_current")).agg(F.max("version")).first()[0]


def time_range(samples: DataFrame, as_of: str | Column, hours: int = 1) -> DataFrame:
    """Samples of the trailing hours, both ends included.

    Where the samples have their partition column `date`, the days in hand are pruned by it.
    """
    end = F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of
    if "date" in samples.columns:
        samples = samples.where(F.col("date").between(F.to_date(end - F.expr(f"INTERVAL '{int(hours)}' HOUR")), F.to_date(end)))
    return samples.where((F.col("ts") >= end - F.expr(f"INTERVAL '{int(hours)}' HOUR")) & (F.col("ts") <= end))


def latest(value: Column, ts: Column) -> Column:
    """Aggregate: the value of the newest sample, the largest one where two share the time."""
    return F.max(F.struct(ts.alias("ts"), value.alias("value")))["value"]


def latest_values(samples: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Newest value per metric and series."""
    return (
        samples.where(F.col("metric").isin(*metrics))
        .groupBy("metric", "series")
        .agg(
            F.max("ts").alias("ts"),
            latest(F.col("value"), F.col("ts")).alias("value"),
        )
    )
