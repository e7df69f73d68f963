"""Marks of days: which days of a layer have changed since a job last took them.

A day's mark is its number of rows and the sum over a 64-bit hash of each: the same for the same rows in whatever order
and files they lie. Marks are compared before a job and kept after it, so a day whose rows are as before isn't redone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.config import PipelineConfig
from tiermill.schemas import DAY_MARKS
from tiermill.sinks.tables import append, ensure_table


def marks_of(rows: DataFrame) -> DataFrame:
    """day, rows, hash of each date: one scan, combined before a shuffle of one row per day and task."""
    columns = sorted(c for c in rows.columns if c != "date")
    # the sum of hashes as wide numbers: addition knows no order, and rows that repeat don't cancel each other
    total = F.sum(F.xxhash64(*columns).cast("decimal(20,0)")).cast("string")
    dated = rows.where(F.col("date").isNotNull())
    return dated.groupBy(F.col("date").cast("string").alias("day")).agg(F.count(F.lit(1)).alias("rows"), total.alias("hash"))


def changed(spark: SparkSession, cfg: PipelineConfig, job: str, rows: DataFrame) -> DataFrame:
    """The marks of the days that differ from those that `job` kept last, or have none."""
    ensure_table(spark, cfg, "day_marks")
    spark.catalog.refreshTable(cfg.table_name("day_marks"))
    kept = spark.table(cfg.table_name("day_marks")).where(F.col("job") == job)
    last = kept.groupBy("day").agg(F.max(F.struct("at", "rows", "hash")).alias("last")).select("day", "last.rows", "last.hash")
    return marks_of(rows).join(last, ["day", "rows", "hash"], "left_anti")


def keep(spark: SparkSession, cfg: PipelineConfig, job: str, run_id: str, marks: list) -> None:
    """Remember the marks (day, rows, hash) of the days that a run has taken."""
    if marks:
        entries = spark.createDataFrame([(run_id, job, m["day"], m["rows"], m["hash"], None) for m in marks], DAY_MARKS)
        append(entries.withColumn("at", F.current_timestamp()).coalesce(1), cfg, "day_marks")
