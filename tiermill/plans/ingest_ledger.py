"""Which ranges of the messages are in bronze: an intent before each ingest, a mark after it.

An ingest run first writes the ranges it will read, then its rows into partitions of its own (`ingest_run`), then that it
is done. A run that ends in between leaves an open intent. `settle` closes it: where all its messages are in the
table, the mark alone is missing; else the same ranges are read again and the run's own partitions replaced. So each
message is in bronze once, wherever a run breaks off. Covered ranges are sets, not one high-water mark: what lies
before, between or after them is read by the next run. One ingest at a time, as with any writer of offsets.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiermill.config import PipelineConfig
from tiermill.schemas import INGEST_RANGES, INGEST_RUN
from tiermill.sinks.tables import append, ensure_table
from tiermill.sources.messages import read_ranges
from tiermill.sources.ranges import Ranges, merged, rows_of

OPEN, DONE = "open", "done"


def source_of(cfg: PipelineConfig) -> str:
    """What offsets count in: the topic, or the landing folder, whose parts are its files."""
    return cfg.message_path if cfg.message_format == "text" else cfg.topic


@contextmanager
def intent(spark: SparkSession, cfg: PipelineConfig, run_id: str, ranges: Ranges) -> Iterator[None]:
    """The ranges are open while the body writes them, and done after it."""
    _add(spark, cfg, run_id, OPEN, ranges)
    yield
    mark_done(spark, cfg, run_id)


def mark_done(spark: SparkSession, cfg: PipelineConfig, run_id: str) -> None:
    _add(spark, cfg, run_id, DONE, None)


def _add(spark: SparkSession, cfg: PipelineConfig, run_id: str, event: str, ranges: Ranges | None) -> None:
    rows = rows_of(ranges) if ranges is not None else [(None, None, None)]
    entries = spark.createDataFrame([(run_id, event, source_of(cfg), *r, None) for r in rows], INGEST_RANGES)
    append(entries.withColumn("at", F.current_timestamp()).coalesce(1), cfg, "ingest_ranges")


def ensure(spark: SparkSession, cfg: PipelineConfig) -> None:
    ensure_table(spark, cfg, "ingest_ranges")


def _ledger(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    ensure(spark, cfg)
    spark.catalog.refreshTable(cfg.table_name("ingest_ranges"))
    return spark.table(cfg.table_name("ingest_ranges")).where(F.col("source") == source_of(cfg))


def covered(spark: SparkSession, cfg: PipelineConfig) -> Ranges:
    """The ranges of all runs that are done, joined where they touch: what reaches the driver are their islands."""
    log = _ledger(spark, cfg)
    done = log.where(F.col("event") == DONE).select("run_id")
    ranges = log.where(F.col("event") == OPEN).join(done, "run_id", "left_semi")
    before = Window.partitionBy("part").orderBy("first_offset", "next_offset")
    apart = F.col("first_offset") > F.max("next_offset").over(before.rowsBetween(Window.unboundedPreceding, -1))
    islands = ranges.withColumn("apart", F.coalesce(apart, F.lit(True)).cast("int")).withColumn("island", F.sum("apart").over(before.rowsBetween(Window.unboundedPreceding, 0)))
    joined = islands.groupBy("part", "island").agg(F.min("first_offset").alias("a"), F.max("next_offset").alias("b"))
    return merged((r["part"], r["a"], r["b"]) for r in joined.collect())


def open_intents(spark: SparkSession, cfg: PipelineConfig) -> dict[str, Ranges]:
    """Ranges by run of the runs that broke off, oldest first."""
    log = _ledger(spark, cfg)
    done = log.where(F.col("event") == DONE).select("run_id")
    left = log.where(F.col("event") == OPEN).join(done, "run_id", "left_anti").orderBy("at", "run_id")
    by_run: dict[str, list] = {}
    for r in left.collect():
        by_run.setdefault(r["run_id"], []).append((r["part"], r["first_offset"], r["next_offset"]))
    return {run: merged(rows) for run, rows in by_run.items()}


def rows_of_run(spark: SparkSession, cfg: PipelineConfig, run_id: str) -> DataFrame:
    """What a run has left in bronze: its partitions alone."""
    spark.catalog.refreshTable(cfg.table_name("bronze"))
    return spark.table(cfg.table_name("bronze")).where(F.col(INGEST_RUN.name) == run_id)


def settle(spark: SparkSession, cfg: PipelineConfig, write: Callable[[str, DataFrame], dict]) -> dict[str, list[str]]:
    """Close all open intents; the dates of each run's rows, by run. `write(run_id, messages)` replaces a run's rows.

    Rows are there if as many are there as the ranges have messages now, or more (a topic forgets).
    """
    settled = {}
    for run_id, ranges in open_intents(spark, cfg).items():
        messages, there = read_ranges(spark, cfg, ranges), rows_of_run(spark, cfg, run_id)
        if there.count() < messages.count():
            write(run_id, messages)
            there = rows_of_run(spark, cfg, run_id)
        settled[run_id] = sorted(r["date"] for r in there.where(F.col("date").isNotNull()).select(F.col("date").cast("string").alias("date")).distinct().collect())
        mark_done(spark, cfg, run_id)
    return settled
