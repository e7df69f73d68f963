"""The table-to-table jobs, each one write."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.config import PipelineConfig, configure_session, sized_shuffles
from tiermill.operators.cleaning import COPIES, dedup, drop_nulls
from tiermill.operators.hourly import gold_hourly
from tiermill.operators.parsing import add_date, add_date_if_missing, parse_messages
from tiermill.plans import day_marks
from tiermill.plans import ingest_ledger as ledger
from tiermill.plans.maintenance import maintenance_report
from tiermill.plans.run_log import Run, logged_run, write_observed
from tiermill.schemas import INGEST_RUN
from tiermill.sinks.tables import ensure_table, group_for_table, group_for_write, overwrite_all, overwrite_partitions, sort_for_write
from tiermill.sources.layers import bytes_to_read, read_layer
from tiermill.sources.messages import available, read_messages, read_ranges
from tiermill.sources.ranges import without


def ingest_bronze(
    spark: SparkSession,
    cfg: PipelineConfig,
    starting_offsets: str | None = None,
    ending_offsets: str | None = None,
    by_date: bool = False,
    resume: bool = False,
) -> Run:
    """Topic to bronze, appended.

    With `resume`, a run first settles what an earlier one that broke off has left, and then reads exactly the ranges
    that no run has covered, so that each message is in bronze once: what came since, and what earlier runs left out before
    or between theirs. The offsets in hand are found by a scan of two columns, or the listing of a landing folder.
    Offsets are JSON as a topic reader takes them, the end exclusive; over Kafka a run that is to resume, or to be resumed
    after, needs `ending_offsets`.

    Map-only: a topic is about in time order, so a task meets few dates and nothing is
    shuffled. For a backfill out of order, `by_date` groups the rows first.
    """
    configure_session(spark)
    ensure_table(spark, cfg, "bronze")
    with logged_run(spark, cfg, "ingest_bronze") as run:
        ranges = available(spark, cfg, starting_offsets, ending_offsets)
        earlier: dict[str, list[str]] = {}
        if resume:
            if ranges is None:
                raise ValueError("a resumed ingest over Kafka needs ending_offsets: the topic's end isn't known without reading it")
            earlier = ledger.settle(spark, cfg, lambda run_id, messages: write_run(messages, cfg, run_id, by_date))
            ranges = without(ranges, ledger.covered(spark, cfg))
        if ranges is None:
            counts = write_run(read_messages(spark, cfg, starting_offsets, ending_offsets), cfg, run.run_id, by_date)
        elif ranges:
            ledger.ensure(spark, cfg)
            with ledger.intent(spark, cfg, run.run_id, ranges):
                counts = write_run(read_ranges(spark, cfg, ranges), cfg, run.run_id, by_date)
        else:
            counts = {"rows": 0, "undated": 0, "dates": [], "first_date": None, "last_date": None}
        run.rows_in = run.rows_out = counts["rows"]
        run.rows_rejected = counts["undated"]
        run.dates = sorted({d for d in counts["dates"] if d is not None}.union(*earlier.values()))
        run.first_date, run.last_date = counts["first_date"], counts["last_date"]
    return run


def write_run(messages: DataFrame, cfg: PipelineConfig, run_id: str, by_date: bool = False) -> dict:
    """A run's rows into partitions of its own, in place of what it may have left there."""
    bronze = add_date(parse_messages(messages, cfg.keep_lineage), cfg.ts_unit).withColumn(INGEST_RUN.name, F.lit(run_id))
    if by_date:
        bronze = group_for_write(bronze, "date")
    # What no dated run will meet again: messages that are no event, and events without a date.
    return write_observed(bronze, lambda df: overwrite_partitions(df, cfg, "bronze"), undated=F.count_if(F.col("date").isNull()))


def bronze_to_silver(
    spark: SparkSession, cfg: PipelineConfig, date_from=None, date_to=None, full_refresh: bool = False, dates: Sequence | None = None
) -> Run:
    """Bronze to silver: clean, deduplicate, replace the dates in hand.

    A date range, or a list of days, confines scan, shuffle and write to those days; that is the daily run.
    Copies share their timestamp, hence their date, so a day can be done without looking at another.
    """
    _check_refresh(date_from, date_to, full_refresh, dates)
    configure_session(spark)
    ensure_table(spark, cfg, "silver")
    with logged_run(spark, cfg, "bronze_to_silver") as run:
        # Rows without a date lie in no dated run; ingest has counted them.
        bronze = read_layer(spark, cfg, "bronze", date_from, date_to, dates).where(F.col("date").isNotNull()).select(*cfg.schema("silver").fieldNames())
        silver = add_date_if_missing(dedup(drop_nulls(bronze), count_copies=True), cfg.ts_unit)
        silver = sort_for_write(group_for_table(silver, cfg, "silver", "date"), "date", "location", "timestamp")
        with sized_shuffles(spark, bytes_to_read(bronze)):
            counts = write_observed(silver, lambda df: _replace(df, cfg, "silver", full_refresh), helper=COPIES, copies=F.coalesce(F.sum(COPIES), F.lit(0)))
        # Read from file footers, not from the data.
        run.rows_in = bronze.count()
        run.rows_rejected = run.rows_in - counts["copies"]
        run.rows_out = counts["rows"]
        run.first_date, run.last_date = counts["first_date"], counts["last_date"]
    return run


def silver_to_gold(
    spark: SparkSession, cfg: PipelineConfig, date_from=None, date_to=None, full_refresh: bool = False, dates: Sequence | None = None
) -> Run:
    """Silver to gold: hourly means per location, replacing the partitions in hand."""
    _check_refresh(date_from, date_to, full_refresh, dates)
    configure_session(spark)
    ensure_table(spark, cfg, "gold")
    with logged_run(spark, cfg, "silver_to_gold") as run:
        silver = read_layer(spark, cfg, "silver", date_from, date_to, dates)
        gold = group_for_write(gold_hourly(silver, cfg.ts_unit), *cfg.partition_by("gold"))
        gold = sort_for_write(gold, "date", "location", "hour")
        with sized_shuffles(spark, bytes_to_read(silver)):
            counts = write_observed(gold, lambda df: _replace(df, cfg, "gold", full_refresh))
        run.rows_in = silver.count()
        run.rows_rejected = 0
        run.rows_out = counts["rows"]
        run.first_date, run.last_date = counts["first_date"], counts["last_date"]
    return run


def run_medallion(
    spark: SparkSession, cfg: PipelineConfig, date_from=None, date_to=None, touched_only: bool = False, resume: bool = False
) -> tuple[list[Run], DataFrame]:
    """All jobs in order; their runs and the maintenance report.

    With `touched_only`, silver and gold are redone for exactly the days among the messages just ingested: a stray
    date adds its own day and none between. All other days stay as they are: their bronze has not changed.
    """
    runs = [ingest_bronze(spark, cfg, resume=resume)]
    dates = runs[0].dates if touched_only else None
    if dates is None or dates:
        runs.append(bronze_to_silver(spark, cfg, date_from, date_to, dates=dates))
        runs.append(silver_to_gold(spark, cfg, date_from, date_to, dates=dates))
    return runs, maintenance_report(spark, cfg)


def redo_changed(spark: SparkSession, cfg: PipelineConfig, date_from=None, date_to=None) -> list[Run]:
    """Silver and gold of the days, of those in hand, whose bronze isn't what it was when they were last redone here.

    One scan of bronze tells (no sort, no shuffle of rows); the marks are taken before the jobs read it, so what comes in
    between counts as a change next time.
    """
    configure_session(spark)
    bronze = read_layer(spark, cfg, "bronze", date_from, date_to).select(*cfg.schema("silver").fieldNames())
    with sized_shuffles(spark, bytes_to_read(bronze)):
        marks = day_marks.changed(spark, cfg, "redo_changed", bronze).collect()
    days = sorted(m["day"] for m in marks)
    if not days:
        return []
    runs = [bronze_to_silver(spark, cfg, dates=days), silver_to_gold(spark, cfg, dates=days)]
    day_marks.keep(spark, cfg, "redo_changed", runs[-1].run_id, marks)
    return runs


def _replace(df, cfg: PipelineConfig, layer: str, full_refresh: bool) -> None:
    (overwrite_all if full_refresh else overwrite_partitions)(df, cfg, layer)


def _check_refresh(date_from, date_to, full_refresh: bool, dates) -> None:
    if full_refresh and not (date_from is None and date_to is None and dates is None):
        raise ValueError("full_refresh replaces the whole table and cannot go with a date range")
