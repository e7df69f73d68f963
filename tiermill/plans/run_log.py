"""One row per job run, and the counts that go into it."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import date, datetime, timezone
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tiermill.config import PipelineConfig
from tiermill.schemas import RUN_LOG
from tiermill.sinks.tables import append, ensure_table


@dataclass
class Run:
    """What a job did; filled in while it runs."""

    job: str
    run_id: str = field(default_factory=lambda: uuid4().hex)
    started_at: datetime = field(default_factory=lambda: datetime.now(timezone.utc))
    elapsed_s: float = 0.0
    rows_in: int | None = None
    rows_rejected: int | None = None
    rows_out: int | None = None
    # Dates written, as text: a stray one may lie beyond what a Python date can hold.
    first_date: str | None = None
    last_date: str | None = None
    dates: list[str] | None = None
    status: str = "running"

    @property
    def date(self) -> date:
        """Day of the start, by which the log is kept."""
        return self.started_at.date()

    @property
    def rows_per_s(self) -> float | None:
        if self.rows_out is None or self.elapsed_s <= 0:
            return None
        return self.rows_out / self.elapsed_s


@contextmanager
def logged_run(spark: SparkSession, cfg: PipelineConfig, job: str) -> Iterator[Run]:
    """Time a job and add its row to the run log, also when it fails."""
    run = Run(job)
    begin = time.monotonic()
    try:
        yield run
        run.status = "ok"
    except Exception as error:
        run.status = f"failed: {type(error).__name__}"
        run.elapsed_s = time.monotonic() - begin
        try:
            _add_to_log(spark, cfg, run)
        except Exception as another:
            error.add_note(f"and the run log could not be written: {another}")
        raise
    run.elapsed_s = time.monotonic() - begin
    _add_to_log(spark, cfg, run)


def _add_to_log(spark: SparkSession, cfg: PipelineConfig, run: Run) -> None:
    ensure_table(spark, cfg, "run_log")
    row = [F.lit(getattr(run, f.name)).cast(f.dataType).alias(f.name) for f in RUN_LOG.fields]
    append(spark.range(0, 1, 1, 1).select(*row), cfg, "run_log")


def write_observed(df: DataFrame, write: Callable[[DataFrame], None], helper: str | None = None, **more: Column) -> dict:
    """Write once and take rows, dates and `more` aggregates in passing, without a second job.

    The counters sit right before the write, in the last stage: there a lost executor's tasks
    are counted once, while a counter before a shuffle would count a rerun map task again. `dates` has
    as many entries as partitions are written. `helper` names a column for the aggregates alone.
    """
    observation = Observation()
    metrics = [
        F.count(F.lit(1)).alias("rows"),
        F.collect_set(F.col("date").cast("string")).alias("dates"),
        F.min("date").cast("string").alias("first_date"),
        F.max("date").cast("string").alias("last_date"),
        *[value.alias(name) for name, value in more.items()],
    ]
    observed = df.observe(observation, *metrics)
    write(observed.drop(helper) if helper else observed)
    return observation.get
