"""Scans of the layer tables."""

from __future__ import annotations

import io
import re
from collections.abc import Iterable
from contextlib import redirect_stdout

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.config import PipelineConfig
from tiermill.functions.predicates import between_dates, on_dates
from tiermill.schemas import INGEST_RUN


def read_layer(spark: SparkSession, cfg: PipelineConfig, layer: str, date_from=None, date_to=None, dates: Iterable | None = None) -> DataFrame:
    """A layer's rows; a date range, or a list of days, reads only those partitions.

    A session remembers which files a file table had; a stream or another application may have
    added some since, so the memory is dropped first. Only the partitions read are listed anew.
    """
    if not cfg.is_v2:
        spark.catalog.refreshTable(cfg.table_name(layer))
    df = spark.table(cfg.table_name(layer)).drop(INGEST_RUN.name)
    if dates is not None:
        df = df.where(on_dates(dates))
    if date_from is None and date_to is None:
        return df
    return df.where(between_dates(date_from, date_to))


def bytes_to_read(df: DataFrame) -> int:
    """Spark's estimate of a scan after partition pruning: for file tables, the size of the files listed.

    One line of the plan's text; 0 where Spark tells none. A condition on the partition column makes Spark list
    the files, where it would else have no figure for a table that was never analysed.
    """
    plan = io.StringIO()
    with redirect_stdout(plan):
        df.where(F.col("date").isNotNull()).explain("cost")
    found = re.search(r"Statistics\(sizeInBytes=([\d.]+) ([KMGTPE]?i?B)", plan.getvalue())
    return int(float(found[1]) * _UNITS.get(found[2], 0)) if found else 0


_UNITS = {unit: 1 << (10 * i) for i, unit in enumerate(("B", "KiB", "MiB", "GiB", "TiB", "PiB"))}


def read_layer_stream(spark: SparkSession, cfg: PipelineConfig, layer: str, max_per_trigger: int | None = None) -> DataFrame:
    """Rows appended to a layer, as a stream."""
    reader = spark.readStream
    if max_per_trigger and not cfg.is_v2:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.table(cfg.table_name(layer)).drop(INGEST_RUN.name)
