"""Layer gauges into the metrics table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiermill.config import LAYERS, PipelineConfig
from tiermill.operators.counts import row_counts
from tiermill.schemas import METRICS
from tiermill.sinks.tables import append, ensure_table, group_for_write, overwrite_partitions
from tiermill.sources.layers import read_layer
from tiermill.sources.messages import read_messages
from tiermill.sources.metrics import (
    BRONZE_ROWS,
    GOLD_ROWS,
    JOB_DURATION,
    LAST_UPDATE,
    MESSAGE_COUNT,
    MESSAGES_IN,
    SILVER_ROWS,
    current_version,
    read_current,
)

GAUGES = {"bronze": BRONZE_ROWS, "silver": SILVER_ROWS, "gold": GOLD_ROWS, "messages": MESSAGE_COUNT}


def layer_row_counts(spark: SparkSession, cfg: PipelineConfig, with_messages: bool = False) -> DataFrame:
    """Rows per layer, and on request messages in the topic.

    A missing table raises; it is never a count of zero.
    """
    tables = {layer: read_layer(spark, cfg, layer) for layer in LAYERS}
    if with_messages:
        tables["messages"] = read_messages(spark, cfg)
    return row_counts(tables)


def gauge_samples(counts: DataFrame, as_of: datetime | str | None = None, series: str = "all") -> DataFrame:
    """Row counts as metric samples of one time, plus the gauge of the last update."""
    ts = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    name = F.lit(None).cast("string")
    for layer, gauge in GAUGES.items():
        name = F.when(F.col("layer") == layer, F.lit(gauge)).otherwise(name)

    def sample(metric, value):
        columns = {
            "metric": metric,
            "series": F.lit(series),
            "job_id": F.lit(None),
            "query_id": F.lit(None),
            "ts": ts,
            "value": value,
        }
        return [columns[f.name].cast(f.dataType).alias(f.name) for f in METRICS.fields]

    updated = counts.sparkSession.range(1).select(*sample(F.lit(LAST_UPDATE), F.unix_timestamp(ts)))
    return counts.select(*sample(name, F.col("row_count"))).unionByName(updated)


def run_samples(run_log: DataFrame) -> DataFrame:
    """Runs as metric samples at their end: seconds of each run by job, and messages ingested so far.

    The second is a counter over the runs of one job, a row per run.
    """
    ended = F.timestamp_micros(F.unix_micros("started_at") + (F.col("elapsed_s") * 1_000_000).cast("long"))
    in_order = Window.partitionBy("job").orderBy("started_at", "run_id")
    runs = run_log.where("status = 'ok'").withColumn("so_far", F.sum("rows_in").over(in_order)).withColumn("ended", ended)

    def sample(metric: str, value: str):
        columns = {"metric": F.lit(metric), "series": F.col("job"), "job_id": F.col("job"), "ts": F.col("ended"), "value": F.col(value)}
        return F.struct(*[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in METRICS.fields])

    duration, messages = sample(JOB_DURATION, "elapsed_s"), sample(MESSAGES_IN, "so_far")
    both = F.when(F.col("job") == "ingest_bronze", F.array(duration, messages)).otherwise(F.array(duration))
    return runs.select(F.explode(both).alias("s")).select("s.*")


def table_metrics(
    spark: SparkSession, cfg: PipelineConfig, as_of: datetime | str | None = None, with_messages: bool = False
) -> None:
    """Measure the layers and append the samples to the metrics table.

    Counts of file tables come from file footers. Counting the messages reads the whole topic: it is off unless asked
    for, and `run_samples` tells how many were ingested.
    """
    add_samples(spark, cfg, gauge_samples(layer_row_counts(spark, cfg, with_messages), as_of).coalesce(1))


def add_samples(spark: SparkSession, cfg: PipelineConfig, samples: DataFrame) -> None:
    """Samples to the metrics table, and the newest of each series into that of current values."""
    ensure_table(spark, cfg, "metrics")
    append(samples.withColumn("date", F.to_date("ts")), cfg, "metrics")
    fold_current(spark, cfg, samples)


def fold_current(spark: SparkSession, cfg: PipelineConfig, samples: DataFrame) -> None:
    """The newest sample of each series among those known and those given, as the next version of the current values.

    One version is as large as there are series, whatever came before. Samples folded in again, or late, change nothing:
    the newest one stays, and of two of one time the larger. A fold that breaks off leaves its version to be replaced by
    the next; the last one before stays for readers that began with it.
    """
    ensure_table(spark, cfg, "metrics_current")
    version = current_version(spark, cfg)
    rest = [f for f in METRICS.fieldNames() if f not in ("metric", "series")]
    order = ["ts", "value", *[f for f in rest if f not in ("ts", "value")]]
    newest = F.max(F.struct(*order)).alias("newest")
    new = samples.groupBy("metric", "series").agg(newest)
    if version is not None:
        known = read_current(spark, cfg).select("metric", "series", F.struct(*order).alias("newest"))
        new = new.unionByName(known).groupBy("metric", "series").agg(F.max("newest").alias("newest"))
    rows = new.select("metric", "series", *[F.col(f"newest.{f}").alias(f) for f in rest]).withColumn("version", F.lit((version or 0) + 1).cast("long"))
    overwrite_partitions(group_for_write(rows, "version"), cfg, "metrics_current")
    if version and not cfg.is_v2:
        spark.sql(f"ALTER TABLE {cfg.table_name('metrics_current')} DROP IF EXISTS PARTITION (version = {version - 1})")
