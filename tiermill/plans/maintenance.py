"""Table registration, history and the maintenance report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermill.config import LAYERS, PipelineConfig
from tiermill.sinks.tables import create_schema, register_table
from tiermill.sources.layers import read_layer

# The job that writes each layer; names its rows in the run log.
WRITERS = {"bronze": "ingest_bronze", "silver": "bronze_to_silver", "gold": "silver_to_gold"}

_REGISTRATION = T.StructType(
    [
        T.StructField("layer", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)
_MAINTENANCE = T.StructType(
    [
        T.StructField("layer", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("commits", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)


def register_tables(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Create the schemas and register each layer's files; one status row per table.

    A table that cannot be registered is reported and does not stop the others.
    """
    rows = []
    for layer in LAYERS:
        name = cfg.table_name(layer)
        try:
            create_schema(spark, cfg, layer)
            location = cfg.location(layer)
            if location is None:
                raise ValueError("registering tables needs a warehouse in the configuration")
            register_table(spark, cfg, layer, location)
            rows.append((layer, name, "registered", None))
        except Exception as error:
            rows.append((layer, name, "failed", _first_line(error)))
    return spark.createDataFrame(rows, _REGISTRATION)


def table_history(spark: SparkSession, cfg: PipelineConfig, layer: str) -> DataFrame:
    """Commits of a layer's table: the format's own history, or the successful runs in the log."""
    if cfg.table_format == "iceberg":
        return spark.table(f"{cfg.table_name(layer)}.history")
    runs = spark.table(cfg.table_name("run_log"))
    return (
        runs.where((F.col("job") == WRITERS[layer]) & (F.col("status") == "ok"))
        .select(F.lit(layer).alias("layer"), "run_id", F.col("started_at").alias("made_current_at"), "rows_in", "rows_out")
        .orderBy("made_current_at")
    )


def maintenance_report(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Row count and number of commits per layer, with errors kept to the table they concern.

    One distributed count per layer, so that an unreadable table cannot fail the others.
    """
    rows = []
    for layer in LAYERS:
        name = cfg.table_name(layer)
        try:
            count = read_layer(spark, cfg, layer).count()
            commits = table_history(spark, cfg, layer).count()
            rows.append((layer, name, count, commits, "ok", None))
        except Exception as error:
            rows.append((layer, name, None, None, "error", _first_line(error)))
    return spark.createDataFrame(rows, _MAINTENANCE)


def _first_line(error: Exception) -> str:
    return str(error).strip().splitlines()[0] if str(error).strip() else type(error).__name__
