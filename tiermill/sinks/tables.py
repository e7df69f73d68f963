"""Table DDL and writes, for file tables of the session catalog and for v2 tables alike."""

from __future__ import annotations

from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tiermill.config import PipelineConfig
from tiermill.schemas import INGEST_RUN

_OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def create_schema(spark: SparkSession, cfg: PipelineConfig, layer: str) -> None:
    place = ""
    if cfg.warehouse and not cfg.is_v2:
        place = f" LOCATION '{cfg.warehouse.rstrip('/')}/{cfg.database(layer)}'"
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {cfg.qualified_database(layer)}{place}")


def create_table(spark: SparkSession, cfg: PipelineConfig, layer: str, location: str | None = None) -> None:
    """CREATE TABLE IF NOT EXISTS with the layer's own columns and partitioning."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cfg.table_schema(layer).fields)
    statement = f"CREATE TABLE IF NOT EXISTS {cfg.table_name(layer)} ({columns}) USING {cfg.table_format}"
    if cfg.partition_by(layer):
        statement += f" PARTITIONED BY ({', '.join(cfg.partition_by(layer))})"
    if buckets := cfg.bucket_by(layer):
        number, keys = buckets
        statement += f" CLUSTERED BY ({', '.join(f'`{k}`' for k in keys)}) INTO {number} BUCKETS"
    if location:
        statement += f" LOCATION '{location}'"
    if cfg.table_format == "iceberg":
        statement += " TBLPROPERTIES ('format-version'='2')"
    spark.sql(statement)


def ensure_table(spark: SparkSession, cfg: PipelineConfig, layer: str) -> None:
    create_schema(spark, cfg, layer)
    create_table(spark, cfg, layer)


def register_table(spark: SparkSession, cfg: PipelineConfig, layer: str, location: str) -> None:
    """Bring data that already lies at a location into the catalog, partitions included."""
    create_schema(spark, cfg, layer)
    create_table(spark, cfg, layer, location)
    if cfg.partition_by(layer) and not cfg.is_v2:
        spark.sql(f"MSCK REPAIR TABLE {cfg.table_name(layer)}")


def append(df: DataFrame, cfg: PipelineConfig, layer: str) -> None:
    name = cfg.table_name(layer)
    if cfg.is_v2:
        df.writeTo(name).append()
    else:
        _in_table_order(df, name).write.mode("append").insertInto(name)


def overwrite_partitions(df: DataFrame, cfg: PipelineConfig, layer: str) -> None:
    """Replace the partitions that occur in `df`; every other partition stays."""
    name = cfg.table_name(layer)
    if cfg.is_v2:
        df.writeTo(name).overwritePartitions()
        return
    # as configure_session sets it, and never another mode: writes of one session may run beside each other
    if df.sparkSession.conf.get(_OVERWRITE_MODE).lower() != "dynamic":
        df.sparkSession.conf.set(_OVERWRITE_MODE, "dynamic")
    _in_table_order(df, name).write.mode("overwrite").insertInto(name)


def overwrite_all(df: DataFrame, cfg: PipelineConfig, layer: str) -> None:
    """Replace the whole table, so that partitions without rows any more go too.

    A file table's partitions are replaced one by one, and then those that got no rows are dropped: other writes of the
    session aren't touched by a change of its overwrite mode.
    """
    name, keys = cfg.table_name(layer), cfg.partition_by(layer)
    if cfg.is_v2:
        df.writeTo(name).overwrite(F.lit(True))
        return
    written = Observation()
    values = F.struct(*[F.col(k).cast("string").alias(k) for k in keys])
    # as many entries as partitions are written
    overwrite_partitions(df.observe(written, F.collect_set(values).alias("partitions")) if keys else df, cfg, layer)
    if keys:
        kept = {tuple(p[k] for k in keys) for p in written.get["partitions"]}
        drop_partitions(df.sparkSession, cfg, layer, [p for p in partitions(df.sparkSession, cfg, layer) if p not in kept])


def partitions(spark: SparkSession, cfg: PipelineConfig, layer: str) -> list[tuple[str | None, ...]]:
    """Values of the partition columns of all partitions of a file table, as text."""
    listed = spark.sql(f"SHOW PARTITIONS {cfg.table_name(layer)}").collect()
    value = lambda part: None if part.endswith(f"={_NULL_PARTITION}") else unquote(part.split("=", 1)[1])
    return [tuple(value(part) for part in r[0].split("/")) for r in listed]


def drop_partitions(spark: SparkSession, cfg: PipelineConfig, layer: str, values: Sequence[tuple[str | None, ...]]) -> None:
    """Take partitions out of a file table, their files included."""
    if values:
        literal = lambda v: "null" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
        specs = [", ".join(f"`{k}` = {literal(v)}" for k, v in zip(cfg.partition_by(layer), row, strict=True)) for row in values]
        spark.sql(f"ALTER TABLE {cfg.table_name(layer)} DROP IF EXISTS " + ", ".join(f"PARTITION ({s})" for s in specs))


def group_for_table(df: DataFrame, cfg: PipelineConfig, layer: str, *columns: str) -> DataFrame:
    """Rows of one table partition together; for a table with buckets, rows of one bucket in one task."""
    if buckets := cfg.bucket_by(layer):
        number, keys = buckets
        return df.repartition(number, *keys)
    return group_for_write(df, *columns)


def group_for_write(df: DataFrame, *columns: str) -> DataFrame:
    """Bring rows of one table partition together, so that a day ends in few, full files.

    A rebalance and not a plain repartition: adaptive execution cuts a day that holds a large
    part of all rows into several tasks and merges days that are small.
    """
    return df.hint("rebalance", *columns)


def sort_for_write(df: DataFrame, *columns: str) -> DataFrame:
    """Order rows within each task, partition columns first, so that the writer need not sort again.

    Neighbouring rows alike compress better, and row groups can be skipped by their statistics.
    """
    return df.sortWithinPartitions(*columns)


def show_tables(spark: SparkSession, cfg: PipelineConfig, layer: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {cfg.qualified_database(layer)}")


def _in_table_order(df: DataFrame, name: str) -> DataFrame:
    """insertInto goes by position, and a file table has its partition columns last.

    A column that the table lacks is an error: it would be lost without a word. Rows that come from no ingest run have
    none.
    """
    columns = df.sparkSession.table(name).columns
    if INGEST_RUN.name in columns and INGEST_RUN.name not in df.columns:
        df = df.withColumn(INGEST_RUN.name, F.lit(None).cast(INGEST_RUN.dataType))
    if more := sorted(set(df.columns) - set(columns)):
        raise ValueError(f"table {name} has no columns {more}")
    return df.select(*columns)
