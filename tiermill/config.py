"""Pipeline parameters, table names and session settings."""

from __future__ import annotations

import os
from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, fields

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from tiermill import schemas

LAYERS = ("bronze", "silver", "gold")

# Environment variables that deployments of this pipeline already set.
ENVIRONMENT = {
    "catalog": "ICEBERG_CATALOG",
    "kafka_broker": "KAFKA_BROKER",
    "topic": "KAFKA_TOPIC",
    "bronze_db": "BRONZE_DB",
    "bronze_table": "BRONZE_TABLE",
    "silver_db": "SILVER_DB",
    "silver_table": "SILVER_TABLE",
    "gold_db": "GOLD_DB",
    "gold_table": "GOLD_TABLE",
    "warehouse": "WAREHOUSE",
    "table_format": "TABLE_FORMAT",
    "message_format": "MESSAGE_FORMAT",
    "message_path": "MESSAGE_PATH",
    "checkpoint_root": "STREAM_CHECKPOINTS",
    "store_endpoint": "MINIO_ENDPOINT",
    "store_bucket": "MINIO_BUCKET",
    "catalog_host": "POSTGRES_HOST",
    "catalog_port": "POSTGRES_PORT",
    "catalog_name": "POSTGRES_DB",
}
# Names that the ingest job alone goes by; the layer's own names win over them.
INGEST_ENVIRONMENT = {"bronze_db": "ICEBERG_DB", "bronze_table": "ICEBERG_TABLE"}


@dataclass(frozen=True)
class PipelineConfig:
    """Everything a job needs to know; holds no credentials."""

    catalog: str = "spark_catalog"
    table_format: str = "parquet"
    warehouse: str | None = None

    bronze_db: str = "bronze"
    bronze_table: str = "measurements_raw"
    silver_db: str = "silver"
    silver_table: str = "measurements_clean"
    gold_db: str = "gold"
    gold_table: str = "measurements_hourly"
    ops_db: str = "ops"

    message_format: str = "kafka"
    message_path: str | None = None
    kafka_broker: str | None = None
    topic: str = "measurements"
    starting_offsets: str = "earliest"
    ending_offsets: str = "latest"
    # Tasks that share a Kafka scan; unset, there are only as many as the topic has partitions.
    kafka_min_partitions: int | None = None
    checkpoint_root: str | None = None

    # Where an Iceberg catalog over JDBC and its files are; users and passwords are the session's business.
    store_endpoint: str | None = None
    store_bucket: str | None = None
    catalog_host: str | None = None
    catalog_port: str = "5432"
    catalog_name: str | None = None

    # Unit of the event's `timestamp`: "ms" is what producers send, "s" reads the number as seconds.
    ts_unit: str = "ms"
    # ("date",) keeps a day's gold in few files; ("date", "location") gives one folder per place.
    gold_partition_by: tuple[str, ...] = ("date",)
    keep_lineage: bool = False
    # Buckets that silver's rows are dealt to by their key, so that a stream's look for copies leaves silver where it lies.
    silver_buckets: int | None = None

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ, **overrides) -> PipelineConfig:
        known = {f.name for f in fields(cls)}
        from_env = {k: env[v] for names in (INGEST_ENVIRONMENT, ENVIRONMENT) for k, v in names.items() if k in known and env.get(v)}
        return cls(**{**from_env, **overrides})

    def session_settings(self) -> dict[str, str]:
        """Settings that a session needs from its start on: those of the catalog, where the tables are in one."""
        if self.table_format != "iceberg" or not (self.catalog_host and self.catalog_name):
            return {}
        warehouse = self.warehouse or f"s3a://{self.store_bucket}/warehouse"
        uri = f"jdbc:postgresql://{self.catalog_host}:{self.catalog_port}/{self.catalog_name}"
        return lake_settings(self.catalog, warehouse, uri, self.store_endpoint)

    @property
    def is_v2(self) -> bool:
        """True where tables take the DataFrameWriterV2 path."""
        return self.table_format not in ("parquet", "orc")

    def database(self, layer: str) -> str:
        return {
            "bronze": self.bronze_db,
            "silver": self.silver_db,
            "gold": self.gold_db,
            "metrics": self.ops_db,
            "run_log": self.ops_db,
            "ingest_ranges": self.ops_db,
            "gold_parts": self.ops_db,
            "metrics_current": self.ops_db,
            "day_marks": self.ops_db,
            "stream_batches": self.ops_db,
        }[layer]

    def table(self, layer: str) -> str:
        return {
            "bronze": self.bronze_table,
            "silver": self.silver_table,
            "gold": self.gold_table,
            "metrics": "metrics",
            "run_log": "run_log",
            "ingest_ranges": "ingest_ranges",
            "gold_parts": "gold_parts",
            "metrics_current": "metrics_current",
            "day_marks": "day_marks",
            "stream_batches": "stream_batches",
        }[layer]

    def qualified_database(self, layer: str) -> str:
        db = self.database(layer)
        return db if self.catalog == "spark_catalog" else f"{self.catalog}.{db}"

    def table_name(self, layer: str) -> str:
        return f"{self.qualified_database(layer)}.{self.table(layer)}"

    def location(self, layer: str) -> str | None:
        """Folder of a layer's table, or None where the catalog decides."""
        if self.warehouse is None:
            return None
        return f"{self.warehouse.rstrip('/')}/{self.database(layer)}/{self.table(layer)}"

    def schema(self, layer: str) -> StructType:
        return {
            "bronze": schemas.BRONZE_WITH_LINEAGE if self.keep_lineage else schemas.BRONZE,
            "silver": schemas.SILVER,
            "gold": schemas.GOLD,
            "metrics": schemas.METRICS_BY_DATE,
            "run_log": schemas.RUN_LOG,
            "ingest_ranges": schemas.INGEST_RANGES,
            "gold_parts": schemas.GOLD_PARTS,
            "metrics_current": schemas.METRICS_CURRENT,
            "day_marks": schemas.DAY_MARKS,
            "stream_batches": schemas.STREAM_BATCHES,
        }[layer]

    def table_schema(self, layer: str) -> StructType:
        """The layer's columns as its table has them: bronze also tells the run that wrote a row."""
        columns = self.schema(layer)
        return StructType([*columns.fields, schemas.INGEST_RUN]) if layer == "bronze" else columns

    def partition_by(self, layer: str) -> tuple[str, ...]:
        by_date = ("date",)
        return {"bronze": (*by_date, schemas.INGEST_RUN.name), "silver": by_date, "gold": self.gold_partition_by, "metrics": by_date, "run_log": by_date, "gold_parts": (*by_date, "piece"), "metrics_current": ("version",)}.get(layer, ())

    def bucket_by(self, layer: str) -> tuple[int, tuple[str, ...]] | None:
        """Number and keys of a file table's buckets."""
        if layer != "silver" or not self.silver_buckets or self.is_v2:
            return None
        return self.silver_buckets, schemas.DEDUP_KEYS

    def checkpoint(self, query: str) -> str:
        """Offset folder of one streaming query; must lie on storage all executors share."""
        root = self.checkpoint_root or (f"{self.warehouse.rstrip('/')}/_checkpoints" if self.warehouse else None)
        if root is None:
            raise ValueError("streaming needs checkpoint_root or warehouse in the configuration")
        return f"{root.rstrip('/')}/{query}"


# Dates and hours are taken in UTC whatever the host; only the partitions in hand are replaced.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
}


def configure_session(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


#: Bytes of input for each shuffle partition, and the most partitions that a driver and its shuffle service bear well.
PARTITION_BYTES, MOST_PARTITIONS = 128 << 20, 20_000


def shuffle_sizing(input_bytes: int) -> dict[str, str]:
    """Shuffle partitions for an input of the given size, and the size that adaptive execution aims at.

    Partitions of PARTITION_BYTES, larger ones where that would give more than MOST_PARTITIONS: 8 for 1 GB, 16,384 for
    2 TB, 20,000 of about 5 GB each for 100 TB (most of it gone before the shuffle, as aggregates are combined first).
    """
    size = max(PARTITION_BYTES, -(-input_bytes // MOST_PARTITIONS))
    return {
        "spark.sql.shuffle.partitions": str(max(1, -(-input_bytes // size))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
    }


def cluster_settings(input_bytes: int) -> dict[str, str]:
    """`shuffle_sizing` with the settings that go with it; adaptive execution merges and splits partitions."""
    return {
        **shuffle_sizing(input_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    }


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[None]:
    """Within it, shuffles have the partitions that the input asks for, and never fewer than the session's own."""
    before = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = int(shuffle_sizing(input_bytes)["spark.sql.shuffle.partitions"])
    spark.conf.set("spark.sql.shuffle.partitions", str(max(before, wanted)))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", str(before))


def lake_settings(catalog: str, warehouse: str, jdbc_uri: str, endpoint: str | None = None) -> dict[str, str]:
    """Settings of an Iceberg catalog kept over JDBC with its files in an S3-like store.

    Users, passwords and keys are not taken here: hand them to the session by a credentials
    provider or a protected properties file.
    """
    root = f"spark.sql.catalog.{catalog}"
    settings = {
        root: "org.apache.iceberg.spark.SparkCatalog",
        f"{root}.catalog-impl": "org.apache.iceberg.jdbc.JdbcCatalog",
        f"{root}.uri": jdbc_uri,
        f"{root}.warehouse": warehouse,
    }
    if endpoint:
        settings["spark.hadoop.fs.s3a.endpoint"] = endpoint
        settings["spark.hadoop.fs.s3a.path.style.access"] = "true"
    return settings
