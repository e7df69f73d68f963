"""Storage used by a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.config import PipelineConfig


def storage_usage(spark: SparkSession, cfg: PipelineConfig, layer: str) -> DataFrame:
    """Files and bytes per partition.

    Lists files without opening any: the file source below yields paths and lengths, and its
    content column is not selected. An Iceberg table keeps the same figures as metadata.
    """
    name = cfg.table_name(layer)
    if cfg.table_format == "iceberg":
        files = spark.table(f"{name}.files").select("partition.*", F.col("file_size_in_bytes").alias("bytes"))
    else:
        # A description of one row per table property, whatever the size of the table.
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}")
        location = described.where(F.col("col_name") == "Location").head()["data_type"]
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", f"*.{cfg.table_format}")
            .load(location)
            .withColumnRenamed("length", "bytes")
        )
    keys = [c for c in cfg.partition_by(layer) if c in files.columns]
    return files.groupBy(*keys).agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
