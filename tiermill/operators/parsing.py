"""Message bytes to typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.functions.event_time import event_date, event_hour
from tiermill.schemas import EVENT


def parse_messages(messages: DataFrame, lineage: bool = False) -> DataFrame:
    """JSON values as event columns.

    Nothing is rejected here: a bad field is null, and a value that is no JSON object gives a
    row of nulls. `lineage` adds the topic, partition, offset and time each row came from.
    """
    columns = [F.from_json(F.col("value").cast("string"), EVENT).alias("data")]
    names = ["data.*"]
    if lineage:
        columns += [
            F.col("topic").alias("_topic"),
            F.col("partition").alias("_partition"),
            F.col("offset").alias("_offset"),
            F.col("timestamp").alias("_ingest_ts"),
        ]
        names += ["_topic", "_partition", "_offset", "_ingest_ts"]
    return messages.select(*columns).select(*names)


def add_date(df: DataFrame, ts_unit: str = "ms") -> DataFrame:
    return df.withColumn("date", event_date("timestamp", ts_unit))


def add_date_if_missing(df: DataFrame, ts_unit: str = "ms") -> DataFrame:
    return df if "date" in df.columns else add_date(df, ts_unit)


def add_hour(df: DataFrame, ts_unit: str = "ms") -> DataFrame:
    return df.withColumn("hour", event_hour("timestamp", ts_unit))
