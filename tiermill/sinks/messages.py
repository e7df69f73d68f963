"""Rows out as JSON messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tiermill.config import PipelineConfig
from tiermill.schemas import EVENT, MESSAGE


def encode_messages(events: DataFrame) -> DataFrame:
    """One UTF-8 JSON value per event, in the column a topic writer expects."""
    fields = [F.col(name) for name in EVENT.fieldNames()]
    return events.select(F.to_json(F.struct(*fields)).cast("binary").alias("value"))


def publish_messages(
    events: DataFrame,
    cfg: PipelineConfig,
    partition: Column | None = None,
    offset: Column | None = None,
    timestamp: Column | None = None,
) -> None:
    """Send events to the topic, or add them to the landing folder that stands in for it.

    Map-only: no shuffle whatever the size. A topic archive (``parquet``) also records the
    partition, offset and time given by the caller.
    """
    if cfg.message_format == "kafka":
        writer = encode_messages(events).write.format("kafka")
        writer.option("kafka.bootstrap.servers", cfg.kafka_broker).option("topic", cfg.topic).save()
        return
    if cfg.message_format == "text":
        encode_messages(events).select(F.col("value").cast("string")).write.mode("append").text(cfg.message_path)
        return
    if cfg.message_format != "parquet":
        raise ValueError(f"unknown message_format {cfg.message_format!r}")
    fields = [F.col(name) for name in EVENT.fieldNames()]
    columns = {
        "key": F.lit(None),
        "value": F.to_json(F.struct(*fields)),
        "topic": F.lit(cfg.topic),
        "partition": F.lit(0) if partition is None else partition,
        "offset": F.lit(None) if offset is None else offset,
        "timestamp": F.current_timestamp() if timestamp is None else timestamp,
        "timestampType": F.lit(0),
    }
    archive = events.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in MESSAGE.fields])
    archive.write.mode("append").parquet(cfg.message_path)
