"""Message scans, batch and streaming, in the seven-column shape of a topic reader.

Three message formats:

* ``kafka``: the topic itself;
* ``parquet``: a topic archive that holds the seven columns;
* ``text``: a landing folder with one JSON message per line. Read by ranges, a line's offset is its byte position in its
  file; a plain scan or stream leaves it null.

What a scan reads can be given as ranges of offsets by part: a topic partition, or a file of the landing folder.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.config import PipelineConfig
from tiermill.schemas import MESSAGE
from tiermill.sources import landing
from tiermill.sources.ranges import Ranges, as_offsets, bounded, layers, merged, offsets_of, rows_of


def read_messages(
    spark: SparkSession,
    cfg: PipelineConfig,
    starting_offsets: str | None = None,
    ending_offsets: str | None = None,
) -> DataFrame:
    """Bounded scan of the topic; explicit offsets keep a rerun from reading all of it again."""
    if cfg.message_format == "kafka":
        return (
            spark.read.format("kafka")
            .options(**_subscription(cfg))
            .option("startingOffsets", starting_offsets or cfg.starting_offsets)
            .option("endingOffsets", ending_offsets or cfg.ending_offsets)
            .load()
        )
    starts, ends = (offsets_of(cfg.topic, x) for x in (starting_offsets, ending_offsets))
    if cfg.message_format == "parquet":
        return _archive(spark, cfg).where(_within(starts, ends))
    path = _path(cfg)
    if starts or ends:
        return read_ranges(spark, cfg, available(spark, cfg, starting_offsets, ending_offsets))
    return _lines_as_messages(spark.read.text(path), cfg)


def available(spark: SparkSession, cfg: PipelineConfig, starting_offsets: str | None = None, ending_offsets: str | None = None) -> Ranges | None:
    """What is there to read within the given offsets; None where only reading everything would tell (a topic of unknown end).

    An archive is asked for two columns, a landing folder for its listing. Over Kafka the caller gives the ends, and a
    start for each partition that doesn't begin at 0.
    """
    starts, ends = (offsets_of(cfg.topic, x) for x in (starting_offsets, ending_offsets))
    if cfg.message_format == "kafka":
        return merged((p, starts.get(p, 0), end) for p, end in ends.items()) if ends else None
    if cfg.message_format == "parquet":
        seen = _archive(spark, cfg).where(_within(starts, ends) & F.col("offset").isNotNull()).groupBy("partition").agg(F.min("offset").alias("first"), (F.max("offset") + 1).alias("following"))
        return merged((str(r["partition"]), r["first"], r["following"]) for r in seen.collect())
    there = landing.available(_path(cfg))
    if unknown := sorted((set(starts) | set(ends)) - set(there)):
        raise ValueError(f"the landing folder has no file {unknown[0]!r}: offsets are byte positions by file")
    return bounded(there, starts, ends)


def read_ranges(spark: SparkSession, cfg: PipelineConfig, ranges: Ranges) -> DataFrame:
    """The messages in the ranges, and no others."""
    if cfg.message_format == "kafka":
        # a reader of the topic takes one range per partition
        reads = [spark.read.format("kafka").options(**options).load() for options in kafka_reads(cfg, ranges)]
        return reduce(DataFrame.unionByName, reads) if reads else spark.createDataFrame([], MESSAGE)
    if cfg.message_format == "parquet":
        inside = F.lit(False)
        for part, own in ranges.items():
            offset = F.col("offset")
            inside = inside | ((F.col("partition") == int(part)) & reduce(Column.__or__, [(offset >= a) & (offset < b) for a, b in own]))
        return _archive(spark, cfg).where(inside)
    landing.register(spark)
    lines = spark.read.format(landing.NAME).option("path", _path(cfg)).option("topic", cfg.topic).option("ranges", json.dumps(rows_of(ranges))).load()
    return lines.select(*MESSAGE.fieldNames())


def kafka_reads(cfg: PipelineConfig, ranges: Ranges) -> list[dict[str, str]]:
    """Options of the reads that together cover the ranges: each takes its partitions alone, with a start and an end."""
    common = {k: v for k, v in _subscription(cfg).items() if k != "subscribe"}
    return [
        common
        | {
            "assign": json.dumps({cfg.topic: sorted(map(int, layer))}),
            "startingOffsets": as_offsets(cfg.topic, {p: a for p, (a, _) in layer.items()}),
            "endingOffsets": as_offsets(cfg.topic, {p: b for p, (_, b) in layer.items()}),
        }
        for layer in layers(ranges)
    ]


def _archive(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    return spark.read.schema(MESSAGE).parquet(_path(cfg))


def _within(starts: dict[str, int], ends: dict[str, int]) -> Column:
    """From the start on and before the end of each partition; both are pushed into the scan.

    Where ends are given, partitions without one are left out: they came later.
    """
    partition, offset = F.col("partition"), F.col("offset")
    inside = partition.isin(list(map(int, ends))) if ends else F.lit(True)
    for bounds, fits in ((starts, offset.__ge__), (ends, offset.__lt__)):
        for p, bound in bounds.items():
            inside = inside & ((partition != int(p)) | fits(bound))
    return inside


def read_message_stream(spark: SparkSession, cfg: PipelineConfig, max_per_trigger: int | None = None, positions: bool = False) -> DataFrame:
    """The same scan as a stream; `max_per_trigger` bounds a micro-batch (offsets or files).

    With `positions`, lines of a landing folder have offsets and a file that grows is read on; micro-batches are then
    unbounded. The two kinds of stream keep different offsets: a checkpoint belongs to the one that began it.
    """
    reader = spark.readStream
    if cfg.message_format == "kafka":
        reader = reader.format("kafka").options(**_subscription(cfg)).option("startingOffsets", cfg.starting_offsets)
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        return reader.load()
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    if cfg.message_format == "parquet":
        return reader.schema(MESSAGE).parquet(_path(cfg))
    if positions:
        landing.register(spark)
        return reader.format(landing.NAME).option("path", _path(cfg)).option("topic", cfg.topic).load().select(*MESSAGE.fieldNames())
    return _lines_as_messages(reader.text(_path(cfg)), cfg)


def _subscription(cfg: PipelineConfig) -> dict[str, str]:
    if not cfg.kafka_broker:
        raise ValueError("message_format 'kafka' needs kafka_broker")
    options = {"kafka.bootstrap.servers": cfg.kafka_broker, "subscribe": cfg.topic}
    if cfg.kafka_min_partitions:
        options["minPartitions"] = str(cfg.kafka_min_partitions)
    return options


def _path(cfg: PipelineConfig) -> str:
    if cfg.message_format not in ("parquet", "text"):
        raise ValueError(f"unknown message_format {cfg.message_format!r}")
    if not cfg.message_path:
        raise ValueError(f"message_format {cfg.message_format!r} needs message_path")
    return cfg.message_path


def _lines_as_messages(lines: DataFrame, cfg: PipelineConfig) -> DataFrame:
    return lines.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit(cfg.topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(None).cast("long").alias("offset"),
        F.col("_metadata.file_modification_time").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )
