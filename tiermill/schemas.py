"""Schemas of the records and tables, each stated once."""

from __future__ import annotations

from pyspark.sql import types as T

MEASURES = ("upload_speed", "download_speed", "latency")
DEDUP_KEYS = ("user_id", "timestamp")

EVENT = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),
        T.StructField("user_id", T.StringType()),
        T.StructField("upload_speed", T.FloatType()),
        T.StructField("download_speed", T.FloatType()),
        T.StructField("latency", T.FloatType()),
        T.StructField("location", T.StringType()),
    ]
)

BRONZE = T.StructType([*EVENT.fields, T.StructField("date", T.DateType())])
SILVER = BRONZE

# Where a bronze row came from; kept only when the configuration asks for it.
LINEAGE = T.StructType(
    [
        T.StructField("_topic", T.StringType()),
        T.StructField("_partition", T.IntegerType()),
        T.StructField("_offset", T.LongType()),
        T.StructField("_ingest_ts", T.TimestampType()),
    ]
)
# The run that wrote a bronze row: a partition column, so that a run's rows can be told and replaced.
INGEST_RUN = T.StructField("ingest_run", T.StringType())
# The partition column stays last, as positional inserts need it.
BRONZE_WITH_LINEAGE = T.StructType([*EVENT.fields, *LINEAGE.fields, BRONZE["date"]])

GOLD = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("location", T.StringType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("avg_upload_speed", T.DoubleType()),
        T.StructField("avg_download_speed", T.DoubleType()),
        T.StructField("avg_latency", T.DoubleType()),
    ]
)

# What a micro-batch, or several of them, add to an hour of gold: sums and counts that merge. `piece` tells which.
GOLD_PARTS = T.StructType(
    [
        T.StructField("location", T.StringType()),
        T.StructField("hour", T.IntegerType()),
        *[T.StructField(f"{kind}_{m}", T.DoubleType() if kind == "sum" else T.LongType()) for m in MEASURES for kind in ("sum", "count")],
        T.StructField("date", T.DateType()),
        T.StructField("piece", T.StringType()),
    ]
)

# One message as a topic reader delivers it.
MESSAGE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# Labels are flat columns: a MAP can be neither a grouping nor a window key.
METRICS = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("series", T.StringType()),
        T.StructField("job_id", T.StringType()),
        T.StructField("query_id", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("value", T.DoubleType()),
    ]
)

# As kept: by day, so that a look at the last hour lists one day's files.
METRICS_BY_DATE = T.StructType([*METRICS.fields, T.StructField("date", T.DateType())])

# The newest sample of each series, in versions: each fold writes the next one.
METRICS_CURRENT = T.StructType([*METRICS.fields, T.StructField("version", T.LongType())])

# What a day of a layer held when a job last took it: a count and a sum over hashes of its rows, in any order.
DAY_MARKS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("job", T.StringType()),
        T.StructField("day", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("hash", T.StringType()),
        T.StructField("at", T.TimestampType()),
    ]
)

RUN_LOG = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("job", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("elapsed_s", T.DoubleType()),
        T.StructField("rows_in", T.LongType()),
        T.StructField("rows_rejected", T.LongType()),
        T.StructField("rows_out", T.LongType()),
        T.StructField("rows_per_s", T.DoubleType()),
        T.StructField("first_date", T.DateType()),
        T.StructField("last_date", T.DateType()),
        T.StructField("status", T.StringType()),
        T.StructField("date", T.DateType()),
    ]
)

# Micro-batches that are in their table.
STREAM_BATCHES = T.StructType(
    [
        T.StructField("checkpoint", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("written_at", T.TimestampType()),
    ]
)

# What each ingest run reads: an entry "open" per range before its rows are written, one "done" without a range after.
INGEST_RANGES = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("part", T.StringType()),
        T.StructField("first_offset", T.LongType()),
        T.StructField("next_offset", T.LongType()),
        T.StructField("at", T.TimestampType()),
    ]
)
