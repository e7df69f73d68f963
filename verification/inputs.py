"""The given tables as measurements, messages, layer tables and metric samples.

Every view reads a whole table. Dirt is added, nothing is taken away: some values become null
or NaN, a tenth of the events is sent twice, and every document is sent as a message that is no
JSON event.
"""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tiermill.config import PipelineConfig, configure_session
from tiermill.operators.cleaning import clean
from tiermill.operators.hourly import gold_hourly
from tiermill.operators.parsing import add_date
from tiermill.plans.jobs import bronze_to_silver, ingest_bronze, silver_to_gold
from tiermill.schemas import EVENT, MESSAGE
from tiermill.sinks.messages import publish_messages
from tiermill.sources import metrics as M
from verification.workspace import fresh_folder

# The places measurements come from.
LOCATIONS = (
    "New York",
    "London",
    "Tokyo",
    "Berlin",
    "Sydney",
    "San Francisco",
    "Paris",
    "Singapore",
    "Toronto",
    "Sao Paulo",
)

AS_OF = "2024-01-30"
# Metric samples run on a clock 60 times as fast as the events, from this second on.
CLOCK_START_S = 1704067200
CLOCK_SPEED = 60


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def replayed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events, a tenth of them twice; `copy` tells the two apart. One scan, no union."""
    sent_again = F.col("event_id") % 10 == 3
    once, twice = F.array(F.lit(0)), F.array(F.lit(0), F.lit(1))
    return table(spark, sf_dir, "events").withColumn("copy", F.explode(F.when(sent_again, twice).otherwise(once)))


def as_measurements(events: DataFrame, *extra: Column | str, differing_copies: bool = False) -> DataFrame:
    """Event columns of the pipeline; with `differing_copies` a replay has another latency."""
    event_id = F.col("event_id")
    upload = (
        F.when(event_id % 17 == 0, F.lit(None).cast("float"))
        .when(event_id % 23 == 0, F.lit("NaN").cast("float"))
        .otherwise(F.get_json_object("props", "$.k").cast("float"))
    )
    latency = event_id % 99 + 1
    if differing_copies:
        latency = latency + F.col("copy")
    place = F.element_at(F.array(*[F.lit(x) for x in LOCATIONS]), (event_id % 10 + 1).cast("int"))
    columns = {
        "timestamp": F.unix_millis(F.col("ts").cast("timestamp")),
        "user_id": F.col("user_id"),
        "upload_speed": upload,
        "download_speed": F.col("value"),
        "latency": latency,
        "location": place,
    }
    return events.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in EVENT.fields], *extra)


def measurements(spark: SparkSession, sf_dir: str, differing_copies: bool = False) -> DataFrame:
    return as_measurements(replayed_events(spark, sf_dir), differing_copies=differing_copies)


def bronze_view(spark: SparkSession, sf_dir: str, differing_copies: bool = False) -> DataFrame:
    return add_date(measurements(spark, sf_dir, differing_copies))


def silver_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(bronze_view(spark, sf_dir))


def gold_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold_hourly(silver_view(spark, sf_dir))


# --- messages and tables ----------------------------------------------------------------------


def fresh_config(spark: SparkSession, **overrides) -> PipelineConfig:
    """A pipeline with folders and databases of its own."""
    root = fresh_folder(spark, "pipeline")
    tag = root.rsplit("-", 1)[1]
    settings = {
        "warehouse": f"{root}/warehouse",
        "message_format": "parquet",
        "message_path": f"{root}/messages",
        "bronze_db": f"bronze_{tag}",
        "silver_db": f"silver_{tag}",
        "gold_db": f"gold_{tag}",
        "ops_db": f"ops_{tag}",
    }
    return PipelineConfig(**{**settings, **overrides})


def send_messages(spark: SparkSession, sf_dir: str, cfg: PipelineConfig) -> None:
    """Fill the topic archive: replayed events on partitions 0-2, documents on partition 3."""
    sent = as_measurements(replayed_events(spark, sf_dir), "event_id", "copy", "ts")
    publish_messages(
        sent,
        cfg,
        partition=F.col("event_id") % 3,
        offset=F.col("event_id") * 2 + F.col("copy"),
        timestamp=F.col("ts"),
    )
    documents = {
        "value": F.col("text"),
        "topic": F.lit(cfg.topic),
        "partition": F.lit(3),
        "offset": F.col("doc_id"),
        "timestamp": F.lit(f"{AS_OF} 00:00:00"),
        "timestampType": F.lit(0),
    }
    table(spark, sf_dir, "documents").select(
        *[documents.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in MESSAGE.fields]
    ).write.mode("append").parquet(cfg.message_path)


_built: dict[tuple[str, str, str], PipelineConfig] = {}
_building = threading.Lock()


def built_pipeline(spark: SparkSession, sf_dir: str, upto: str = "gold") -> PipelineConfig:
    """Layer tables made by the jobs from the messages; built once per session and data set."""
    configure_session(spark)
    app = spark.sparkContext.applicationId
    steps = ("messages", "bronze", "silver", "gold")
    with _building:
        for i, step in enumerate(steps[: steps.index(upto) + 1]):
            if (app, sf_dir, step) in _built:
                continue
            if step == "messages":
                cfg = fresh_config(spark)
                send_messages(spark, sf_dir, cfg)
            else:
                cfg = _built[(app, sf_dir, steps[i - 1])]
                {"bronze": ingest_bronze, "silver": bronze_to_silver, "gold": silver_to_gold}[step](spark, cfg)
            _built[(app, sf_dir, step)] = cfg
        return _built[(app, sf_dir, upto)]


# --- metric samples ---------------------------------------------------------------------------


def _clock(millis: Column) -> Column:
    """Second on the metric clock of an event time in milliseconds."""
    gone = F.floor((millis - F.lit(CLOCK_START_S * 1000)) / F.lit(1000 * CLOCK_SPEED))
    return F.lit(CLOCK_START_S) + gone


def _samples(df: DataFrame, metric: str, second: str, value: str, **labels: Column) -> DataFrame:
    nothing = F.lit(None).cast("string")
    return df.select(
        F.lit(metric).alias("metric"),
        labels.get("series", F.lit("all")).cast("string").alias("series"),
        labels.get("job_id", nothing).alias("job_id"),
        labels.get("query_id", nothing).alias("query_id"),
        F.timestamp_seconds(second).alias("ts"),
        F.col(value).cast("double").alias("value"),
    )


def _messages_in(bronze: DataFrame) -> DataFrame:
    """Messages so far today, per location: a counter that starts anew with each day."""
    per_second = bronze.groupBy("location", "date", _clock(F.col("timestamp")).alias("second")).agg(
        F.count(F.lit(1)).alias("n")
    )
    today = Window.partitionBy("location", "date").orderBy("second")
    counted = per_second.withColumn("value", F.sum("n").over(today))
    return _samples(counted, M.MESSAGES_IN, "second", "value", series=F.col("location"))


def _row_counts(layer: DataFrame, metric: str, millis: Column) -> DataFrame:
    """Rows of a layer so far, every 30 seconds in which some came.

    Rows are first counted per step, so the running total sees one row per step of time,
    whatever the number of rows.
    """
    second = _clock(millis)
    per_step = layer.groupBy((second - second % 30).alias("second")).agg(F.count(F.lit(1)).alias("n"))
    in_order = Window.partitionBy(F.lit(metric)).orderBy("second")
    return _samples(per_step.withColumn("value", F.sum("n").over(in_order)), metric, "second", "value")


def _last_updates(bronze: DataFrame) -> DataFrame:
    second = _clock(F.col("timestamp"))
    per_step = bronze.groupBy((second - second % 30).alias("second")).agg(F.max(second).alias("value"))
    return _samples(per_step, M.LAST_UPDATE, "second", "value")


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of all metrics, derived from the layers; one metric's query prunes the others."""
    bronze = bronze_view(spark, sf_dir)
    silver = silver_view(spark, sf_dir)
    gold = gold_hourly(silver)
    event_millis = F.col("timestamp")
    hour_millis = (F.unix_date("date").cast("long") * 24 + F.col("hour")) * 3600 * 1000

    events = table(spark, sf_dir, "events")
    second = _clock(F.unix_millis(F.col("ts").cast("timestamp")))
    # Single precision, as the measures are: means of two-decimal doubles would lie on rounding ties.
    durations = events.groupBy("event_type", "user_id", (second - second % 60).alias("second")).agg(
        F.max(F.col("value").cast("float")).alias("value")
    )
    elapsed = bronze.groupBy("location", "user_id", (_clock(event_millis) - _clock(event_millis) % 60).alias("second")).agg(
        F.max("latency").alias("value")
    )
    parts = [
        _messages_in(bronze),
        _row_counts(bronze, M.BRONZE_ROWS, event_millis),
        _row_counts(silver, M.SILVER_ROWS, event_millis),
        _row_counts(gold, M.GOLD_ROWS, hour_millis),
        _last_updates(bronze),
        _samples(durations, M.JOB_DURATION, "second", "value", series=F.col("user_id"), job_id=F.col("event_type")),
        _samples(elapsed, M.QUERY_ELAPSED, "second", "value", series=F.col("user_id"), query_id=F.col("location")),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union
