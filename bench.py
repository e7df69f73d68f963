"""Time the headline work and print one JSON line.

Stages are timed in order (messages, bronze, silver, gold), then every question on the tables
they leave, then the operators that start from the events. Each query is written in full to a
sink that keeps nothing. What begins with "many" runs over some ten million messages and is not in the total.
"""

from __future__ import annotations

import dataclasses
import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tiermill import configure_session  # noqa: E402
from tiermill.operators import analysis, cleaning, hourly, quality, series  # noqa: E402
from tiermill.plans import bronze_to_silver, ingest_bronze, silver_to_gold  # noqa: E402
from tiermill.plans.monitoring import layer_row_counts  # noqa: E402
from tiermill.sinks.messages import publish_messages  # noqa: E402
from tiermill.sources import metrics as M  # noqa: E402
from tiermill.sources import read_layer, read_layer_stream, read_message_stream  # noqa: E402
from tiermill.streaming import stream_bronze, stream_gold_hourly, stream_silver  # noqa: E402
from verification import inputs  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPEATS = int(os.environ.get("BENCH_REPEATS", "3"))


def seconds(work) -> float:
    begin = time.perf_counter()
    work()
    return time.perf_counter() - begin


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def streamed(spark, cfg) -> None:
    """The same messages through the three streams, into tables of their own."""
    own = dataclasses.replace(inputs.fresh_config(spark), message_path=cfg.message_path)
    stream_bronze(read_message_stream(spark, own), own).awaitTermination()
    stream_silver(read_layer_stream(spark, own, "bronze"), own).awaitTermination()
    stream_gold_hourly(read_layer_stream(spark, own, "silver"), own).awaitTermination()


#: Copies of the events under other user names in the large runs: some ten million messages at sf0.1.
MANY = int(os.environ.get("BENCH_MANY", "90"))


def many_messages(spark, cfg) -> None:
    """The replayed events MANY times over, in the archive of `cfg`."""
    sent = inputs.replayed_events(spark, SF_DIR).withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(MANY))))
    sent = sent.withColumn("user_id", F.concat_ws("-", "user_id", "again"))
    measured = inputs.as_measurements(sent, "event_id", "copy", "ts", "again")
    offset = (F.col("event_id") * 2 + F.col("copy")) * (MANY + 1) + F.col("again")
    publish_messages(measured, cfg, partition=F.col("event_id") % 3, offset=offset, timestamp=F.col("ts"))


def large(spark, timed: dict) -> int:
    """The three stages over many messages, and KPIs over them: as they come, and with a third of the rows in one group, all of other values."""
    cfg = inputs.fresh_config(spark)
    many_messages(spark, cfg)
    for name, job in (("ingest_bronze", ingest_bronze), ("bronze_to_silver", bronze_to_silver), ("silver_to_gold", silver_to_gold)):
        began = time.perf_counter()
        run = job(spark, cfg)
        timed[f"many_{name}"] = time.perf_counter() - began
        if name == "ingest_bronze":
            messages = run.rows_in
    silver = read_layer(spark, cfg, "silver")
    timed["many_kpis"] = seconds(lambda: drain(hourly.gold_kpis(silver)))
    hot = F.xxhash64("user_id", "timestamp") % 3 == 0
    one = silver.withColumns(
        {
            "timestamp": F.when(hot, F.lit(1704067200000)).otherwise(F.col("timestamp")),
            "date": F.when(hot, F.lit("2024-01-01").cast("date")).otherwise(F.col("date")),
            "location": F.when(hot, F.lit("London")).otherwise(F.col("location")),
            "latency": F.when(hot, F.abs(F.xxhash64("user_id", "timestamp", F.lit(1)) % 100_000_007).cast("float")).otherwise(F.col("latency")),
        }
    )
    timed["many_kpis_skewed"] = seconds(lambda: drain(hourly.gold_kpis(one)))
    return messages


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure_session(spark)

    # One untimed round on the smallest tables, so that the first stage does not pay for the JVM's start.
    warm = inputs.built_pipeline(spark, "/root/testdata/sf0.001")
    drain(read_layer(spark, warm, "gold"))

    timed: dict[str, float] = {}
    cfg = inputs.fresh_config(spark)
    timed["publish_messages"] = seconds(lambda: inputs.send_messages(spark, SF_DIR, cfg))
    runs = {}
    for name, job in (
        ("ingest_bronze", ingest_bronze),
        ("bronze_to_silver", bronze_to_silver),
        ("silver_to_gold", silver_to_gold),
    ):
        timed[name] = seconds(lambda name=name, job=job: runs.update({name: job(spark, cfg)}))

    timed["one_day_to_gold"] = seconds(lambda: (bronze_to_silver(spark, cfg, inputs.AS_OF, inputs.AS_OF), silver_to_gold(spark, cfg, inputs.AS_OF, inputs.AS_OF)))
    timed["stream_to_gold"] = seconds(lambda: streamed(spark, cfg))

    def layer(name):
        return read_layer(spark, cfg, name)

    samples = inputs.metric_samples(spark, SF_DIR)
    questions = {
        "top_locations": lambda: analysis.top_locations(layer("gold"), inputs.AS_OF),
        "hourly_trend": lambda: analysis.hourly_trend(layer("gold"), "New York"),
        "latency_by_location": lambda: analysis.latency_by_location(layer("gold")),
        "gold_today": lambda: analysis.gold_today(layer("gold"), inputs.AS_OF),
        "date_distribution": lambda: analysis.date_distribution(layer("bronze")),
        "dedup": lambda: cleaning.clean(layer("bronze")),
        "gold_hourly": lambda: hourly.gold_hourly(layer("silver")),
        "gold_kpis": lambda: hourly.gold_kpis(layer("silver")),
        "quality_report": lambda: quality.quality_report(layer("bronze")),
        "layer_row_counts": lambda: layer_row_counts(spark, cfg),
        "counter_rate_1m": lambda: series.counter_rate(samples, M.MESSAGES_IN, 60),
        "quality_pct": lambda: series.quality_pct(samples),
    }
    for name, question in questions.items():
        timed[name] = min(seconds(lambda question=question: drain(question())) for _ in range(REPEATS))

    small = sum(timed.values())
    many = large(spark, timed) if MANY else 0

    ingest = runs["ingest_bronze"]
    pipeline = sum(timed[k] for k in ("ingest_bronze", "bronze_to_silver", "silver_to_gold"))
    print(
        json.dumps(
            {
                "metric": "headline queries, total time",
                "value": round(small, 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in timed.items()},
                "sf": SF_DIR.rsplit("sf", 1)[-1].strip("/"),
                "messages": ingest.rows_in,
                "many_messages": many,
                "messages_per_sec": round(ingest.rows_in / pipeline),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
