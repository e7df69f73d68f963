"""Writes side by side, whole-table replacement, and silver in buckets."""

import dataclasses
from concurrent.futures import ThreadPoolExecutor
from datetime import date

import pytest
from pyspark.sql import functions as F

from tiermill.plans import bronze_to_silver, ingest_bronze, run_medallion, silver_to_gold
from tiermill.schemas import GOLD
from tiermill.sinks import tables
from tiermill.sources import read_layer, read_layer_stream, read_message_stream
from tiermill.streaming import pipelines, stream_bronze, stream_silver

DAY_MS = 86_400_000
FIRST = 1721347200000  # 2024-07-19 00:00 UTC


@pytest.fixture
def days(land, event):
    land(*[event(ms=FIRST + d * DAY_MS + u, user=f"u{u}{p[0]}", down=u + d, place=p) for d in range(3) for u in range(4) for p in ("London", "São 'Paulo'/x=1")])


def rows(spark, cfg, layer):
    return sorted(map(str, read_layer(spark, cfg, layer).collect()))


def gold_rows(spark, cfg, days, hour):
    return spark.createDataFrame([(date(2024, 7, d), "x", hour, 1.0, 2.0, 3.0) for d in days], GOLD)


def test_writes_of_one_session_side_by_side(spark, cfg, land, event, days):
    """Full replacements of one table beside replacements of single days in another: none takes the other's mode."""
    run_medallion(spark, cfg)
    other = dataclasses.replace(cfg, gold_db=f"{cfg.gold_db}_other")
    tables.ensure_table(spark, other, "gold")
    tables.overwrite_partitions(gold_rows(spark, other, range(1, 10), 0), other, "gold")

    def refresh(_):
        silver_to_gold(spark, cfg, full_refresh=True)

    def day(d):
        tables.overwrite_partitions(gold_rows(spark, other, [d], 5), other, "gold")

    with ThreadPoolExecutor(4) as pool:
        jobs = [pool.submit(refresh, 0), *(pool.submit(day, d) for d in range(1, 6)), pool.submit(refresh, 1)][:-1]
        for job in jobs:
            job.result()
    assert {(r["date"].day, r["hour"]) for r in read_layer(spark, other, "gold").collect()} == {(d, 5 if d < 6 else 0) for d in range(1, 10)}
    assert read_layer(spark, cfg, "gold").count() == 6
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "dynamic"


@pytest.mark.parametrize("by", [("date",), ("date", "location")])
def test_replacement_drops_what_got_no_rows(spark, cfg, land, event, days, by):
    own = dataclasses.replace(cfg, gold_partition_by=by)
    run_medallion(spark, own)
    before = rows(spark, own, "gold")
    stale = read_layer(spark, own, "gold").limit(1).withColumn("date", F.lit("1999-01-01").cast("date")).unionByName(read_layer(spark, own, "gold").limit(1).withColumn("location", F.lit("it's \\ gone")))
    tables.append(spark.createDataFrame(stale.collect(), stale.schema), own, "gold")
    tables.append(spark.createDataFrame([(None, "n", 1, 1.0, 1.0, 1.0)], GOLD), own, "gold")
    silver_to_gold(spark, own, full_refresh=True)
    assert rows(spark, own, "gold") == before
    tables.overwrite_all(read_layer(spark, own, "silver").limit(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in GOLD]), own, "gold")
    assert rows(spark, own, "gold") == [] == tables.partitions(spark, own, "gold")


def test_silver_in_buckets_holds_the_same_rows(spark, cfg, land, event, days):
    run_medallion(spark, cfg)
    kept = dataclasses.replace(cfg, silver_db=f"{cfg.silver_db}_b", silver_buckets=3)
    bronze_to_silver(spark, kept)
    assert rows(spark, kept, "silver") == rows(spark, cfg, "silver")
    bronze_to_silver(spark, kept, "2024-07-20", "2024-07-20")
    assert rows(spark, kept, "silver") == rows(spark, cfg, "silver")
    files = [f for f in read_layer(spark, kept, "silver").inputFiles() if "date=2024-07-20" in f]
    assert 1 <= len(files) <= 3


def test_streams_leave_buckets_where_they_lie(spark, cfg, land, event, days):
    kept = dataclasses.replace(cfg, silver_buckets=3)

    def run():
        stream_bronze(read_message_stream(spark, kept), kept).awaitTermination()
        stream_silver(read_layer_stream(spark, kept, "bronze"), kept).awaitTermination()
        return read_layer(spark, kept, "silver").count()

    assert run() == 24
    land(event(ms=FIRST, user="u0L", down=77), event(ms=FIRST + 9, user="new"))
    assert run() == 25
    ingest_bronze(spark, kept, resume=True)
    for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
        spark.conf.set(name, "-1" if "Broadcast" in name else "false")
    try:
        present = read_layer(spark, kept, "silver", dates=["2024-07-19"]).select("user_id", "timestamp")
        text = pipelines.new_rows(read_layer(spark, kept, "bronze"), present, kept.bucket_by("silver"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    right = text[text.index("+-", text.rindex("Batched: true", 0, text.rindex("FileScan"))) :]
    assert "SortMergeJoin" in text and "Bucketed: true" in right and "Exchange" not in right, text
