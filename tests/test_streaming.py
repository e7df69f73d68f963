import dataclasses
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tiermill.plans import bronze_to_silver, ingest_bronze, silver_to_gold
from tiermill.sources import read_layer, read_layer_stream, read_message_stream
from tiermill.streaming import stream_bronze, stream_gold_hourly, stream_silver, stream_silver_smallest, stream_silver_stateful

START = 1721347200000  # 2024-07-19 00:00 UTC
HOUR = 3_600_000


def to_bronze(spark, cfg):
    stream_bronze(read_message_stream(spark, cfg), cfg).awaitTermination()


def to_silver(spark, cfg):
    to_bronze(spark, cfg)
    stream_silver(read_layer_stream(spark, cfg, "bronze"), cfg).awaitTermination()


def users(spark, cfg):
    return sorted((r["user_id"], r["latency"]) for r in read_layer(spark, cfg, "silver").collect())


def test_only_new_messages_are_read(spark, cfg, land, event):
    land(event(user="a"), "not json")
    to_bronze(spark, cfg)
    to_bronze(spark, cfg)
    assert read_layer(spark, cfg, "bronze").count() == 2
    land(event(user="b"))
    to_bronze(spark, cfg)
    assert read_layer(spark, cfg, "bronze").count() == 3


def test_replays_late_copies_and_dirt(spark, cfg, land, event):
    land(event(ms=START, user="a", latency=5), event(ms=START, user="a", latency=4), event(ms=START + 60 * HOUR, user="b"))
    land("not json", event(user="c", up="NaN"))
    to_silver(spark, cfg)
    assert users(spark, cfg) == [("a", 4.0), ("b", 3.5)]
    # A copy two and a half days late, smaller than the survivor: the key is taken.
    land(event(ms=START, user="a", latency=1), event(ms=START + 1, user="a", latency=9))
    to_silver(spark, cfg)
    assert users(spark, cfg) == [("a", 4.0), ("a", 9.0), ("b", 3.5)]


def test_a_batch_of_dirt_adds_nothing(spark, cfg, land):
    land("not json", "")
    to_silver(spark, cfg)
    assert read_layer(spark, cfg, "silver").count() == 0


def test_a_micro_batch_run_again_adds_nothing(spark, cfg, land, event):
    """Silver filled, but the offsets lost: the same rows arrive once more."""
    land(*[event(ms=START + i, user=f"u{i}") for i in range(20)])
    to_silver(spark, cfg)
    lost = dataclasses.replace(cfg, checkpoint_root=f"{cfg.warehouse}/other_checkpoints")
    stream_silver(read_layer_stream(spark, lost, "bronze"), lost).awaitTermination()
    assert read_layer(spark, cfg, "silver").count() == 20


@pytest.mark.parametrize("spread", [None, "_metadata.file_path"])
def test_stateful_deduplication(spark, cfg, land, event, spread):
    for _ in range(3):
        land(*[event(ms=START, user="hot")] * 5, event(ms=START + 1, user="b"))
    to_bronze(spark, cfg)
    column = F.col(spread) if spread else None

    def run():
        bronze = read_layer_stream(spark, cfg, "bronze")
        stream_silver_stateful(bronze, cfg, spread=column).awaitTermination()
        return users(spark, cfg)

    assert run() == [("b", 3.5), ("hot", 3.5)]
    land(event(ms=START, user="hot"), event(ms=START + 2, user="c"))
    to_bronze(spark, cfg)
    assert run() == [("b", 3.5), ("c", 3.5), ("hot", 3.5)]


def test_the_smallest_copy_survives_and_keys_are_forgotten(spark, cfg, land, event):
    def run():
        to_bronze(spark, cfg)
        stream_silver_smallest(read_layer_stream(spark, cfg, "bronze"), cfg, delay="1 hour").awaitTermination()
        return users(spark, cfg)

    land(event(ms=START, user="a", latency=5), event(ms=START + 60, user="b", latency=7), "not json", event(user="c", up="NaN"))
    assert run() == []  # copies may still come
    land(event(ms=START, user="a", latency=3), event(ms=START, user="a", latency=4), event(ms=START + HOUR // 2, user="d"))
    assert run() == []
    land(event(ms=START + 3 * HOUR, user="e"))
    assert run() == [("a", 3.0), ("b", 7.0), ("d", 3.5)]
    # a copy later than the delay is dropped, and a run without news adds nothing
    land(event(ms=START, user="a", latency=1))
    assert run() == run() == [("a", 3.0), ("b", 7.0), ("d", 3.5)]
    state = sum(f.stat().st_size for f in Path(cfg.checkpoint("stream_silver_smallest").removeprefix("file:")).rglob("*.delta"))
    assert state < 20_000


def test_gold_is_complete_and_takes_late_rows(spark, cfg, land, event):
    land(event(ms=START, down=1), event(ms=START + 1, user="v", down=3), event(ms=START + 2 * HOUR, down=8))

    def gold():
        to_silver(spark, cfg)
        stream_gold_hourly(read_layer_stream(spark, cfg, "silver"), cfg).awaitTermination()
        return sorted((str(r["date"])[8:], r["hour"], r["avg_download_speed"]) for r in read_layer(spark, cfg, "gold").collect())

    assert gold() == [("19", 0, 2.0), ("19", 2, 8.0)]
    land(event(ms=START + 29 * HOUR, down=9))
    land(event(ms=START + 2, user="w", down=5))  # more than a day late
    assert gold() == [("19", 0, 3.0), ("19", 2, 8.0), ("20", 5, 9.0)]


def test_batch_and_stream_share_their_tables(spark, cfg, land, event):
    """No row of either goes out of sight, in whatever order they write."""
    land(*[event(ms=START + d * 24 * HOUR, user=f"u{d}") for d in range(4)])
    ingest_bronze(spark, cfg)
    bronze_to_silver(spark, cfg, None, "2024-07-20")
    silver_to_gold(spark, cfg)
    to_silver(spark, cfg)
    stream_gold_hourly(read_layer_stream(spark, cfg, "silver"), cfg).awaitTermination()
    counts = {layer: read_layer(spark, cfg, layer).count() for layer in ("bronze", "silver", "gold")}
    assert counts == {"bronze": 8, "silver": 4, "gold": 4}
    land(event(ms=START + 4 * 24 * HOUR, user="u4"))
    to_silver(spark, cfg)
    bronze_to_silver(spark, cfg)
    silver_to_gold(spark, cfg)
    counts = {layer: read_layer(spark, cfg, layer).count() for layer in ("bronze", "silver", "gold")}
    assert counts == {"bronze": 9, "silver": 5, "gold": 5}


def test_no_table_has_a_stream_log(spark, cfg, land, event):
    land(event())
    to_silver(spark, cfg)
    stream_gold_hourly(read_layer_stream(spark, cfg, "silver"), cfg).awaitTermination()
    for layer in ("bronze", "silver", "gold"):
        assert not list(Path(cfg.location(layer).removeprefix("file:")).glob("_spark_metadata"))


def test_a_bronze_batch_run_again_is_passed_over(spark, cfg, land, event):
    land(event(user="a"), event(user="b"))
    to_bronze(spark, cfg)
    commits = Path(cfg.checkpoint("stream_bronze").removeprefix("file:")) / "commits"
    for file in [*commits.glob("0"), *commits.glob(".0.crc")]:
        file.rename(file.with_name(f"{file.name}-lost"))
    to_bronze(spark, cfg)  # the same micro-batch once more, as its commit is gone
    assert read_layer(spark, cfg, "bronze").count() == 2


def test_bounded_micro_batches_end_in_the_same_rows(spark, cfg, land, event):
    for i in range(4):
        land(*[event(ms=START + j, user=f"u{j}") for j in range(i, i + 3)])
    stream_bronze(read_message_stream(spark, cfg, max_per_trigger=1), cfg).awaitTermination()
    stream_silver(read_layer_stream(spark, cfg, "bronze", max_per_trigger=1), cfg).awaitTermination()
    assert [u for u, _ in users(spark, cfg)] == [f"u{j}" for j in range(6)]


def test_a_stray_timestamp_stops_nothing(spark, cfg, land, event):
    for _ in range(2):
        land(event(ms=START), event(ms=9_000_000_000_000_000, user="far"), event(ms=(1 << 63) - 1, user="farther"))
        to_silver(spark, cfg)
        found = read_layer(spark, cfg, "silver").select("user_id").collect()
        assert sorted(r["user_id"] for r in found) == ["far", "u1"]
