"""What is kept up to date by what came, in place of being taken anew: gold, current values, and days left alone."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from tiermill.operators import hourly
from tiermill.plans import add_samples, bronze_to_silver, day_marks, ingest_bronze, redo_changed
from tiermill.plans.monitoring import fold_current
from tiermill.schemas import METRICS
from tiermill.sinks import tables
from tiermill.sources import metrics as M
from tiermill.sources import read_layer, read_layer_stream, read_message_stream
from tiermill.streaming import pipelines, stream_bronze, stream_gold_incremental, stream_silver

START = 1721347200000  # 2024-07-19 00:00 UTC
HOUR = 3_600_000


def gold(spark, cfg, **options):
    stream_bronze(read_message_stream(spark, cfg), cfg).awaitTermination()
    stream_silver(read_layer_stream(spark, cfg, "bronze"), cfg).awaitTermination()
    stream_gold_incremental(read_layer_stream(spark, cfg, "silver"), cfg, **options).awaitTermination()
    return rows(spark, cfg)


def rows(spark, cfg):
    return sorted((str(r["date"])[8:], r["hour"], r["avg_download_speed"]) for r in read_layer(spark, cfg, "gold").collect())


def whole(spark, cfg):
    """Gold taken from all of silver."""
    found = hourly.gold_hourly(read_layer(spark, cfg, "silver")).collect()
    return sorted((str(r["date"])[8:], r["hour"], r["avg_download_speed"]) for r in found)


def test_gold_grows_by_what_came(spark, cfg, land, event):
    land(event(ms=START, down=1), event(ms=START + 1, user="v", down=3), event(ms=START + 2 * HOUR, down=8))
    assert gold(spark, cfg) == [("19", 0, 2.0), ("19", 2, 8.0)]
    assert gold(spark, cfg) == [("19", 0, 2.0), ("19", 2, 8.0)]
    land(event(ms=START + 29 * HOUR, down=9), event(ms=START, down=1))  # a copy of the first among them
    land(event(ms=START + 2, user="w", down=5))
    assert gold(spark, cfg) == [("19", 0, 3.0), ("19", 2, 8.0), ("20", 5, 9.0)] == whole(spark, cfg)


@pytest.mark.parametrize("every", [1, 2, 64])
def test_pieces_become_one(spark, cfg, land, event, every):
    for i in range(5):
        land(event(ms=START + i, user=f"u{i}", down=i), event(ms=START + (i % 2) * HOUR, user=f"x{i}", down=10 * i))
        assert gold(spark, cfg, compact_every=every) == whole(spark, cfg)
    pieces = spark.table(cfg.table_name("gold_parts")).select("piece").distinct().count()
    assert pieces == {1: 1, 2: 2, 64: 5}[every]


def test_a_micro_batch_that_comes_again_replaces_its_piece(spark, cfg, land, event, monkeypatch):
    land(event(ms=START, down=4), event(ms=START + 1, user="v", down=6))
    with monkeypatch.context() as broken:
        broken.setattr(pipelines, "gold_of_parts", lambda *_: 1 / 0)
        with pytest.raises(Exception):
            gold(spark, cfg)
    assert spark.table(cfg.table_name("gold_parts")).count() == 1 and rows(spark, cfg) == []
    assert gold(spark, cfg) == [("19", 0, 5.0)]


def test_gold_of_parts_reads_no_silver(spark, cfg, land, event):
    land(event())
    gold(spark, cfg)
    name = spark.table(cfg.table_name("gold_parts")).select(F.split_part("piece", F.lit("-"), F.lit(1))).first()[0]
    text = hourly.gold_of_parts(pipelines.read_gold_parts(spark, cfg, name, ["2024-07-19"]))._jdf.queryExecution().executedPlan().toString()
    assert cfg.table("silver") not in text and "gold_parts" in text and "PartitionFilters: [" in text


def test_two_streams_keep_their_pieces_apart(spark, cfg, land, event):
    land(event(down=4))
    assert gold(spark, cfg) == [("19", 18, 4.0)]
    other = dataclasses.replace(cfg, checkpoint_root=f"{cfg.warehouse}/other")
    stream_gold_incremental(read_layer_stream(spark, other, "silver"), other).awaitTermination()
    assert rows(spark, cfg) == [("19", 18, 4.0)]


# --- current values


@pytest.fixture
def samples_of(spark):
    return lambda rows: spark.createDataFrame([(m, s, None, None, t, v) for m, s, t, v in rows], "metric string, series string, job_id string, query_id string, t string, value double").select(
        "metric", "series", "job_id", "query_id", F.col("t").cast("timestamp").alias("ts"), "value"
    )


def current(spark, cfg):
    return sorted((r["metric"], r["series"], str(r["ts"])[11:16], r["value"]) for r in M.read_current(spark, cfg).collect())


def test_the_newest_sample_stays_whatever_comes_late(spark, cfg, samples_of):
    add_samples(spark, cfg, samples_of([("a", "x", "2024-01-01 10:00:00", 1.0), ("a", "y", "2024-01-01 10:00:00", 2.0), ("a", "x", "2024-01-01 09:00:00", 9.0)]))
    assert current(spark, cfg) == [("a", "x", "10:00", 1.0), ("a", "y", "10:00", 2.0)]
    late = samples_of([("a", "x", "2024-01-01 08:00:00", 5.0), ("a", "y", "2024-01-01 11:00:00", 3.0), ("b", "x", "2024-01-01 07:00:00", 4.0), ("a", "x", "2024-01-01 10:00:00", 1.5)])
    expected = [("a", "x", "10:00", 1.5), ("a", "y", "11:00", 3.0), ("b", "x", "07:00", 4.0)]
    for _ in range(3):  # again, as after a failure
        add_samples(spark, cfg, late)
        assert current(spark, cfg) == expected
    scanned = M.latest_values(M.read_metrics(spark, cfg), ["a", "b"]).collect()
    assert sorted((r["metric"], r["series"], str(r["ts"])[11:16], r["value"]) for r in scanned) == expected
    assert spark.table(cfg.table_name("metrics_current")).select("version").distinct().count() == 2
    fold_current(spark, cfg, samples_of([]))
    assert current(spark, cfg) == expected


def test_current_values_read_no_history(spark, cfg, samples_of):
    add_samples(spark, cfg, samples_of([("a", "x", "2024-01-01 10:00:00", 1.0)]))
    text = M.read_current(spark, cfg, ["a"])._jdf.queryExecution().executedPlan().toString()
    assert "metrics_current" in text and f"{cfg.ops_db}.metrics[" not in text and "PartitionFilters: [isnotnull(version" in text


def test_the_last_hour_lists_one_days_files(spark, cfg, samples_of):
    add_samples(spark, cfg, samples_of([("a", "x", f"2024-01-{d:02d} 10:00:00", float(d)) for d in range(1, 20)]))
    recent = M.time_range(M.read_metrics(spark, cfg), "2024-01-07 10:30:00")
    assert [r["value"] for r in recent.collect()] == [7.0]
    assert "PartitionFilters: [isnotnull(date" in recent._jdf.queryExecution().executedPlan().toString()
    assert set(METRICS.fieldNames()) < set(recent.columns)


# --- days left alone


def test_marks_know_no_order_but_every_row(spark):
    schema = "user_id string, latency float, date date"
    from datetime import date

    day, other = date(2024, 7, 19), date(2024, 7, 20)
    rows = [("a", 1.0, day), ("b", None, day), ("a", 1.0, other), (None, 2.0, other), ("z", 1.0, None)]
    marks = lambda r: {m["day"]: (m["rows"], m["hash"]) for m in day_marks.marks_of(spark.createDataFrame(r, schema).repartition(3)).collect()}
    first = marks(rows)
    assert first == marks(rows[::-1]) and set(first) == {"2024-07-19", "2024-07-20"}
    assert marks(rows + [rows[0]])["2024-07-19"] != first["2024-07-19"] and marks(rows + [rows[0]])["2024-07-20"] == first["2024-07-20"]
    swapped = [("a", None, day), ("b", 1.0, day)]
    assert marks(swapped)["2024-07-19"] != first["2024-07-19"]


def test_of_many_days_the_changed_one_is_redone(spark, cfg, land, event):
    land(*[event(ms=START + d * 24 * HOUR, user=f"u{d}", down=d + 1) for d in range(30)])
    ingest_bronze(spark, cfg, resume=True)
    assert [r.rows_out for r in redo_changed(spark, cfg)] == [30, 30]
    assert redo_changed(spark, cfg) == []
    land(event(ms=START + 7 * 24 * HOUR, user="late", down=100))
    ingest_bronze(spark, cfg, resume=True)
    runs = redo_changed(spark, cfg)
    assert [(r.job, r.rows_in, r.rows_out, r.first_date, r.last_date) for r in runs] == [("bronze_to_silver", 2, 2, "2024-07-26", "2024-07-26"), ("silver_to_gold", 2, 1, "2024-07-26", "2024-07-26")]
    assert read_layer(spark, cfg, "gold").count() == 30 and redo_changed(spark, cfg) == []


def test_a_failed_redo_is_done_again(spark, cfg, land, event, monkeypatch):
    land(event())
    ingest_bronze(spark, cfg)
    with monkeypatch.context() as broken:
        broken.setattr("tiermill.plans.jobs.silver_to_gold", lambda *_, **__: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            redo_changed(spark, cfg)
    assert len(redo_changed(spark, cfg)) == 2
    tables.ensure_table(spark, cfg, "silver")
    bronze_to_silver(spark, cfg)
    assert redo_changed(spark, cfg) == []
