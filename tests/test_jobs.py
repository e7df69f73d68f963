import dataclasses
from datetime import date

import pytest
from pyspark.sql import functions as F

from tiermill.config import LAYERS
from tiermill.operators.parsing import add_date
from tiermill.operators.quality import error_rate
from tiermill.operators.storage import storage_usage
from tiermill.plans import (
    bronze_to_silver,
    ingest_bronze,
    layer_row_counts,
    maintenance_report,
    register_tables,
    run_medallion,
    run_samples,
    silver_to_gold,
    table_history,
    table_metrics,
)
from tiermill.schemas import MESSAGE
from tiermill.sinks import tables
from tiermill.sources import metrics as M
from tiermill.sources import read_layer, read_metrics
from tiermill.sources.layers import bytes_to_read

DAY_MS = 86_400_000
FIRST = 1721347200000  # 2024-07-19 00:00 UTC


def rows(spark, cfg, layer):
    return sorted(map(str, read_layer(spark, cfg, layer).collect()))


@pytest.fixture
def three_days(land, event):
    land(*[event(ms=FIRST + d * DAY_MS + h * 3_600_000, user=f"u{u}", down=u + d) for d in range(3) for h in (1, 2) for u in (1, 2)])
    land("not json", event(up="NaN"), event(ms=FIRST + 3_600_000, user="u1", down=9.0))


def test_whole_run(spark, cfg, three_days):
    (ingest, silver, gold), report = run_medallion(spark, cfg)
    # The message that is no event is counted at ingest, as no dated run meets it.
    assert (ingest.rows_in, ingest.rows_rejected, ingest.rows_out) == (15, 1, 15)
    assert (silver.rows_in, silver.rows_rejected, silver.rows_out) == (14, 1, 12)
    assert (gold.rows_in, gold.rows_out) == (12, 6)
    counts = {r["layer"]: r["row_count"] for r in layer_row_counts(spark, cfg, with_messages=True).collect()}
    assert counts == {"bronze": 15, "silver": 12, "gold": 6, "messages": 15}
    assert [(r["row_count"], r["commits"], r["status"]) for r in report.collect()] == [(15, 1, "ok"), (12, 1, "ok"), (6, 1, "ok")]


def test_silver_and_gold_are_idempotent_and_absorb_replays(spark, cfg, three_days):
    run_medallion(spark, cfg)
    before = rows(spark, cfg, "silver"), rows(spark, cfg, "gold")
    ingest_bronze(spark, cfg)  # the whole landing folder again
    bronze_to_silver(spark, cfg)
    silver_to_gold(spark, cfg)
    assert read_layer(spark, cfg, "bronze").count() == 30
    assert (rows(spark, cfg, "silver"), rows(spark, cfg, "gold")) == before


def test_day_by_day_equals_one_run(spark, cfg, three_days):
    run_medallion(spark, cfg)
    daily = dataclasses.replace(cfg, silver_db=f"{cfg.silver_db}_d", gold_db=f"{cfg.gold_db}_d")
    for day in (19, 20, 21):
        bronze_to_silver(spark, daily, f"2024-07-{day}", f"2024-07-{day}")
        silver_to_gold(spark, daily, f"2024-07-{day}", f"2024-07-{day}")
    assert rows(spark, daily, "silver") == rows(spark, cfg, "silver")
    assert rows(spark, daily, "gold") == rows(spark, cfg, "gold")


def test_one_day_leaves_the_others_untouched(spark, cfg, three_days):
    run_medallion(spark, cfg)
    changed = read_layer(spark, cfg, "silver", "2024-07-20", "2024-07-20").limit(1)
    one = spark.createDataFrame(changed.collect(), changed.schema)
    tables.overwrite_partitions(one, cfg, "silver")
    per_day = {r["date"].day: r["count"] for r in read_layer(spark, cfg, "silver").groupBy("date").count().collect()}
    assert per_day == {19: 4, 20: 1, 21: 4}


def test_full_refresh_removes_stale_partitions(spark, cfg, three_days):
    run_medallion(spark, cfg)
    stale = read_layer(spark, cfg, "gold").limit(1).withColumn("date", F.lit("1999-01-01").cast("date"))
    tables.append(spark.createDataFrame(stale.collect(), stale.schema), cfg, "gold")
    silver_to_gold(spark, cfg)
    assert read_layer(spark, cfg, "gold", None, "2000-01-01").count() == 1
    silver_to_gold(spark, cfg, full_refresh=True)
    assert read_layer(spark, cfg, "gold", None, "2000-01-01").count() == 0
    assert read_layer(spark, cfg, "gold").count() == 6
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == "dynamic"
    with pytest.raises(ValueError):
        silver_to_gold(spark, cfg, "2024-07-19", full_refresh=True)


def test_files_per_day_stay_few(spark, cfg, three_days):
    run_medallion(spark, cfg)
    usage = storage_usage(spark, cfg, "silver").collect()
    assert {r["date"] for r in usage} == {date(2024, 7, d) for d in (19, 20, 21)}
    assert all(r["files"] == 1 and r["bytes"] > 0 for r in usage)


def test_gold_by_date_and_location(spark, cfg, three_days):
    by_place = dataclasses.replace(cfg, gold_partition_by=("date", "location"))
    run_medallion(spark, by_place)
    usage = storage_usage(spark, by_place, "gold")
    assert usage.columns == ["date", "location", "files", "bytes"]
    assert usage.count() == 3


def test_backfill_by_date(spark, cfg, three_days):
    ingest_bronze(spark, cfg, by_date=True)
    assert read_layer(spark, cfg, "bronze").count() == 15


def test_failed_run_is_logged_and_raised(spark, cfg):
    with pytest.raises(Exception):
        bronze_to_silver(spark, cfg)  # no bronze table
    log = spark.table(cfg.table_name("run_log")).collect()
    assert [(r["job"], r["status"].split(":")[0], r["rows_out"]) for r in log] == [("bronze_to_silver", "failed", None)]


def test_history_and_error_rate(spark, cfg, three_days):
    run_medallion(spark, cfg)
    bronze_to_silver(spark, cfg)
    assert [table_history(spark, cfg, layer).count() for layer in LAYERS] == [1, 2, 1]
    rates = error_rate(spark.table(cfg.table_name("run_log"))).where("job = 'bronze_to_silver'").collect()
    assert [round(r["error_pct"], 4) for r in rates] == [round(100 / 14, 4)] * 2


def test_maintenance_reports_a_missing_table_and_goes_on(spark, cfg, three_days):
    ingest_bronze(spark, cfg)
    bronze_to_silver(spark, cfg)
    report = {r["layer"]: r for r in maintenance_report(spark, cfg).collect()}
    assert (report["bronze"]["status"], report["silver"]["row_count"]) == ("ok", 12)
    assert report["gold"]["status"] == "error" and report["gold"]["row_count"] is None
    with pytest.raises(Exception):
        layer_row_counts(spark, cfg)


def test_register_existing_files(spark, cfg, three_days):
    run_medallion(spark, cfg)
    moved = dataclasses.replace(cfg, bronze_db=f"{cfg.bronze_db}_r", silver_db=f"{cfg.silver_db}_r", gold_db=f"{cfg.gold_db}_r")
    for layer in LAYERS:
        tables.register_table(spark, moved, layer, cfg.location(layer))
        assert rows(spark, moved, layer) == rows(spark, cfg, layer)
    assert {r["status"] for r in register_tables(spark, cfg).collect()} == {"registered"}


def test_register_reports_what_fails(spark, cfg):
    nowhere = dataclasses.replace(cfg, warehouse=None)
    statuses = {r["status"] for r in register_tables(spark, nowhere).collect()}
    assert statuses == {"failed"}


def test_table_metrics_append_samples(spark, cfg, three_days):
    run_medallion(spark, cfg)
    table_metrics(spark, cfg, "2024-07-22 00:00:00")
    table_metrics(spark, cfg, "2024-07-22 00:00:30")
    samples = read_metrics(spark, cfg)
    assert samples.count() == 8
    assert read_metrics(spark, cfg, "2024-07-23").count() == 0
    assert samples.where("metric = 'silver_table_row_count'").select("value").distinct().collect()[0][0] == 12.0


def test_metrics_and_runs_are_read_by_day(spark, cfg, three_days):
    run_medallion(spark, cfg)
    table_metrics(spark, cfg, "2024-07-22 00:00:00")
    plan = read_metrics(spark, cfg, "2024-07-22", "2024-07-22")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert cfg.partition_by("run_log") == ("date",)
    found = {(r["metric"], r["job_id"]): r["value"] for r in run_samples(spark.table(cfg.table_name("run_log"))).collect()}
    assert found[M.MESSAGES_IN, "ingest_bronze"] == 15
    assert all(found[M.JOB_DURATION, job] > 0 for job in ("ingest_bronze", "bronze_to_silver", "silver_to_gold"))


def test_lineage_for_a_table_without_it_is_refused(spark, cfg, three_days):
    ingest_bronze(spark, cfg)
    with pytest.raises(ValueError, match="_offset"):
        ingest_bronze(spark, dataclasses.replace(cfg, keep_lineage=True))


def test_a_scan_tells_its_size(spark, cfg, three_days):
    run_medallion(spark, cfg)
    whole, day = bytes_to_read(read_layer(spark, cfg, "silver")), bytes_to_read(read_layer(spark, cfg, "silver", "2024-07-19", "2024-07-19"))
    assert 0 < day < whole < 1 << 20


def test_lineage_survives_to_bronze_and_not_to_silver(spark, cfg, three_days):
    kept = dataclasses.replace(cfg, keep_lineage=True)
    ingest_bronze(spark, kept)
    bronze_to_silver(spark, kept)
    assert "_topic" in read_layer(spark, kept, "bronze").columns
    assert read_layer(spark, kept, "silver").columns == [
        "timestamp", "user_id", "upload_speed", "download_speed", "latency", "location", "date",
    ]


def test_a_day_that_holds_most_rows_is_written_by_several_tasks(spark, cfg):
    """A third of the rows on one day: its partition is cut, most small days stay whole."""
    n = 300_000
    day = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 30)
    spread = spark.range(0, n, 1, 8).select(
        (F.lit(FIRST) + day * DAY_MS + F.col("id")).alias("timestamp"),
        F.col("id").cast("string").alias("user_id"),
        *[(F.hash("id", F.lit(c)) % 1000).cast("float").alias(c) for c in ("upload_speed", "download_speed", "latency")],
        F.lit("London").alias("location"),
    )
    tables.create_schema(spark, cfg, "bronze")
    tables.create_table(spark, cfg, "bronze")
    tables.append(add_date(spread), cfg, "bronze")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2MB")
    try:
        bronze_to_silver(spark, cfg)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    files = {r["date"]: r["files"] for r in storage_usage(spark, cfg, "silver").collect()}
    hot = date(2024, 7, 19)
    assert read_layer(spark, cfg, "silver").count() == n
    # Small days that share the hot day's shuffle partition may be cut along with it.
    assert files[hot] > 1, files
    assert sorted(files.values())[len(files) // 2] == 1


def test_only_touched_dates_are_redone(spark, cfg, three_days, event):
    run_medallion(spark, cfg)
    before = rows(spark, cfg, "gold")
    new = dataclasses.replace(cfg, message_path=f"{cfg.message_path}_new")
    line = event(ms=FIRST + DAY_MS, user="new", down=77.0)
    spark.createDataFrame([(line,)], "value string").write.text(new.message_path)
    (ingest, silver, gold), _ = run_medallion(spark, new, touched_only=True)
    assert (ingest.first_date, ingest.last_date) == ("2024-07-20", "2024-07-20")
    assert (silver.rows_in, silver.rows_out, gold.rows_out) == (5, 5, 3)
    added = set(rows(spark, cfg, "gold")) - set(before)
    assert len(added) == 1 and "77.0" in added.pop()


def test_stray_dates_open_no_days_between(spark, cfg, three_days, event):
    run_medallion(spark, cfg)
    new = dataclasses.replace(cfg, message_path=f"{cfg.message_path}_new")
    lines = [(event(ms=5, user="old"),), (event(ms=FIRST + 2 * DAY_MS, user="new"),), (event(ms=9_000_000_000_000_000, user="far"),)]
    spark.createDataFrame(lines, "value string").write.text(new.message_path)
    (ingest, silver, gold), _ = run_medallion(spark, new, touched_only=True)
    assert len(ingest.dates) == 3
    # One stray row on either side, and the four rows of the last day with the new one; the days between are not read.
    assert (silver.rows_in, silver.rows_out) == (7, 7)
    assert read_layer(spark, cfg, "gold").count() == 6 + 2 + 1


def test_dated_runs_count_what_a_whole_run_counts(spark, cfg, three_days):
    ingest_bronze(spark, cfg)
    whole = bronze_to_silver(spark, cfg)
    days = [bronze_to_silver(spark, cfg, d, d) for d in ("2024-07-19", "2024-07-20", "2024-07-21")]
    assert sum(r.rows_rejected for r in days) == whole.rows_rejected
    assert sum(r.rows_in for r in days) == whole.rows_in


def test_a_failing_run_log_does_not_hide_the_jobs_error(spark, cfg, monkeypatch):
    def broken(*_):
        raise OSError("no log")

    monkeypatch.setattr("tiermill.plans.run_log._add_to_log", broken)
    with pytest.raises(Exception) as caught:
        bronze_to_silver(spark, cfg)  # no bronze table
    assert not isinstance(caught.value, OSError) and any("no log" in n for n in caught.value.__notes__)


def test_runs_resume_where_the_last_one_ended(spark, cfg, event):
    archive = dataclasses.replace(cfg, message_format="parquet", message_path=f"{cfg.message_path}_archive")

    def send(*rows):
        lines = [(None, event(user=f"u{p}-{o}").encode(), cfg.topic, p, o, None, 0) for p, o in rows]
        spark.createDataFrame(lines, MESSAGE).write.mode("append").parquet(archive.message_path)

    send((0, 0), (0, 1), (1, 7))
    assert ingest_bronze(spark, archive, resume=True).rows_out == 3
    assert ingest_bronze(spark, archive, resume=True).rows_out == 0
    send((0, 2), (2, 0))
    assert ingest_bronze(spark, archive, resume=True).rows_out == 2
    assert ingest_bronze(spark, archive, '{"measurements": {"0": 1, "1": 8}}').rows_out == 3
    assert ingest_bronze(spark, archive, None, '{"measurements": {"0": 1}}').rows_out == 1


def test_lines_have_no_offsets(spark, cfg, land, event):
    land(event())
    with pytest.raises(ValueError):
        ingest_bronze(spark, cfg, '{"measurements": {"0": 1}}')


def test_no_dates_touched_redoes_nothing(spark, cfg, land):
    land("not json")
    runs, report = run_medallion(spark, cfg, touched_only=True)
    assert [r.job for r in runs] == ["ingest_bronze"] and runs[0].first_date is None
    assert {r["layer"]: r["status"] for r in report.collect()} == {"bronze": "ok", "silver": "error", "gold": "error"}


@pytest.mark.parametrize("touched_only", [False, True])
def test_a_stray_timestamp_stops_nothing(spark, cfg, land, event, touched_only):
    land(event(ms=FIRST), event(ms=9_000_000_000_000_000, user="far"), event(ms=(1 << 63) - 1, user="farther"))
    (ingest, silver, gold), _ = run_medallion(spark, cfg, touched_only=touched_only)
    assert (ingest.rows_out, silver.rows_out, gold.rows_out) == (3, 2, 2)
    assert ingest.first_date == "2024-07-19" and ingest.last_date.startswith("+287")
    assert {r["user_id"] for r in read_layer(spark, cfg, "silver").select("user_id").collect()} == {"u1", "far"}
