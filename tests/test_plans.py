"""What the plans must and must not hold, whatever the size of the data."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from tiermill.operators import analysis, cleaning, hourly
from tiermill.plans.jobs import bronze_to_silver
from tiermill.sources import read_layer
from verification import inputs

QUERIES = contract.queries()
# Queries whose result is a re-read table say nothing by their last plan; the rest are looked at.
LAZY = [
    "add_date",
    "add_date_if_missing",
    "add_hour",
    "add_hour_seconds",
    "avg_by_label",
    "clean",
    "counter_rate_1m",
    "counter_rate_5m",
    "date_distribution",
    "dedup",
    "drop_nulls",
    "encode_json",
    "error_rate",
    "freshness_seconds",
    "gold_hourly",
    "gold_kpis",
    "gold_today",
    "hourly_trend",
    "latency_by_location",
    "layer_row_counts",
    "metric_latest",
    "metric_status",
    "metric_time_range",
    "metric_timeline",
    "parse_messages",
    "pipeline_health",
    "preview_rows",
    "quality_pct",
    "quality_report",
    "scan_messages",
    "throughput_total",
    "top_locations",
    "top_locations_weighted",
]


# Whole plans in their static form: nothing cut off, no stage replaced at run time.
SHOWN = {
    "spark.sql.maxPlanStringLength": "10000000",
    "spark.sql.maxMetadataStringLength": "10000",
    "spark.sql.debug.maxToStringFields": "10000",
    "spark.sql.adaptive.enabled": "false",
}


def plan(df) -> str:
    conf = df.sparkSession.conf
    before = {k: conf.get(k) for k in SHOWN}
    for k, v in SHOWN.items():
        conf.set(k, v)
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            conf.set(k, v)


@pytest.mark.parametrize("name", LAZY)
def test_no_pair_joins_and_no_python(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "BatchEval", "Existing RDD"):
        assert operator not in text


def test_null_filter_reaches_the_scan(spark, sf_dir):
    cfg = inputs.built_pipeline(spark, sf_dir, "bronze")
    text = plan(cleaning.drop_nulls(read_layer(spark, cfg, "bronze")))
    assert "PushedFilters: [" in text
    for column in ("timestamp", "user_id", "upload_speed", "download_speed", "latency", "location"):
        assert f"IsNotNull({column})" in text


def test_gold_questions_prune_partitions_and_columns(spark, sf_dir):
    gold = read_layer(spark, inputs.built_pipeline(spark, sf_dir), "gold")
    top = plan(analysis.top_locations(gold, "2024-01-30"))
    assert "TakeOrderedAndProject" in top
    assert "PartitionFilters: [isnotnull(date" in top and ">= 2024-01-29" in top
    assert "ReadSchema: struct<location:string,avg_download_speed:double>" in top
    latency = plan(analysis.latency_by_location(gold))
    assert "ReadSchema: struct<location:string,avg_latency:double>" in latency
    trend = plan(analysis.hourly_trend(gold, "New York"))
    assert "EqualTo(location,New York)" in trend


def test_copies_are_combined_before_the_one_shuffle(spark, sf_dir):
    cfg = inputs.built_pipeline(spark, sf_dir, "bronze")
    text = plan(cleaning.clean(read_layer(spark, cfg, "bronze")))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.index("partial_min") > text.index("Exchange hashpartitioning")


def test_gold_shuffles_partial_sums(spark, sf_dir):
    silver = read_layer(spark, inputs.built_pipeline(spark, sf_dir, "silver"), "silver")
    text = plan(hourly.gold_hourly(silver))
    assert text.count("Exchange") == 1 and "partial_avg" in text


def test_percentiles_shuffle_counts_of_digits_alone(spark, sf_dir):
    silver = read_layer(spark, inputs.built_pipeline(spark, sf_dir, "silver"), "silver")
    text = plan(hourly.gold_kpis(silver))
    # two levels of a scan each; what is shuffled has been counted before, and nothing is ranked within a group
    assert text.count("FileScan") == 2 and "Window" not in text and "ReusedExchange" in text
    # one for the KPIs' own groups; two for the join of rows with their prefixes, which a broadcast does without
    assert text.count("Exchange hashpartitioning") <= 4 + 1 + 2


def test_quality_ratio_needs_no_join(spark, sf_dir):
    assert "Join" not in plan(QUERIES["quality_pct"](spark, sf_dir))


def test_counts_read_no_columns(spark, sf_dir):
    text = plan(QUERIES["layer_row_counts"](spark, sf_dir))
    assert text.count("ReadSchema: struct<>") == 4


def test_a_day_of_silver_reads_a_day_of_bronze(spark, sf_dir):
    built = inputs.built_pipeline(spark, sf_dir, "bronze")
    text = plan(cleaning.clean(read_layer(spark, built, "bronze", "2024-01-05", "2024-01-05")))
    assert "InMemoryFileIndex(1 paths)" in text and "date=2024-01-05" in text


def test_shared_folder_comes_from_the_session(spark):
    from verification.workspace import shared_folder

    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert shared_folder(spark) == configured.rstrip("/")
    else:
        assert Path(shared_folder(spark)).is_dir()


def test_date_range_and_refresh_exclude_each_other(spark, cfg):
    with pytest.raises(ValueError):
        bronze_to_silver(spark, cfg, "2024-01-01", "2024-01-02", full_refresh=True)
