import dataclasses

import pytest

from tiermill import PipelineConfig, cluster_settings, lake_settings
from tiermill.__main__ import parser
from tiermill.config import sized_shuffles
from tiermill.sources import read_messages


def test_environment_names_win_over_defaults_and_arguments_over_both():
    env = {"KAFKA_BROKER": "broker:9092", "KAFKA_TOPIC": "t", "SILVER_TABLE": "s", "GOLD_DB": "g", "BRONZE_DB": ""}
    cfg = PipelineConfig.from_env(env, topic="mine")
    assert (cfg.kafka_broker, cfg.topic, cfg.silver_table, cfg.gold_db, cfg.bronze_db) == (
        "broker:9092", "mine", "s", "g", "bronze",
    )


def test_table_names():
    assert PipelineConfig().table_name("gold") == "gold.measurements_hourly"
    lake = PipelineConfig(catalog="lake", table_format="iceberg")
    assert lake.table_name("bronze") == "lake.bronze.measurements_raw"
    assert lake.is_v2 and not PipelineConfig().is_v2


def test_no_secret_in_the_configuration():
    words = ("password", "secret", "access_key", "token")
    assert not [f.name for f in dataclasses.fields(PipelineConfig) if any(w in f.name for w in words)]
    settings = lake_settings("lake", "s3a://bucket/warehouse", "jdbc:postgresql://host/db", "http://store:9000")
    assert not [k for k in settings if any(w in k for w in (*words, "jdbc.user", "access.key"))]


@pytest.mark.parametrize(("size", "partitions"), [(0, 1), (1 << 30, 8), (2 << 40, 16_384), (100 << 40, 20_000)])
def test_shuffle_sizing_follows_the_input(size, partitions):
    assert cluster_settings(size)["spark.sql.shuffle.partitions"] == str(partitions)


def test_shuffles_are_sized_for_a_run(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with sized_shuffles(spark, 2 << 40):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "16384"
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_catalog_settings_come_from_the_environment():
    env = {"TABLE_FORMAT": "iceberg", "ICEBERG_CATALOG": "lake", "POSTGRES_HOST": "db", "POSTGRES_DB": "cat", "MINIO_BUCKET": "b", "MINIO_ENDPOINT": "http://s:9000"}
    settings = PipelineConfig.from_env(env).session_settings()
    assert settings["spark.sql.catalog.lake.uri"] == "jdbc:postgresql://db:5432/cat"
    assert settings["spark.sql.catalog.lake.warehouse"] == "s3a://b/warehouse"
    assert settings["spark.hadoop.fs.s3a.endpoint"] == "http://s:9000"
    assert PipelineConfig.from_env({}).session_settings() == {}


def test_the_layers_name_wins_over_the_ingest_jobs():
    assert PipelineConfig.from_env({"ICEBERG_DB": "a", "ICEBERG_TABLE": "t"}).table_name("bronze") == "a.t"
    assert PipelineConfig.from_env({"ICEBERG_DB": "a", "BRONZE_DB": "b"}).bronze_db == "b"


def test_checkpoints_need_a_place():
    with pytest.raises(ValueError):
        PipelineConfig().checkpoint("q")
    assert PipelineConfig(warehouse="/w/").checkpoint("q") == "/w/_checkpoints/q"


@pytest.mark.parametrize(
    "settings", [{"message_format": "kafka"}, {"message_format": "text"}, {"message_format": "avro", "message_path": "/x"}]
)
def test_incomplete_message_settings_are_refused(spark, settings):
    with pytest.raises(ValueError):
        read_messages(spark, PipelineConfig(**settings))


def test_command_line():
    args = parser().parse_args(["bronze-to-silver", "--date-from", "2024-01-01", "--date-to", "2024-01-02"])
    assert (args.job, args.date_from, args.date_to, args.full_refresh) == ("bronze-to-silver", "2024-01-01", "2024-01-02", False)
