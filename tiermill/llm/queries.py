"""The operators of this subpackage as queries over whole tables: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tiermill.llm import (
    bpe,
    decontamination,
    filter_audit,
    line_dedup,
    near_dedup,
    neighbours,
    quality_classifier,
    quality_rules,
    secret_scans,
    substring_dedup,
    token_counts,
    toxicity,
    vector_codes,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What documents lose, by the document that keeps it: number, characters and places of the spans."""
    gone = substring_dedup.repeated_spans(table(spark, sf_dir, "documents"))
    listed = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["start"], s["stop"])), ",")
    lost = F.aggregate("spans", F.lit(0), lambda a, s: a + s["stop"] - s["start"])
    return gone.select("doc_id", "first_doc_id", F.size("spans").alias("n_spans"), lost.alias("n_chars"), listed.alias("spans"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(table(spark, sf_dir, "documents")).drop("host", "version", "common")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each document its lines, those removed, and the MD5 of what is left."""
    done = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    return done.select(
        F.col("_id").alias("doc_id"), F.col("_lines").alias("n_lines"), F.col("_removed").alias("n_removed_lines"), F.md5(F.coalesce("_text", F.lit(""))).alias("text_md5")
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The passages of the benchmark found, by document."""
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scans.secret_scans(table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_table(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op13_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def queries() -> dict[str, Query]:
    return {
        "op1_bpe": op1_bpe,
        "op2_token_counts": op2_token_counts,
        "op3_toxicity": op3_toxicity,
        "op4_substring_dedup": op4_substring_dedup,
        "op5_quality_rules": op5_quality_rules,
        "op6_quality_classifier": op6_quality_classifier,
        "op7_near_dedup": op7_near_dedup,
        "op8_line_dedup": op8_line_dedup,
        "op9_decontamination": op9_decontamination,
        "op10_secret_scans": op10_secret_scans,
        "op11_filter_audit": op11_filter_audit,
        "op12_vector_codes": op12_vector_codes,
        "op13_neighbours": op13_neighbours,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_substring_dedup": substring_dedup.SQL,
        "op5_quality_rules": quality_rules.SQL,
        "op7_near_dedup": near_dedup.SQL,
        "op8_line_dedup": line_dedup.SQL,
        "op9_decontamination": decontamination.SQL,
        "op11_filter_audit": filter_audit.SQL,
        "op12_vector_codes": vector_codes.SQL,
    }
