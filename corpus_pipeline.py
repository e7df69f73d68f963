"""From raw documents to token ids, in stages that each read what the one before wrote.

Quality rules reject documents and take out common lines; line dedup takes out repeated chunks of lines, and documents
that consist of little else; near-dedup keeps one document of each group; documents that hold benchmark passages go; what
is left is encoded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tiermill.llm import bpe, decontamination, line_dedup, near_dedup, quality_rules
from tiermill.llm.lineage import cut

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Near-duplicates: words in a shingle, least similarity in percent, and bands in each collection.
SHINGLE, PERCENT, ALONG = 5, 80, 10


def reject_and_trim(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without lines that too many documents of their host share."""
    docs = docs.select(COLUMNS)
    passed = quality_rules.quality_rules(docs).filter("kept").select(F.col("doc_id").alias("_id"), "host", "version", "common").dropDuplicates(["_id", "host", "version"])
    own = docs["doc_id"].eqNullSafe(F.col("_id")) & (quality_rules.host_of(docs["source"]) == F.col("host")) & (quality_rules.version_of(docs["text"]) == F.col("version"))
    kept = docs.join(passed, own).select(*COLUMNS, "common")
    names = to_arrow_schema(docs.schema)

    def trim(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(COLUMNS)}
            texts = batch.column(1).to_pylist()
            left = quality_rules.without_lines(texts, batch.column(len(COLUMNS)).to_pylist())
            lengths = [n if a == b else len(b) for a, b, n in zip(texts, left, batch.column(4).to_pylist(), strict=True)]
            columns |= {"text": pa.array(left, names.field("text").type), "n_chars": pa.array(lengths, names.field("n_chars").type)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), COLUMNS)

    return kept.mapInArrow(trim, docs.schema)


def drop_repeated_chunks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without chunks of lines that an earlier place holds; one that they leave too few words for goes with them."""
    rows = line_dedup.line_dedup(docs.select(COLUMNS)).select("_row.*", F.col("_text"), F.col("_removed"))
    words = F.size(F.filter(F.split("_text", r"[\x20\x09-\x0D]+", -1), lambda w: w != ""))
    rows = rows.filter((F.col("_removed") == 0) | (words >= quality_rules.LEAST_WORDS))
    length = F.when(F.col("_removed") > 0, F.length("_text").cast("long")).otherwise(F.col("n_chars"))
    return rows.withColumn("n_chars", length).withColumn("text", F.col("_text")).select(COLUMNS)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates; documents without words stay.

    Rows are compared by id and text, so that texts under one id, or under none, are documents of their own; of rows that repeat
    both one stays.
    """
    docs = docs.select(*COLUMNS, F.struct(F.col("doc_id").alias("i"), quality_rules.version_of(F.col("text")).alias("v")).alias("_node"))
    gone = near_dedup.near_dedup(docs, SHINGLE, PERCENT, along=ALONG, id_col="_node").filter("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    rows = docs.filter(has_words).dropDuplicates(["_node"])
    return rows.join(gone, rows["_node"] == F.col("_gone"), "left_anti").select(COLUMNS).union(docs.filter(~has_words).select(COLUMNS))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontamination.decontaminate(docs.select(COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests of the ids and of the text decoded from them."""
    return bpe.encode_decode(docs, with_ids=True, keep=("doc_id", "lang", "source"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", reject_and_trim),
    ("line_dedup", drop_repeated_chunks),
    ("near_dedup", keep_one_of_each_group),
    ("decontamination", drop_leaks),
    ("bpe", encode),
]
#: No SQL engine encodes BPE; tests compare run() with the five stages in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each on what the one before wrote; the last one's rows are returned."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *before, (_, last) = STAGES
    for _, stage in before:
        docs = cut(stage(spark, docs, sf_dir))
    return last(spark, docs, sf_dir)
