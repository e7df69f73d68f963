"""Ids that are text: every operator that doesn't compute with them carries them as they are."""

import pytest
from pyspark.sql import functions as F

from tiermill.llm import bpe, decontamination, filter_audit, quality_classifier, quality_rules, secret_scans, token_counts, toxicity, vector_codes

IDS = ["b", "a", None, "ü", "a"]


@pytest.fixture(scope="module")
def docs(spark, prose):
    item = " ".join(f"item{i}" for i in range(20))
    texts = [prose(1), f"{prose(2)} {item}", prose(3), "", f"{prose(2)} {item}"]
    return spark.createDataFrame([(i, t, "web") for i, t in zip(IDS, texts, strict=True)], "doc_id string, text string, source string")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([("a", 1, 0), ("b", 0, 1)], "doc_id string, quality int, toxic int")


def test_operators_on_single_texts(docs, labels):
    for rows in (bpe.encode_decode(docs), token_counts.count_tokens(docs), quality_rules.quality_rules(docs), secret_scans.secret_scans(docs), toxicity.toxicity(docs, labels), quality_classifier.quality(docs, labels)):
        assert sorted((r.doc_id for r in rows.collect()), key=str) == sorted(IDS, key=str)


def test_operators_across_texts(spark, docs, labels):
    items = spark.createDataFrame([("x", " ".join(f"item{i}" for i in range(20)))], "item_id string, text string")
    assert {(r.doc_id, r.item_id) for r in decontamination.leaks(docs, items).collect()} == {("a", "x")}
    assert decontamination.decontaminate(docs, items).count() == 3
    first = filter_audit.filter_audit(docs, labels).filter("filter_order = 'EABCD' and step = 1").collect()
    assert [(r.part, r.kept, r.removed) for r in first] == [("web", 5, 0)]
    again = docs.withColumn("doc_id", F.concat("doc_id", F.lit("2"))).unionByName(docs)
    assert [r.removed for r in filter_audit.filter_audit(again, labels).filter("filter_order = 'EABCD' and step = 1").collect()] == [4]


def test_vector_codes(spark):
    rows = spark.createDataFrame([("b", [0.5, 0.25, 0.0, 1.0], 1), ("a", [0.0, 0.25, 0.5, 1.0], 1)], "vec_id string, embedding array<float>, label int")
    assert {r.id: r.code for r in vector_codes.code_table(rows).collect()} == {"a": "00000000", "b": "01000100"}
