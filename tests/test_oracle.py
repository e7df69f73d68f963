"""Every registered query against DuckDB on the same tables."""

import compare
import pytest

import __spark_entry__ as contract

QUERIES = contract.queries()
ORACLE = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, sf_dir, duck, name):
    assert compare.differences(QUERIES[name](spark, sf_dir), duck, ORACLE[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_has_rows(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_no_sql_without_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["date", "location", "hour", "avg_upload_speed", "avg_download_speed", "avg_latency"]
    assert result.count() > 0
