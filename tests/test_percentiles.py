import random

import numpy as np
import pytest

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tiermill.operators.percentiles import Code, measure_statistics, percentile_name

PROBABILITIES = (0.0, 0.25, 0.5, 0.95, 1.0)


def expected(values):
    return [float(np.quantile(np.array(values), p)) for p in PROBABILITIES]


def statistics(spark, rows, **kwargs):
    df = spark.createDataFrame(rows, "place string, a double, b double")
    found = measure_statistics(df, ["place"], ["a", "b"], PROBABILITIES, **kwargs)
    return {(r["place"], r["measure"]): r for r in found.collect()}


def checked(row, values):
    assert row["n"] == len(values)
    assert row["min"] == min(values) and row["max"] == max(values)
    assert row["avg"] == pytest.approx(sum(values) / len(values))
    assert [row[percentile_name(p)] for p in PROBABILITIES] == pytest.approx(expected(values))


@pytest.mark.parametrize("bits", [7, 16, 32])
def test_exact_whatever_the_digits(spark, bits):
    rng = random.Random(1)
    # One place and one value hold most rows; another place has a single row.
    rows = [("hot", round(rng.gauss(10, 30), 2), 7.0) for _ in range(900)]
    rows += [("cold", float(rng.randint(-5, 5)), rng.random()) for _ in range(100)] + [("one", -1.5, 2.5)]
    found = statistics(spark, rows, digit_bits=bits)
    for place in ("hot", "cold", "one"):
        for i, measure in enumerate(("a", "b"), 1):
            checked(found[place, measure], [r[i] for r in rows if r[0] == place])


def test_nulls_are_left_out_and_null_groups_stay(spark):
    rows = [("x", 1.0, None), ("x", None, 5.0), ("x", 3.0, 6.0), (None, 2.0, 9.0), (None, 4.0, None)]
    found = statistics(spark, rows)
    checked(found["x", "a"], [1.0, 3.0])
    checked(found["x", "b"], [5.0, 6.0])
    checked(found[None, "a"], [2.0, 4.0])
    checked(found[None, "b"], [9.0])


EXTREMES = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 1.0, -1.0, 1.5, 0.1, 2.0**-1022, 1e308, -1e308, 3.0, 2.0**53 + 2, 1023.9999999999999, 1024.0, 1024.0000000000002]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_codes_keep_order_and_value(spark, kind):
    values = np.array(EXTREMES + [float("inf"), float("-inf")] + list(np.random.default_rng(2).standard_normal(300) * 10.0 ** np.arange(-150, 150)))
    with np.errstate(over="ignore"):
        values = np.unique(values.astype(np.float32 if kind == "float" else np.float64)).astype(float)
    codes = Code.of(T.FloatType() if kind == "float" else T.DoubleType())
    df = codes.encoded(spark.createDataFrame([(float(v),) for v in values], "value double"), "value", "code")
    rows = sorted(df.select("value", "code", codes.decoded(F.col("code")).alias("again")).collect(), key=lambda r: r.value)
    plain = values.astype(np.float32).view(np.int32) if kind == "float" else values.view(np.int64)
    top = -(1 << (31 if kind == "float" else 63))
    assert [r.code for r in rows] == [int(p) if p >= 0 else top - int(p) for p in plain.tolist()]
    assert all(r.again == r.value for r in rows) and all(a.code < b.code for a, b in zip(rows, rows[1:], strict=False))


@pytest.mark.parametrize("values", [[7.25] * 500, [i / 997 for i in range(997)], [10.0 ** (i % 10) + i for i in range(600)], [-(1e9) + i for i in range(300)], EXTREMES[:10] * 3])
def test_values_of_all_sizes(spark, values):
    rows = [("x", v, float(np.float32(v))) for v in values]
    found = statistics(spark, rows)
    checked(found["x", "a"], [r[1] for r in rows])
    checked(found["x", "b"], [r[2] for r in rows])


def test_single_precision_takes_two_levels(spark):
    rng = np.random.default_rng(3)
    rows = [("hot" if i % 3 else f"g{i % 7}", float(np.float32(rng.gamma(2, 30)))) for i in range(3000)] + [(None, 1.5)]
    df = spark.createDataFrame(rows, "place string, a float")
    done = measure_statistics(df, ["place"], ["a"], PROBABILITIES)
    text = plan_of(done)
    # four shuffles of counts, and two for the join of rows with their prefixes where that can't be broadcast
    assert text.count("Exchange hashpartitioning") <= 6 and "Window" not in text and text.count("Scan ExistingRDD") == 2
    for r in done.collect():
        checked(r, [v for p, v in rows if p == r["place"]])


def plan_of(df):
    conf = df.sparkSession.conf
    conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        conf.set("spark.sql.adaptive.enabled", "true")


def test_names():
    assert [percentile_name(p) for p in (0.0, 0.5, 0.95, 0.999, 1.0)] == ["p0", "p50", "p95", "p99_9", "p100"]
