import random

from pyspark.sql import functions as F

from tiermill.operators.cleaning import COPIES, clean, dedup
from tiermill.operators.hourly import gold_hourly
from tiermill.operators.parsing import add_date
from tiermill.operators.quality import quality_report
from tiermill.schemas import EVENT
from verification import inputs


def brute_force(rows):
    best = {}
    for row in rows:
        key = (row["user_id"], row["timestamp"])
        rest = tuple(row[c] for c in row.__fields__ if c not in ("user_id", "timestamp"))
        if key not in best or rest < best[key]:
            best[key] = rest
    return {(*k, *v) for k, v in best.items()}


def hot_key_rows(spark, n=3000):
    """A third of all rows are copies of one key, and they differ."""
    rng = random.Random(7)
    hot = [(1704067200000, "hot", 5.0, 5.0, float(rng.randint(1, 90)), "London") for _ in range(n // 3)]
    rest = [
        (1704067200000 + rng.randint(0, 10**8), f"u{rng.randint(1, 40)}", 1.0, float(rng.randint(1, 9)), 2.0, "Paris")
        for _ in range(n - n // 3)
    ]
    rows = hot + rest
    rng.shuffle(rows)
    return add_date(spark.createDataFrame(rows, EVENT))


def test_smallest_copy_survives_also_under_skew(spark):
    df = hot_key_rows(spark)
    survivors = dedup(df)
    got = {(r["user_id"], r["timestamp"], *[r[c] for c in df.columns if c not in ("user_id", "timestamp")]) for r in survivors.collect()}
    assert got == brute_force(df.collect())
    assert survivors.columns == df.columns


def test_row_order_does_not_matter(spark):
    df = hot_key_rows(spark)
    one = sorted(map(tuple, dedup(df).collect()))
    other = sorted(map(tuple, dedup(df.repartition(5).orderBy(F.rand(3))).collect()))
    assert one == other


def test_copies_are_counted(spark):
    df = hot_key_rows(spark)
    counted = dedup(df, count_copies=True)
    assert counted.agg(F.sum(COPIES)).first()[0] == df.count()
    assert counted.where("user_id = 'hot'").first()[COPIES] == 1000


def test_silver_is_a_unique_clean_part_of_bronze(spark, sf_dir):
    bronze = inputs.bronze_view(spark, sf_dir)
    silver = clean(bronze)
    assert silver.groupBy("user_id", "timestamp").count().where("count > 1").count() == 0
    assert silver.subtract(bronze).count() == 0
    assert silver.dropna().count() == silver.count()
    assert clean(silver).subtract(silver).count() == 0


def test_gold_counts_add_up(spark, sf_dir):
    silver = inputs.silver_view(spark, sf_dir)
    from tiermill.operators.hourly import gold_kpis

    kpis = gold_kpis(silver)
    assert kpis.agg(F.sum("sample_count")).first()[0] == silver.count()
    assert kpis.count() == gold_hourly(silver).count()


def test_quality_report_accounts_for_every_row(spark):
    df = hot_key_rows(spark).unionByName(
        add_date(spark.createDataFrame([(None,) * 6] * 2000 + [(1, "x", float("nan"), 1.0, 1.0, "P")], EVENT))
    )
    report = quality_report(df).first()
    assert report["rows_in"] == 5001
    assert report["malformed"] == 2000
    assert report["missing_upload_speed"] == 2001
    assert report["rejected"] == 2001
    assert report["survivors"] == dedup(hot_key_rows(spark)).count()
    assert report["rejected"] + report["duplicates"] + report["survivors"] == report["rows_in"]


def test_quality_report_of_nothing(spark):
    report = quality_report(add_date(spark.createDataFrame([], EVENT))).first()
    assert all(value == 0 for value in report)
