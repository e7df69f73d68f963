from datetime import date

from tiermill.operators import analysis
from tiermill.schemas import GOLD

DAY, BEFORE, OLD = date(2024, 1, 30), date(2024, 1, 29), date(2024, 1, 28)


def gold(spark, *rows):
    return spark.createDataFrame([tuple(r) for r in rows], GOLD)


def test_ties_at_the_cut_go_by_name(spark):
    df = gold(spark, *[(DAY, place, 0, 1.0, 5.0, 1.0) for place in "dbca"], (DAY, "z", 0, 1.0, 9.0, 1.0))
    assert [r["location"] for r in analysis.top_locations(df, DAY, n=3).collect()] == ["z", "a", "b"]


def test_window_is_today_and_yesterday(spark):
    df = gold(spark, (DAY, "a", 0, 1.0, 1.0, 1.0), (BEFORE, "b", 0, 1.0, 2.0, 1.0), (OLD, "c", 0, 1.0, 3.0, 1.0))
    assert [r["location"] for r in analysis.top_locations(df, "2024-01-30").collect()] == ["b", "a"]


def test_missing_means_sort_last(spark):
    df = gold(spark, (DAY, "a", 0, 1.0, None, None), (DAY, "b", 0, 1.0, 2.0, 7.0), (DAY, "c", 0, 1.0, 3.0, 6.0))
    assert [r["location"] for r in analysis.latency_by_location(df).collect()] == ["c", "b", "a"]
    assert [r["location"] for r in analysis.top_locations(df, DAY).collect()] == ["c", "b", "a"]


def test_trend_of_one_location_in_order(spark):
    df = gold(spark, (DAY, "a", 5, 1.0, 2.0, 1.0), (BEFORE, "a", 9, 3.0, 4.0, 1.0), (DAY, "b", 1, 1.0, 1.0, 1.0))
    assert [tuple(r) for r in analysis.hourly_trend(df, "a").collect()] == [(BEFORE, 9, 4.0, 3.0), (DAY, 5, 2.0, 1.0)]


def test_today_and_default_day(spark):
    df = gold(spark, (DAY, "a", 5, 1.0, 2.0, 1.0), (date.today(), "b", 1, 1.0, 1.0, 1.0))
    assert [r["location"] for r in analysis.gold_today(df, DAY).collect()] == ["a"]
    assert analysis.gold_today(df).count() <= 1


def test_weighted_mean_is_the_mean_of_all_samples(spark):
    kpis = spark.createDataFrame(
        [(DAY, "a", 10.0, 1), (DAY, "a", 20.0, 3)], "date date, location string, avg_download_speed double, sample_count long"
    )
    row = analysis.top_locations_weighted(kpis, DAY).first()
    assert (row["avg_dl"], row["sample_count"]) == (17.5, 4)


def test_rows_without_date_come_first(spark):
    df = spark.createDataFrame([(DAY,), (None,), (DAY,)], "date date")
    assert [tuple(r) for r in analysis.date_distribution(df).collect()] == [(None, 1), (DAY, 2)]
