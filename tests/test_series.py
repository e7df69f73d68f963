from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tiermill.functions.thresholds import FRESHNESS_STEPS, QUALITY_STEPS, RATE_STEPS, ROW_COUNT_STEPS, classify
from tiermill.operators import series as S
from tiermill.schemas import METRICS
from tiermill.sources import metrics as M

START = datetime(2024, 1, 1)


def samples(spark, metric, points, series="s", job=None, query=None):
    rows = [(metric, series, job, query, START + timedelta(seconds=t), float(v)) for t, v in points]
    return spark.createDataFrame(rows, METRICS)


def rates(df, metric, window, **kwargs):
    found = S.counter_rate(df, metric, window, **kwargs)
    return {(r["series"], int((r["ts"] - START).total_seconds())): r["rate"] for r in found.collect()}


def brute_force(points, window):
    points = sorted(points)
    out = {}
    for t, _ in points:
        inside = [(s, v) for s, v in points if t - window <= s <= t]
        if len(inside) < 2:
            out[t] = None
            continue
        grown = sum(b if b < a else b - a for (_, a), (_, b) in zip(inside, inside[1:]))
        out[t] = grown / (inside[-1][0] - inside[0][0])
    return out


WORKED = [(0, 0), (30, 10), (60, 40), (90, 5), (120, 20), (600, 21)]


@pytest.mark.parametrize("slice_seconds", [60, 120, 3600])
def test_worked_case(spark, slice_seconds):
    found = rates(samples(spark, "c", WORKED), "c", 60, slice_seconds=slice_seconds)
    want = {0: None, 30: 1 / 3, 60: 2 / 3, 90: 35 / 60, 120: 1 / 3, 600: None}
    assert {t: found["s", t] for t in want} == pytest.approx(want)


@pytest.mark.parametrize("slice_seconds", [300, 700, 3600])
def test_slices_change_nothing(spark, slice_seconds):
    points = [(t, (t * 7) % 97) for t in range(0, 5000, 13)]
    other = [(t, t) for t in range(5, 2000, 50)]
    df = samples(spark, "c", points).unionByName(samples(spark, "c", other, series="o"))
    found = rates(df, "c", 300, slice_seconds=slice_seconds)
    want = {("s", t): v for t, v in brute_force(points, 300).items()} | {
        ("o", t): v for t, v in brute_force(other, 300).items()
    }
    assert found == pytest.approx(want)


def test_times_before_the_epoch(spark):
    points = [(t - 1704067200, t) for t in range(-200, 200, 10)]
    found = rates(samples(spark, "c", points), "c", 60, slice_seconds=60)
    assert found["s", points[-1][0]] == pytest.approx(1.0)
    assert len(found) == len(points)


def test_repeated_samples_count_once(spark):
    once = samples(spark, "c", WORKED)
    assert rates(once.unionByName(once).unionByName(once), "c", 60) == rates(once, "c", 60)


def on_grid(df, column, *labels):
    """Values by label and second, or by second alone."""
    keyed = {(*[r[x] for x in labels], int((r["ts"] - START).total_seconds())): r[column] for r in df.collect()}
    return keyed if labels else {t: v for (t,), v in keyed.items()}


def test_throughput_of_series_that_are_sampled_apart(spark):
    """Two counters at 10 per second each, seven seconds apart: 20 at every time that both reach."""
    one = samples(spark, "c", [(t, 10 * t) for t in range(0, 301, 30)])
    two = samples(spark, "c", [(t, 10 * t) for t in range(7, 301, 30)], series="o")
    found = on_grid(S.throughput_total(one.unionByName(two), "c"), "rate")
    assert {t: v for t, v in found.items() if 67 <= t <= 300} == pytest.approx({t: 20.0 for t in range(75, 301, 15)})


@pytest.mark.parametrize("slice_seconds", [60, 240, 3600])
def test_rates_on_the_grid_equal_brute_force(spark, slice_seconds):
    points = [(t, (t * 7) % 97) for t in range(-40, 900, 13)]
    found = on_grid(S.rate_on_grid(samples(spark, "c", points), "c", 60, 15, slice_seconds), "rate")
    want = {}
    for t in range(-45, 990, 15):
        inside = [(s, v) for s, v in points if t - 60 <= s <= t]
        if len(inside) > 1:
            grown = sum(b if b < a else b - a for (_, a), (_, b) in zip(inside, inside[1:]))
            want[t] = grown / (inside[-1][0] - inside[0][0])
    assert found == pytest.approx(want)


def test_avg_by_label(spark):
    df = samples(spark, "d", [(0, 2), (20, 6)], "a", job="j1").unionByName(samples(spark, "d", [(7, 4)], "b", job="j1"))
    df = df.unionByName(samples(spark, "d", [(0, 9)], "a", job="j2"))
    found = on_grid(S.avg_by_label(df, "d", "job_id", lookback_seconds=60), "value", "job_id")
    assert [found["j1", t] for t in (0, 15, 30, 60, 75)] == [2.0, 3.0, 5.0, 5.0, 6.0]
    assert found["j2", 60] == 9.0 and ("j2", 75) not in found and ("j1", 90) not in found


@pytest.mark.parametrize(
    ("bronze", "silver", "pct", "colour"),
    [(0, 0, None, None), (100, 79, 79.0, "red"), (100, 80, 80.0, "yellow"), (100, 95, 95.0, "green")],
)
def test_quality_pct(spark, bronze, silver, pct, colour):
    """Silver is sampled four seconds after bronze."""
    df = samples(spark, M.BRONZE_ROWS, [(0, bronze)]).unionByName(samples(spark, M.SILVER_ROWS, [(4, silver)]))
    rows = S.metric_status(S.quality_pct(df, lookback_seconds=30), "quality_pct", QUALITY_STEPS).orderBy("ts").collect()
    assert [(r["quality_pct"], r["status"]) for r in rows] == [(pct, colour)] * 2


@pytest.mark.parametrize(
    ("steps", "value", "colour"),
    [
        (ROW_COUNT_STEPS, 79.9, "green"),
        (ROW_COUNT_STEPS, 80.0, "red"),
        (RATE_STEPS, 49.0, "green"),
        (RATE_STEPS, 50.0, "yellow"),
        (RATE_STEPS, 80.0, "red"),
        (FRESHNESS_STEPS, 299.0, "green"),
        (FRESHNESS_STEPS, 300.0, "red"),
        (RATE_STEPS, None, None),
    ],
)
def test_thresholds(spark, steps, value, colour):
    assert spark.range(1).select(classify(F.lit(value).cast("double"), steps)).first()[0] == colour


def test_latest_takes_the_newest(spark):
    df = samples(spark, M.BRONZE_ROWS, [(0, 100), (60, 5), (30, 50)])
    row = M.latest_values(df, [M.BRONZE_ROWS]).first()
    assert (row["value"], row["ts"]) == (5.0, START + timedelta(seconds=60))


def test_time_range_includes_both_ends(spark):
    df = samples(spark, "c", [(0, 1), (1, 1), (3600, 1), (3601, 1)])
    assert M.time_range(df, "2024-01-01 01:00:00").count() == 3


def test_timeline_and_health(spark):
    df = samples(spark, M.BRONZE_ROWS, [(0, 10), (20, 90), (40, 95)]).unionByName(samples(spark, M.SILVER_ROWS, [(10, 8)]))
    timeline = {r["ts"]: (r[M.BRONZE_ROWS], r[M.SILVER_ROWS], r[M.GOLD_ROWS]) for r in S.metric_timeline(df).collect()}
    assert timeline == {START: (90.0, 8.0, None), START + timedelta(seconds=30): (95.0, None, None)}
    health = S.pipeline_health(df).first()
    assert (health[f"{M.BRONZE_ROWS}_status"], health[f"{M.SILVER_ROWS}_status"]) == ("red", "green")
    assert health[f"{M.GOLD_ROWS}_status"] is None


def test_freshness(spark):
    df = samples(spark, M.LAST_UPDATE, [(0, 1704067200), (30, 1704067230)])
    assert S.freshness_seconds(df, "2024-01-01 00:06:00").first()["freshness_s"] == 330


# --- panes


def grid_of(points, step, reach):
    last = max(t for t, _ in points) + reach
    return range(-(-min(t for t, _ in points) // step) * step, int(last) + 1, step)


@pytest.mark.parametrize(("step", "window", "slice_seconds"), [(15, 60, 3600), (10, 30, 60), (10, 10, 30), (15, 45, 45), (20, 50, 120)])
def test_rates_from_panes_are_those_of_the_samples(spark, step, window, slice_seconds):
    import random

    rng = random.Random(step + window)
    every, rows = {"a": 1, "b": 7, "c": 40}, {}
    for name, gap in every.items():
        t, value, points = rng.randrange(5), 0, []
        while t < 900:
            points.append((t, value))
            t += rng.randint(1, 2 * gap)
            value = 0 if rng.random() < 0.05 else value + rng.randrange(9)
        rows[name] = points
    df = None
    for name, points in rows.items():
        part = samples(spark, "c", points, series=name)
        df = part if df is None else df.unionByName(part)
    found = {(r["series"], int((r["ts"] - START).total_seconds())): r["rate"] for r in S.rate_on_grid(df, "c", window, step, slice_seconds).collect()}
    want = {}
    for name, points in rows.items():
        # an increase counts if the sample before it is at most a window older, or in the same slice of time
        length = max(slice_seconds, window)
        grown = {}
        for (s, a), (t, b) in zip(points, points[1:], strict=False):
            grown[t] = 0 if t - s > window and s // length != t // length else b if b < a else b - a
        for t in grid_of(points, step, window):
            inside = [s for s, _ in points if t - window <= s <= t]
            if len(inside) > 1:
                want[name, t] = sum(grown[s] for s in inside[1:]) / (inside[-1] - inside[0])
    assert found == pytest.approx(want)


@pytest.mark.parametrize(("step", "lookback", "slice_seconds"), [(15, 300, 3600), (10, 25, 60), (30, 10, 60), (10, 60, 30)])
def test_values_from_panes_are_those_of_the_samples(spark, step, lookback, slice_seconds):
    import random

    rng = random.Random(step * lookback)
    rows = {name: [(t, rng.randrange(99)) for t in sorted(rng.sample(range(1500), n))] for name, n in (("a", 700), ("b", 40), ("c", 3))}
    df = None
    for name, points in rows.items():
        part = samples(spark, "v", points, series=name, job="j" if name == "b" else None)
        df = part if df is None else df.unionByName(part)
    found = {(r["series"], int((r["ts"] - START).total_seconds())): r["value"] for r in S.value_on_grid(df, ["v"], step, lookback, slice_seconds).collect()}
    want = {}
    for name, points in rows.items():
        for t in grid_of(points, step, lookback):
            inside = [(s, v) for s, v in points if t - lookback <= s <= t]
            if inside:
                want[name, t] = inside[-1][1]
    assert found == want


def test_panes_are_shuffled_and_not_samples(spark):
    """A thousand samples a step: what is shuffled are partial panes and, at most twice, panes."""
    points = [(t / 50, t) for t in range(50 * 120)]
    df = samples(spark, "v", points)
    text = S.value_on_grid(df, ["v"])._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 2 and text.index("Generate") < text.index("partial_max")
