import math
from datetime import date

import pytest
from pyspark.sql import functions as F

from tiermill.operators.cleaning import drop_nulls
from tiermill.operators.parsing import add_date, add_date_if_missing, add_hour, parse_messages
from tiermill.schemas import EVENT, MESSAGE
from tiermill.sinks.messages import encode_messages

GOOD = (1721414400000, "u1", 1.5, 2.5, 3.5, "London")
NOTHING = (None,) * 6


def changed(**fields):
    return tuple(fields.get(name, value) for name, value in zip(EVENT.fieldNames(), GOOD, strict=True))


CASES = {
    "good": ('{"timestamp":1721414400000,"user_id":"u1","upload_speed":1.5,"download_speed":2.5,"latency":3.5,"location":"London"}', GOOD),
    "extra field": ('{"x":1,"timestamp":1721414400000,"user_id":"u1","upload_speed":1.5,"download_speed":2.5,"latency":3.5,"location":"London"}', GOOD),
    "missing field": ('{"timestamp":1721414400000,"user_id":"u1","download_speed":2.5,"latency":3.5,"location":"London"}', changed(upload_speed=None)),
    "wrong type": ('{"timestamp":1721414400000,"user_id":"u1","upload_speed":"abc","download_speed":2.5,"latency":3.5,"location":"London"}', changed(upload_speed=None)),
    "quoted number": ('{"timestamp":1721414400000,"user_id":"u1","upload_speed":"45.2","download_speed":2.5,"latency":3.5,"location":"London"}', changed(upload_speed=None)),
    "fractional timestamp": ('{"timestamp":1721414400000.5,"user_id":"u1","upload_speed":1.5,"download_speed":2.5,"latency":3.5,"location":"London"}', changed(timestamp=None)),
    "quoted timestamp": ('{"timestamp":"1721414400000","user_id":"u1","upload_speed":1.5,"download_speed":2.5,"latency":3.5,"location":"London"}', changed(timestamp=None)),
    "numeric user": ('{"timestamp":1721414400000,"user_id":5,"upload_speed":1.5,"download_speed":2.5,"latency":3.5,"location":"London"}', changed(user_id="5")),
    "not json": ("not json", NOTHING),
    "array": ('[{"timestamp":1721414400000}]', None),
    "empty": ("", NOTHING),
    "no value": (None, NOTHING),
}


def messages(spark, values):
    rows = [(None, None if v is None else v.encode(), "t", 0, i, None, 0) for i, v in enumerate(values)]
    return spark.createDataFrame([(k, bytearray(v) if v is not None else None, *rest) for k, v, *rest in rows], MESSAGE)


@pytest.mark.parametrize("case", sorted(CASES))
def test_one_message_one_row(spark, case):
    value, expected = CASES[case]
    rows = parse_messages(messages(spark, [value])).collect()
    assert len(rows) == 1
    if expected is not None:
        assert tuple(rows[0]) == expected
    else:
        assert rows[0]["user_id"] is None


def test_nan_is_kept_by_parsing_and_dropped_by_cleaning(spark):
    value = CASES["good"][0].replace("1.5", "NaN")
    parsed = parse_messages(messages(spark, [value]))
    assert math.isnan(parsed.first()["upload_speed"])
    assert drop_nulls(parsed).count() == 0


def test_only_whole_events_survive_cleaning(spark):
    bronze = add_date(parse_messages(messages(spark, [v for v, _ in CASES.values()])))
    assert drop_nulls(bronze).count() == 3  # good, extra field, numeric user
    assert {r["user_id"] for r in drop_nulls(bronze).collect()} == {"u1", "5"}


def test_explicit_null_filter_equals_dropna(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1L, 'a', float(1)), (NULL, 'b', float(1)), (2L, NULL, float(1)), (3L, 'c', NULL),"
        " (4L, 'd', float('NaN')) AS t(timestamp, user_id, latency)"
    )
    assert drop_nulls(df).collect() == df.dropna().collect()


def test_lineage_columns(spark):
    parsed = parse_messages(messages(spark, ["not json", CASES["good"][0]]), lineage=True)
    assert parsed.columns[-4:] == ["_topic", "_partition", "_offset", "_ingest_ts"]
    assert sorted(r["_offset"] for r in parsed.collect()) == [0, 1]


def test_unit_of_the_epoch_number(spark):
    df = spark.createDataFrame([(1721414400000,)], "timestamp long")
    row = add_hour(add_date(df)).first()
    assert (row["date"], row["hour"]) == (date(2024, 7, 19), 18)
    as_seconds = add_hour(add_date(df, "s"), "s").select(F.col("date").cast("string"), "hour").first()
    assert tuple(as_seconds) == ("+56519-06-14", 18)


@pytest.mark.parametrize("unit", ["ms", "s"])
def test_epoch_number_out_of_range_is_null_not_an_error(spark, unit):
    df = spark.createDataFrame([((1 << 63) - 1,), (-(1 << 63),), (None,)], "timestamp long")
    assert [r["date"] for r in add_date(df, unit).collect()] == [None, None, None]


def test_date_is_kept_where_present(spark):
    df = spark.createDataFrame([(1721414400000, date(2000, 1, 1))], "timestamp long, date date")
    assert add_date_if_missing(df).first()["date"] == date(2000, 1, 1)
    assert add_date_if_missing(df.drop("date")).first()["date"] == date(2024, 7, 19)


def test_encode_then_parse_gives_the_event_back(spark):
    df = spark.createDataFrame([GOOD, changed(latency=None), changed(upload_speed=0.1)], EVENT)
    back = parse_messages(encode_messages(df))
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
