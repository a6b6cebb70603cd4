import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wattlake.functions import numeric, text, timekeys


def at(hour, minute, second=0):
    return dt.datetime(2024, 1, 5, hour, minute, second)


def one(df):
    return df.first()[0]


def test_bucket_edges(spark):
    minutes = [0, 1, 15, 16, 30, 31, 45, 46, 59]
    df = spark.createDataFrame([(m, at(7, m, 59)) for m in minutes], "m int, ts timestamp_ntz")
    got = dict(df.select("m", timekeys.quarter_hour(F.col("ts"))).collect())
    assert [got[m] for m in minutes] == [0, 0, 0, 15, 15, 30, 30, 45, 45]


def test_bucket_start_keeps_the_hour(spark):
    df = spark.createDataFrame([(at(7, 0),), (at(7, 15),), (at(7, 59),)], "ts timestamp_ntz")
    starts = sorted(r[0] for r in df.select(timekeys.bucket_start(F.col("ts"))).collect())
    assert starts == [at(7, 0), at(7, 0), at(7, 45)]


@pytest.mark.parametrize(
    "values, expected",
    [([1, 2, -4, None], 0), ([-1, -2], -1), ([7, 8], 7), ([None], None), ([], None)],
)
def test_integer_average(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    assert one(df.agg(numeric.int_avg(F.col("x")))) == expected


def test_integer_average_does_not_overflow(spark):
    df = spark.range(10).select(F.lit(2_147_483_647).alias("x"))
    assert one(df.agg(numeric.int_avg(F.col("x")))) == 2_147_483_647


@pytest.mark.parametrize(
    "values, expected",
    [([2500], 3), ([2499], 2), ([500], 1), ([499], 0), ([-500], -1), ([-499], 0),
     ([2499, 2500], 2), ([2500, 2500, None], 3), ([None], None)],
)
def test_rounded_watts(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "x int")
    assert one(df.agg(numeric.rounded_mean(F.col("x"), 1000))) == expected


@settings(max_examples=25, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-(10**6), 10**6), min_size=1, max_size=8))
def test_averages_against_exact_arithmetic(spark, values):
    from fractions import Fraction

    df = spark.createDataFrame([(v,) for v in values], "x int")
    cut, rounded = df.agg(
        numeric.int_avg(F.col("x")), numeric.rounded_mean(F.col("x"), 1000)
    ).first()
    mean = Fraction(sum(values), len(values))
    assert cut == int(mean)
    shifted = abs(mean) / 1000 + Fraction(1, 2)
    size = shifted.numerator // shifted.denominator
    assert rounded == (size if mean >= 0 else -size)


def test_hour_keys(spark):
    df = spark.createDataFrame([(at(7, 59),)], "ts timestamp_ntz")
    ts = F.col("ts")
    assert df.select(timekeys.hour_key(ts), timekeys.hour_key_int(ts), timekeys.hour_text(ts)).first()[
        :
    ] == (2024010507, 2024010507, "2024010507")


def test_int_hour_key_overflow_raises(spark):
    df = spark.createDataFrame([(dt.datetime(2148, 1, 1),)], "ts timestamp_ntz")
    assert one(df.select(timekeys.hour_key(F.col("ts")))) == 2148010100
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        df.select(timekeys.hour_key_int(F.col("ts"))).collect()


def test_labels(spark):
    df = spark.createDataFrame([(at(13, 0),), (at(0, 0),)], "ts timestamp_ntz")
    got = df.select(timekeys.hour_label(F.hour("ts"), F.col("ts"))).collect()
    assert [r[0] for r in got] == ["13 (01:00 PM)", "0 (12:00 AM)"]
    assert one(df.select(timekeys.day_label(F.lit("2024010513")))) == "20240105"


@pytest.mark.parametrize(
    "day, week",
    [("2017-01-01", 1), ("2017-01-07", 1), ("2017-01-08", 2), ("2016-01-02", 1),
     ("2016-01-03", 2), ("2016-12-31", 53), ("2024-12-31", 53)],
)
def test_weeks_start_on_sunday(spark, day, week):
    assert one(spark.range(1).select(timekeys.week_of_year(F.to_date(F.lit(day))))) == week


def test_match_key_folds_and_keeps_null(spark):
    df = spark.createDataFrame(
        [("FW_A ", "x"), ("fw_a", "X"), ("fw_a", None), (" fw_a", "x")], "a string, b string"
    )
    keys = [r[0] for r in df.select(text.match_key(F.col("a"), F.col("b"))).collect()]
    assert keys[0] == keys[1]
    assert keys[2] is None
    assert keys[3] != keys[0]
    safe = [r[0] for r in df.select(text.null_safe_key(F.col("a"), F.col("b"))).collect()]
    assert safe[2] is not None and len(set(safe)) == 3


def test_base64_alphabets(spark):
    import base64

    body = bytes(range(256))
    df = spark.createDataFrame(
        [(base64.b64encode(body).decode(), base64.urlsafe_b64encode(body).decode())],
        "plain string, url string",
    )
    a, b = df.select(text.decode_base64(F.col("plain")), text.decode_base64_url(F.col("url"))).first()
    assert bytes(a) == body and bytes(b) == body


def test_millis_become_local_time(spark):
    df = spark.createDataFrame([(1_701_388_861_999,)], "ms long")
    utc = one(df.select(text.local_time_of_millis(F.col("ms"))))
    assert utc.replace(microsecond=0) == dt.datetime(2023, 12, 1, 0, 1, 1)
    local = one(df.select(text.local_time_of_millis(F.col("ms"), "America/Chicago")))
    assert local.replace(microsecond=0) == dt.datetime(2023, 11, 30, 18, 1, 1)
