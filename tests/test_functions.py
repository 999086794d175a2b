"""Scalar functions: offsets, time parsing, zone independence, exact rounding."""
import datetime as dt
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from contrail.functions.arith import mean_minutes_2dp, percentage_2dp
from contrail.functions.offsets import utc_offset_hours
from contrail.functions.times import (
    block_date, block_hour_text, delay_seconds, parse_local_time, parse_utc_time,
    previous_day_block_4h, time_block_4h,
)

OFFSETS = [("+01:00", 1.0), ("-05:00", -5.0), ("+05:30", 5.5), ("-03:30", -3.5),
           ("+2:30", 2.5), ("+0530", 5.5), ("+01", 1.0), ("1", 1.0), ("00:00", 0.0),
           ("Z", 0.0), ("", None), (None, None), ("abc", None), ("+123:00", None),
           ("-00:00", 0.0)]


def test_utc_offset_hours(spark):
    df = spark.createDataFrame(OFFSETS, "t string, want double")
    got = df.select("t", "want", utc_offset_hours("t").alias("got")).collect()
    for r in got:
        assert r.got == r.want, (r.t, r.got, r.want)


def test_parse_times_strict(spark):
    rows = [("2024-03-31T02:30", "2024-03-31T00:30Z"), ("garbage", "2024-03-31T02:30:00Z"),
            ("2024-02-30T10:00", "2024-02-30T10:00Z"), (None, None),
            ("2024-03-31T02:30Z", "2024-03-31T02:30")]
    df = spark.createDataFrame(rows, "l string, u string")
    got = df.select(parse_local_time("l").alias("l"), parse_utc_time("u").alias("u")).collect()
    assert got[0].l == dt.datetime(2024, 3, 31, 2, 30) and got[0].u == dt.datetime(2024, 3, 31, 0, 30)
    assert all(r.l is None and r.u is None for r in got[1:])
    assert dict(df.select(parse_local_time("l").alias("x")).dtypes)["x"] == "timestamp_ntz"


@pytest.mark.parametrize("zone", ["UTC", "Europe/Berlin", "America/Sao_Paulo"])
def test_delay_and_hour_ignore_session_zone(spark, zone):
    """01:30Z -> 03:10Z across the Berlin DST switch is 100 minutes in any session zone."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([("2024-03-31T01:30Z", "2024-03-31T03:10Z",
                                     "2024-03-31T02:30")], "s string, a string, loc string")
        r = df.select(delay_seconds(parse_utc_time("a"), parse_utc_time("s")).alias("d"),
                      F.hour(parse_local_time("loc")).alias("h"),
                      time_block_4h(parse_local_time("loc")).alias("b")).first()
        assert r.d == 6000 and r.h == 2 and r.b == "2024-03-31T00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_delay_floors_each_side(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 0, 0, 900000),
                                 dt.datetime(2024, 1, 1, 10, 1, 0, 100000))], "s timestamp_ntz, a timestamp_ntz")
    assert df.select(delay_seconds("a", "s")).first()[0] == 60


def test_blocks(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 5),), (dt.datetime(2024, 1, 1, 23, 59),)],
                               "ts timestamp_ntz")
    got = df.select(time_block_4h("ts").alias("b"), previous_day_block_4h("ts").alias("p")).collect()
    assert [(r.b, r.p) for r in got] == [("2024-01-01T00:00", "2023-12-31T00:00"),
                                         ("2024-01-01T20:00", "2023-12-31T20:00")]
    b = spark.createDataFrame([("2024-05-06T04:00",)], "b string")
    r = b.select(block_date("b").alias("d"), block_hour_text("b").alias("h")).first()
    assert r.d == dt.date(2024, 5, 6) and r.h == "04"


def _half_up(x: Fraction) -> Fraction:
    sign = -1 if x < 0 else 1
    return sign * Fraction(int(abs(x) * 100 + Fraction(1, 2)), 100)


def test_exact_mean_and_percentage_against_fractions(spark):
    pairs = [(s, n) for n in range(1, 13) for s in range(-1500, 1500, 7)]
    df = spark.createDataFrame(pairs, "s long, n long")
    got = df.select("s", "n", mean_minutes_2dp(F.col("s"), F.col("n")).alias("m")).collect()
    for r in got:
        assert r.m == float(_half_up(Fraction(r.s, 60 * r.n))), (r.s, r.n, r.m)
    pct = [(d, t) for t in range(0, 70) for d in range(0, t + 1)]
    df = spark.createDataFrame(pct, "d long, t long")
    for r in df.select("d", "t", percentage_2dp(F.col("d"), F.col("t")).alias("p")).collect():
        want = 0.0 if r.t == 0 else float(_half_up(Fraction(100 * r.d, r.t)))
        assert r.p == want, (r.d, r.t, r.p)
    assert spark.createDataFrame([(0, 0)], "s long, n long").select(
        mean_minutes_2dp(F.col("s"), F.col("n"))).first()[0] is None


def test_small_negative_mean_is_positive_zero(spark):
    import math
    v = spark.createDataFrame([(-1, 100)], "s long, n long").select(
        mean_minutes_2dp(F.col("s"), F.col("n"))).first()[0]
    assert v == 0.0 and math.copysign(1.0, v) == 1.0


def test_deep_get_and_top_level(spark):
    from contrail.functions.jsonpath import deep_get, top_level
    df = spark.createDataFrame([('{"a":{"b":{"c":"x"}},"d":[1,2]}',), ('{"a":{}}',), ("{bad",)],
                               "raw string")
    got = df.select(deep_get("raw", "a", "b", "c").alias("v"),
                    deep_get("raw", "a", "b", "c", default=F.lit("dflt")).alias("w"),
                    top_level("raw").alias("m")).collect()
    assert [r.v for r in got] == ["x", None, None]
    assert [r.w for r in got] == ["x", "dflt", "dflt"]
    assert got[0].m == {"a": '{"b":{"c":"x"}}', "d": "[1,2]"} and got[2].m is None
