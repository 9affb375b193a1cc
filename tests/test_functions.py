import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeward.functions.days import calendar_date, delivery_date, in_delivery_day
from lakeward.functions.durations import resolution_minutes, slot_end, slot_start
from lakeward.functions.lookups import PRODUCTION_TYPES, WEATHER_CODES, production_type, weather_condition
from lakeward.functions.timestamps import parse_instant, parse_naive_utc


def test_resolution_minutes(spark):
    df = spark.createDataFrame([("PT15M",), ("PT30M",), ("PT60M",)], "r string")
    assert [r[0] for r in df.select(resolution_minutes(F.col("r"))).collect()] == [15, 30, 60]


@pytest.mark.parametrize("bad", ["PT1H", "P1D", "15", ""])
def test_resolution_rejects_other_forms(spark, bad):
    df = spark.createDataFrame([(bad,)], "r string")
    with pytest.raises(Exception, match="Unsupported resolution"):
        df.select(resolution_minutes(F.col("r"))).collect()


def test_slot_arithmetic_keeps_gaps(spark):
    df = spark.createDataFrame([(1,), (2,), (5,)], "pos int").select(
        parse_instant(F.lit("2019-12-31T23:00Z")).alias("s"), "pos")
    s = slot_start(F.col("s"), F.col("pos"), F.lit(30))
    out = df.select(s.alias("a"), slot_end(s, F.lit(30)).alias("b")).collect()
    base = dt.datetime(2019, 12, 31, 23, 0)
    assert [(r.a, r.b) for r in out] == [
        (base, base + dt.timedelta(minutes=30)),
        (base + dt.timedelta(minutes=30), base + dt.timedelta(minutes=60)),
        (base + dt.timedelta(minutes=120), base + dt.timedelta(minutes=150))]


def test_parse_instant_forms(spark):
    df = spark.createDataFrame([("2019-12-31T23:00Z",), ("2020-01-01T00:30:00Z",),
                                ("2020-01-01T01:00+01:00",), (None,)], "s string")
    got = [r[0] for r in df.select(parse_instant(F.col("s"))).collect()]
    assert got == [dt.datetime(2019, 12, 31, 23), dt.datetime(2020, 1, 1, 0, 30),
                   dt.datetime(2020, 1, 1, 0, 0), None]


def test_parse_instant_rejects_garbage(spark):
    df = spark.createDataFrame([("yesterday",)], "s string")
    with pytest.raises(Exception, match="Unparseable instant"):
        df.select(parse_instant(F.col("s"))).collect()


def test_parse_naive_utc(spark):
    df = spark.createDataFrame([("2020-01-01T00:00",)], "s string")
    assert df.select(parse_naive_utc(F.col("s"))).first()[0] == dt.datetime(2020, 1, 1)


def test_delivery_day_boundaries(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 22, 59),), (dt.datetime(2020, 1, 1, 23, 0),),
                                (dt.datetime(2019, 12, 31, 23, 0),)], "ts timestamp")
    out = df.select(delivery_date(F.col("ts")).alias("d"),
                    in_delivery_day(F.col("ts"), F.lit(dt.date(2020, 1, 1))).alias("in"),
                    calendar_date(F.col("ts")).alias("c")).collect()
    assert [(r.d, r["in"]) for r in out] == [(dt.date(2020, 1, 1), True), (dt.date(2020, 1, 2), False),
                                             (dt.date(2020, 1, 1), True)]
    assert out[0].c == dt.date(2020, 1, 1)


def test_lookups_known_unknown_null(spark):
    df = spark.createDataFrame([("B04", 61), ("B99", 4), (None, None)], "c string, w int")
    out = df.select(production_type(F.col("c")).alias("p"),
                    weather_condition(F.col("w")).alias("x")).collect()
    assert [r.p for r in out] == ["Fossil Gas", "Unknown", "Unknown"]
    assert [(r.x.main, r.x.description) for r in out] == [
        ("Rain", "slight rain"), ("Unknown", "unknown"), ("Unknown", "unknown")]


def test_lookup_sizes():
    assert len(PRODUCTION_TYPES) == 21 and len(WEATHER_CODES) == 28


def test_calendar_day_window(spark):
    from lakeward.functions.days import in_calendar_day, ingest_date
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 0, 0),), (dt.datetime(2020, 1, 1, 23, 59, 59),),
                                (dt.datetime(2020, 1, 2, 0, 0),), (dt.datetime(2019, 12, 31, 23, 0),)],
                               "ts timestamp")
    day = ingest_date(1, dt.date(2020, 1, 2))
    got = [r[0] for r in df.select(in_calendar_day(F.col("ts"), day)).collect()]
    assert got == [True, True, False, False]
