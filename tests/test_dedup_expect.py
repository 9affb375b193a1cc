import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeward.operators.dedup import dedup_latest, merge_latest
from lakeward.operators.expectations import drop_failing, merge_rules, rule_metrics

T = dt.datetime(2020, 1, 1)
SCHEMA = "zone string, start timestamp, price double, fetched_at timestamp"


def rows(df):
    return sorted((tuple(r) for r in df.collect()),
                  key=lambda t: tuple((x is not None, x if x is not None else 0) for x in t))


def test_latest_fetch_wins_and_null_loses(spark):
    df = spark.createDataFrame([
        ("Z", T, 1.0, T), ("Z", T, 2.0, T + dt.timedelta(hours=1)), ("Z", T, 3.0, None),
        ("Z", T + dt.timedelta(hours=1), 4.0, None)], SCHEMA)
    out = rows(dedup_latest(df, ["zone", "start"]))
    assert out == [("Z", T, 2.0, T + dt.timedelta(hours=1)),
                   ("Z", T + dt.timedelta(hours=1), 4.0, None)]


def test_null_keys_collapse_into_one_group(spark):
    df = spark.createDataFrame([("Z", None, 1.0, T), ("Z", None, 2.0, T + dt.timedelta(1))], SCHEMA)
    assert rows(dedup_latest(df, ["zone", "start"])) == [("Z", None, 2.0, T + dt.timedelta(1))]


def test_dedup_plan_limits_before_shuffle(spark):
    df = spark.createDataFrame([("Z", T, 1.0, T)], SCHEMA)
    plan = dedup_latest(df, ["zone", "start"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["A", "B", None]), st.integers(0, 3),
                          st.integers(0, 5), st.one_of(st.none(), st.integers(0, 4))),
                min_size=1, max_size=30),
       st.integers(0, 30))
def test_incremental_merge_equals_full_recompute(spark, data, cut):
    recs = [(z, T + dt.timedelta(hours=h), float(p), None if f is None else T + dt.timedelta(days=f))
            for z, h, p, f in data]
    df = spark.createDataFrame(recs, SCHEMA)
    keys = ["zone", "start"]
    old = spark.createDataFrame(recs[:cut], SCHEMA)
    new = spark.createDataFrame(recs[cut:], SCHEMA)
    full = dedup_latest(df, keys)
    inc = merge_latest(dedup_latest(old, keys), new, keys)
    assert rows(inc) == rows(full)
    assert rows(dedup_latest(full, keys)) == rows(full)        # idempotent


RULES = {"valid_price": "price IS NOT NULL", "non_negative_price": "price >= 0"}


def test_rule_metrics_counts_null_as_failed(spark):
    df = spark.createDataFrame([("Z", T, 1.0, T), ("Z", T, -1.0, T), ("Z", T, None, T)], SCHEMA)
    m = {r.expectation: (r.passed_records, r.failed_records)
         for r in rule_metrics(df, RULES, "silver").collect()}
    assert m == {"valid_price": (2, 1), "non_negative_price": (1, 2)}


def test_drop_severity(spark):
    df = spark.createDataFrame([("Z", T, 1.0, T), ("Z", T, -1.0, T), ("Z", T, None, T)], SCHEMA)
    assert [r.price for r in drop_failing(df, RULES).collect()] == [1.0]


def test_merge_rules_later_wins():
    assert merge_rules({"a": "x", "b": "y"}, {"b": "z"}) == {"a": "x", "b": "z"}


def test_hot_key_holding_a_third_of_rows(spark):
    n = 90_000
    df = (spark.range(n).repartition(16)
          .selectExpr("CASE WHEN id % 3 = 0 THEN 'HOT' ELSE CAST(id AS STRING) END AS zone",
                      "TIMESTAMP '2020-01-01 00:00:00' AS start",
                      "CAST(id AS DOUBLE) AS price",
                      "TIMESTAMP '2020-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS fetched_at"))
    out = dedup_latest(df, ["zone", "start"])
    assert out.count() == n - n // 3 + 1                     # every cold key + one hot row
    hot = out.filter("zone = 'HOT'").first()
    assert hot.price == float(n - 3)                          # the latest fetch of the hot key
