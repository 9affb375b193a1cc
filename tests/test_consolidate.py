import datetime as dt
import json

from pyspark.sql import functions as F

from lakeward.operators.consolidate import consolidate, fail_pct
from lakeward.operators.merge import empty_history, merge_history
from lakeward.sources.event_logs import EVENT_LOG_SCHEMA

T = dt.datetime(2024, 1, 10, 12, 0)


def details(*counters):
    return json.dumps({"flow_progress": {"data_quality": {"expectations": [
        {"dataset": d, "name": n, "passed_records": p, "failed_records": f}
        for d, n, p, f in counters]}}})


def log(spark, events):
    rows = [((u,), ts, et, det, "flow") for u, ts, et, det in events]
    return spark.createDataFrame(rows, EVENT_LOG_SCHEMA)


def by_key(df):
    return {(r.pipeline_name, r.update_id, r.table_name, r.expectation):
            (r.passed_records, r.failed_records, r.fail_pct) for r in df.collect()}


def test_micro_batches_sum_and_noise_ignored(spark):
    logs = {"p": log(spark, [
        ("u1", T, "flow_progress", details(("t", "r", 9, 1))),
        ("u1", T + dt.timedelta(minutes=1), "flow_progress", details(("t", "r", 5, 5))),
        ("u1", T, "user_action", details(("t", "r", 100, 100))),                 # other type
        ("u1", T, "flow_progress", json.dumps({"flow_progress": {"metrics": {}}})),  # no DQ
        ("u1", T, "flow_progress", '{"flow_progress": {"data_quality": {'),      # broken
        ("u2", T, "flow_progress", details(("t", "r", 0, 0))),                   # zero records
    ])}
    out = consolidate(logs, empty_history(spark))
    got = by_key(out)
    assert got == {("p", "u1", "t", "r"): (14, 6, 30.0), ("p", "u2", "t", "r"): (0, 0, None)}
    r = out.filter("update_id = 'u1'").first()
    assert r.run_timestamp == T + dt.timedelta(minutes=1) and r.run_date == T.date()


def test_missing_counter_is_skipped_by_sum(spark):
    det = json.dumps({"flow_progress": {"data_quality": {"expectations": [
        {"dataset": "t", "name": "r", "passed_records": 3}]}}})
    logs = {"p": log(spark, [("u", T, "flow_progress", det),
                             ("u", T, "flow_progress", details(("t", "r", 1, 1)))])}
    assert by_key(consolidate(logs, empty_history(spark))) == {("p", "u", "t", "r"): (4, 1, 20.0)}


def test_fail_pct_is_decimal_half_up(spark):
    df = spark.createDataFrame([(19799, 201)], "p long, f long")
    assert df.select(fail_pct(F.col("f"), F.col("p"))).first()[0] == 1.01


def test_watermark_is_per_pipeline_and_strict(spark):
    hist = merge_history(empty_history(spark), consolidate(
        {"a": log(spark, [("u1", T, "flow_progress", details(("t", "r", 1, 0)))])},
        empty_history(spark)))
    logs = {
        "a": log(spark, [("u1", T, "flow_progress", details(("t", "r", 1, 0))),      # at watermark
                         ("u0", T - dt.timedelta(1), "flow_progress", details(("t", "r", 7, 7))),  # late
                         ("u2", T + dt.timedelta(1), "flow_progress", details(("t", "r", 2, 0)))]),
        "b": log(spark, [("v1", T - dt.timedelta(3), "flow_progress", details(("t", "r", 3, 0)))]),
    }
    for pushdown in (True, False):
        got = by_key(consolidate(logs, hist, pushdown=pushdown))
        assert got == {("a", "u2", "t", "r"): (2, 0, 0.0), ("b", "v1", "t", "r"): (3, 0, 0.0)}


def test_rerun_is_noop_and_split_run(spark):
    first = [("u1", T, "flow_progress", details(("t", "r", 14, 6)))]
    later = first + [("u1", T + dt.timedelta(hours=1), "flow_progress", details(("t", "r", 2, 0)))]
    h1 = merge_history(empty_history(spark), consolidate({"a": log(spark, first)}, empty_history(spark)))
    h1 = h1.checkpoint()
    h1b = merge_history(h1, consolidate({"a": log(spark, first)}, h1))
    assert by_key(h1b) == by_key(h1)
    # Split run: default replaces the sums by the newer part only; complete_runs re-reads the run.
    h2 = merge_history(h1, consolidate({"a": log(spark, later)}, h1))
    assert by_key(h2) == {("a", "u1", "t", "r"): (2, 0, 0.0)}
    h3 = merge_history(h1, consolidate({"a": log(spark, later)}, h1, complete_runs=True))
    assert by_key(h3) == {("a", "u1", "t", "r"): (16, 6, 27.27)}


def test_merge_keeps_unmatched_and_inserts_new(spark):
    h = merge_history(empty_history(spark), consolidate(
        {"a": log(spark, [("u1", T, "flow_progress", details(("t", "r", 1, 1), ("t", "s", 2, 0)))])},
        empty_history(spark)))
    src = consolidate({"a": log(spark, [("u1", T + dt.timedelta(1), "flow_progress",
                                          details(("t", "r", 5, 5))),
                                         ("u3", T + dt.timedelta(1), "flow_progress",
                                          details(("t", "r", 1, 0)))])}, h)
    got = by_key(merge_history(h, src))
    assert got == {("a", "u1", "t", "r"): (5, 5, 50.0), ("a", "u1", "t", "s"): (2, 0, 0.0),
                   ("a", "u3", "t", "r"): (1, 0, 0.0)}
