"""Consolidation + MERGE against a brute-force model on random event logs."""

import datetime as dt
import json
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from lakeward.operators.consolidate import consolidate
from lakeward.operators.merge import empty_history, merge_history
from lakeward.sources.event_logs import EVENT_LOG_SCHEMA

T0 = dt.datetime(2024, 1, 1)

counter = st.tuples(st.sampled_from(["t1", "t2"]), st.sampled_from(["r1", "r2"]),
                    st.integers(0, 50), st.one_of(st.none(), st.integers(0, 50)))
event = st.tuples(st.sampled_from(["a", "b"]), st.sampled_from(["u1", "u2", "u3"]),
                  st.integers(0, 20), st.sampled_from(["flow_progress", "flow_progress", "other"]),
                  st.lists(counter, min_size=0, max_size=3))


def _details(counters):
    return json.dumps({"flow_progress": {"data_quality": {"expectations": [
        {k: v for k, v in (("dataset", d), ("name", n), ("passed_records", p),
                           ("failed_records", f)) if v is not None}
        for d, n, p, f in counters]}}})


def _model_run(events, hist):
    """One consolidation + MERGE in plain Python."""
    marks = {}
    for (p, _u, _t, _e), row in hist.items():
        marks[p] = max(marks.get(p, row[0]), row[0])
    src = {}
    for p, u, minute, et, counters in events:
        ts = T0 + dt.timedelta(minutes=minute)
        if et != "flow_progress" or ts <= marks.get(p, dt.datetime(1900, 1, 1)):
            continue
        for d, n, passed, failed in counters:
            k = (p, u, d, n)
            cur = src.get(k, [ts, None, None])
            cur[0] = max(cur[0], ts)
            cur[1] = passed if cur[1] is None else cur[1] + passed
            if failed is not None:
                cur[2] = failed if cur[2] is None else cur[2] + failed
            src[k] = cur
    out = dict(hist)
    for k, (ts, passed, failed) in src.items():
        total = None if passed is None or failed is None else passed + failed
        pct = None if not total else float(
            (Decimal(failed) * 100 / Decimal(total)).quantize(Decimal("0.01"), ROUND_HALF_UP))
        out[k] = (ts, passed, failed, pct)
    return out


def _logs(spark, events):
    by = {}
    for p, u, minute, et, counters in events:
        by.setdefault(p, []).append(((u,), T0 + dt.timedelta(minutes=minute), et,
                                     _details(counters), "f"))
    return {p: spark.createDataFrame(rows, EVENT_LOG_SCHEMA) for p, rows in by.items()}


def _as_dict(df):
    return {(r.pipeline_name, r.update_id, r.table_name, r.expectation):
            (r.run_timestamp, r.passed_records, r.failed_records, r.fail_pct) for r in df.collect()}


@settings(max_examples=6, deadline=None)
@given(st.lists(event, min_size=1, max_size=25), st.integers(0, 20))
def test_two_runs_match_brute_force(spark, events, cut):
    first = [e for e in events if e[2] < cut]
    h1 = empty_history(spark)
    if first:
        h1 = merge_history(h1, consolidate(_logs(spark, first), h1)).checkpoint()
    h2 = merge_history(h1, consolidate(_logs(spark, events), h1))
    expected = _model_run(events, _model_run(first, {}))
    assert _as_dict(h2) == expected
