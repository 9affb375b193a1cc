"""Data-quality consolidation: event logs -> one row per run x table x expectation.

Semantics (per pipeline):

* only ``flow_progress`` events count;
* only events strictly newer than the pipeline's watermark (its latest
  ``run_timestamp`` already in history; none -> 1900-01-01) are read, so older
  or late events are ignored;
* counters of all micro-batches of a run are summed; ``run_timestamp`` is the
  newest event of the run, ``run_date`` its UTC date;
* ``fail_pct = round(100 * failed / (passed + failed), 2)`` with HALF_UP decimal
  rounding, NULL when there were no records.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.functions.json_paths import expectations_array

# Fixed values of the event-log contract.
EVENT_LOG_SUFFIX = "_event_log"
FLOW_PROGRESS = "flow_progress"
DEFAULT_WATERMARK_MICROS = -2_208_988_800_000_000  # 1900-01-01T00:00Z
LOG_COLUMNS = ("origin", "timestamp", "details", "event_type")
HISTORY_KEYS = ("pipeline_name", "update_id", "table_name", "expectation")
HISTORY_COLUMNS = ("pipeline_name", "update_id", "run_timestamp", "run_date", "table_name",
                   "expectation", "passed_records", "failed_records", "fail_pct")


def instant(micros: int) -> Column:
    """Literal TIMESTAMP of microseconds since the epoch."""
    return F.timestamp_micros(F.lit(micros))


def pipeline_name_of(table: str, suffix: str = EVENT_LOG_SUFFIX) -> str:
    """``prices_event_log`` -> ``prices``."""
    if not table.endswith(suffix):
        raise ValueError(f"{table!r} does not end with {suffix!r}")
    return table[: -len(suffix)]


def tag_logs(logs: Mapping[str, DataFrame]) -> DataFrame:
    """UNION ALL of the logs, each tagged with a constant ``pipeline_name``.

    Only the four log columns are selected, so nested-column pruning reaches
    each scan (``origin.update_id`` alone is read from the struct).
    """
    if not logs:
        raise ValueError("no event logs to union")
    parts = [df.select(F.lit(name).alias("pipeline_name"), *LOG_COLUMNS)
             for name, df in sorted(logs.items())]
    return reduce(DataFrame.unionByName, parts)


def watermarks(history: DataFrame, pipelines: list[str]) -> DataFrame:
    """``(pipeline_name, watermark)``: latest consolidated run of the given pipelines.

    At most ``len(pipelines)`` rows, a size bound that makes broadcasting it safe.
    """
    history = history.filter(F.col("pipeline_name").isin(pipelines))
    return history.groupBy("pipeline_name").agg(F.max("run_timestamp").alias("watermark"))


def after_watermark_join(tagged: DataFrame, wm: DataFrame) -> DataFrame:
    """Relational form: LEFT JOIN the (bounded, broadcast) watermark table, keep newer events."""
    joined = tagged.join(F.broadcast(wm), "pipeline_name", "left")
    return (joined.filter((F.col("event_type") == FLOW_PROGRESS) &
                          (F.col("timestamp") > F.coalesce(
                              F.col("watermark"), instant(DEFAULT_WATERMARK_MICROS))))
            .drop("watermark"))


def after_watermark_pushdown(logs: Mapping[str, DataFrame],
                             marks: Mapping[str, int | None]) -> DataFrame:
    """Pushdown form: a literal ``timestamp > w`` on every log *before* the union.

    The literal reaches each Parquet scan as a pushed filter (row groups older
    than the watermark are skipped), which the join form cannot do. Marks are
    microseconds since the epoch, so no time zone of the driver enters.
    """
    parts = {}
    for name, df in logs.items():
        w = marks.get(name)
        w = DEFAULT_WATERMARK_MICROS if w is None else w
        parts[name] = df.filter((F.col("event_type") == FLOW_PROGRESS) &
                                (F.col("timestamp") > instant(w)))
    return tag_logs(parts)


def explode_counters(events: DataFrame) -> DataFrame:
    """One row per (event, expectation entry); events without counters give no row."""
    return events.select(
        "pipeline_name",
        F.col("origin.update_id").alias("update_id"),
        F.col("timestamp").alias("ts"),
        F.explode(expectations_array(F.col("details"))).alias("e"))


def fail_pct(failed: Column, passed: Column) -> Column:
    """round(100 * failed / nullif(passed + failed, 0), 2) in DECIMAL (HALF_UP), as DOUBLE."""
    total = F.nullif(passed + failed, F.lit(0))
    return F.round(failed * F.lit(100).cast("decimal(4,1)") / total, 2).cast("double")


def aggregate_runs(exploded: DataFrame) -> DataFrame:
    """Collapse micro-batches into one row per (pipeline, run, table, expectation).

    Hash aggregation with a map-side partial step: a run with millions of
    micro-batch events ships one partial row per task, not its events.
    """
    agg = (exploded.groupBy("pipeline_name", "update_id",
                            F.col("e.dataset").alias("table_name"),
                            F.col("e.name").alias("expectation"))
           .agg(F.max("ts").alias("run_timestamp"),
                F.sum("e.passed_records").alias("passed_records"),
                F.sum("e.failed_records").alias("failed_records")))
    return agg.select(
        "pipeline_name", "update_id", "run_timestamp",
        F.to_date("run_timestamp").alias("run_date"),
        "table_name", "expectation", "passed_records", "failed_records",
        fail_pct(F.col("failed_records"), F.col("passed_records")).alias("fail_pct"))


def consolidate(logs: Mapping[str, DataFrame], history: DataFrame,
                pushdown: bool = True, complete_runs: bool = False) -> DataFrame:
    """Source rows for the history merge (one per pipeline x run x table x expectation).

    ``logs`` maps pipeline name -> event-log DataFrame.

    * ``pushdown=True`` reads the watermarks first (at most one row per
      pipeline, fetched to the driver) and pushes them into each log scan;
      ``False`` keeps everything in one plan via a broadcast LEFT JOIN.
    * ``complete_runs=True`` re-reads every event of a run that has any new
      event, so a run split across two consolidations keeps its full sums
      (default ``False`` reproduces the plain incremental behaviour, where the
      second part replaces the first).
    """
    names = sorted(logs)
    if pushdown:
        micros = F.unix_micros("watermark").alias("micros")
        marks = {r["pipeline_name"]: r["micros"]
                 for r in watermarks(history, names).select("pipeline_name", micros).collect()}
        new_events = after_watermark_pushdown(logs, marks)
    else:
        new_events = after_watermark_join(tag_logs(logs), watermarks(history, names))
    exploded = explode_counters(new_events)
    if complete_runs:
        # Runs with new counters; a semi join keeps every event of those runs
        # (AQE's skew handling covers a run holding most of the events).
        runs = exploded.select("pipeline_name", "update_id").distinct()
        every = (tag_logs(logs).filter(F.col("event_type") == FLOW_PROGRESS)
                 .withColumn("update_id", F.col("origin.update_id"))
                 .join(runs, ["pipeline_name", "update_id"], "left_semi")
                 .drop("update_id"))
        exploded = explode_counters(every)
    return aggregate_runs(exploded)
