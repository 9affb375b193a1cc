"""Event logs: the per-pipeline record of flow progress and expectation counters.

A log has the columns ``origin STRUCT<update_id STRING>, timestamp TIMESTAMP,
event_type STRING, details STRING`` (plus ``flow_name`` for readability).
Logs live as Parquet folders named ``<pipeline>_event_log`` under one
monitoring folder, or as tables/views in a catalog database.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.functions.json_paths import expectations_details
from lakeward.operators.consolidate import EVENT_LOG_SUFFIX, FLOW_PROGRESS, pipeline_name_of
from lakeward.sources import fs

EVENT_LOG_SCHEMA = T.StructType([
    T.StructField("origin", T.StructType([T.StructField("update_id", T.StringType())])),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("details", T.StringType()),
    T.StructField("flow_name", T.StringType()),
])


def discover_in_catalog(spark: SparkSession, database: str | None = None,
                        prefix: str = "", suffix: str = EVENT_LOG_SUFFIX) -> list[str]:
    """Tables and views that end with ``suffix``.

    With ``database`` the names are qualified by it and temporary views, which
    belong to no database, are left out; without it they are those of the current
    database and the session.
    """
    found = [t for t in spark.catalog.listTables(database)
             if t.name.startswith(prefix) and t.name.endswith(suffix)]
    if database is None:
        return sorted(t.name for t in found)
    quoted = ".".join(f"`{part}`" for part in database.replace("`", "").split("."))
    return sorted(f"{quoted}.`{t.name}`" for t in found if not t.isTemporary)


def logs_from_catalog(spark: SparkSession, tables: Iterable[str], prefix: str = "",
                      suffix: str = EVENT_LOG_SUFFIX) -> dict[str, DataFrame]:
    return {pipeline_name_of(t.replace("`", "").rpartition(".")[2][len(prefix):], suffix): spark.table(t)
            for t in tables}


def discover_in_folder(spark: SparkSession, monitoring_dir: str,
                       suffix: str = EVENT_LOG_SUFFIX) -> list[str]:
    """Sub-folders of ``monitoring_dir`` whose name ends with ``suffix``."""
    return sorted(n for n in fs.list_dirs(spark, monitoring_dir) if n.endswith(suffix))


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.schema(EVENT_LOG_SCHEMA).option("recursiveFileLookup", True)
            .parquet(path))


def logs_from_folder(spark: SparkSession, monitoring_dir: str) -> dict[str, DataFrame]:
    base = monitoring_dir.rstrip("/")
    return {pipeline_name_of(n): read_event_log(spark, f"{base}/{n}")
            for n in discover_in_folder(spark, monitoring_dir)}


def flow_event(spark: SparkSession, update_id: str, flow_name: str,
               counters: list[Mapping], at: dt.datetime | None = None) -> DataFrame:
    """One ``flow_progress`` event carrying expectation counters (a one-row DataFrame).

    ``counters`` is bounded by the number of rules of one table.
    """
    at = at or dt.datetime.now(dt.timezone.utc)
    schema = "array<struct<dataset:string,name:string,passed_records:bigint,failed_records:bigint>>"
    rows = [(update_id, at, [(c["dataset"], c["name"], int(c["passed_records"]),
                              int(c["failed_records"])) for c in counters], flow_name)]
    df = spark.createDataFrame(rows, f"update_id string, ts timestamp, c {schema}, flow_name string")
    return df.select(F.struct("update_id").alias("origin"), F.col("ts").alias("timestamp"),
                     F.lit(FLOW_PROGRESS).alias("event_type"),
                     expectations_details(F.col("c")).alias("details"), "flow_name")


def event_update_id(spark: SparkSession, log_dir: str, event_key: str) -> str | None:
    """The run that an already written event of this key belongs to."""
    path = f"{log_dir.rstrip('/')}/{event_key}"
    if not fs.exists(spark, f"{path}/_SUCCESS"):
        return None
    row = spark.read.schema(EVENT_LOG_SCHEMA).parquet(path).select("origin.update_id").first()
    return row["update_id"] if row else None


def append_event(event: DataFrame, log_dir: str, event_key: str) -> None:
    """Write ``event`` to ``<log_dir>/<event_key>``; the same key replaces (idempotent replay)."""
    event.coalesce(1).write.mode("overwrite").parquet(f"{log_dir.rstrip('/')}/{event_key}")


QUARANTINE = "quarantine_progress"


def quarantine_event(spark: SparkSession, update_id: str, flow_name: str, counts: Mapping[str, int],
                     at: dt.datetime | None = None) -> DataFrame:
    """One event that says how many rows or documents a flow set aside, by reason.

    ``counts`` is bounded by the number of rules or reasons of one flow. Consolidation reads
    ``flow_progress`` events only, so these add nothing to the expectation history.
    """
    at = at or dt.datetime.now(dt.timezone.utc)
    details = json.dumps({QUARANTINE: {"num_records": sum(counts.values()), "reasons": dict(counts)}})
    df = spark.createDataFrame([(update_id, at, details, flow_name)],
                               "update_id string, ts timestamp, details string, flow_name string")
    return df.select(F.struct("update_id").alias("origin"), F.col("ts").alias("timestamp"),
                     F.lit(QUARANTINE).alias("event_type"), "details", "flow_name")
