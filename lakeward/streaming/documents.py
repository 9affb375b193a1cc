"""Incremental decode of fetched documents into landing CSV.

Newly fetched files enter by a triggered file stream with a checkpoint, one row per document, so
a document is decoded once however often the job runs. In each micro-batch sound documents
land as CSV, and documents or records that cannot be decoded are written with their
reason to the quarantine folder and counted in the event log. Both writes go to folders
named by the batch, so a replay after a crash replaces what the first try left.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.plans.domains import GENERATION, PRICES, WEATHER, DomainSpec
from lakeward.plans.pipeline import LakePaths
from lakeward.sources import documents as D
from lakeward.sources import fs
from lakeward.sources.event_logs import append_event, event_update_id, quarantine_event
from lakeward.sources.landing import landing_day, write_landing
from lakeward.streaming.bronze import BATCH_PREFIX, MAX_BYTES_PER_TRIGGER, MAX_FILE_AGE

QUARANTINE_SCHEMA = "reason STRING, document STRING, path STRING, fetched_at TIMESTAMP"


def _market(schema: str, value: str, decode: Callable) -> Callable[[DataFrame], tuple[DataFrame, DataFrame]]:
    def split(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
        parsed = D.parse_documents(documents, schema)
        # A series of a sound document is set aside alone, as JSON; its neighbours land. One pass, and the filters only on
        # what comes out of it: those on the problem would parse every document again.
        parts = parsed.select("path", "fetched_at", F.col("problem").alias("whole"), F.when(F.col("problem").isNotNull(), F.col(
            "document")).alias("document"), F.explode_outer("series").alias("series"))
        found = F.when(F.col("whole").isNotNull() | F.col("series").isNotNull(), F.coalesce(
            "whole", D.series_problem(F.col("series"), value)))
        bad = parts.select(F.explode_outer(F.array(found)).alias("reason"), F.coalesce(
            "document", F.to_json("series")).alias("document"), "path", "fetched_at").where("reason IS NOT NULL")
        return decode(D.document_series(parsed), on_bad="quarantine"), bad
    return split


def _weather(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    p = documents.select(D.parse_weather_json(F.col("document")).alias("p"), "document", "path", "fetched_at")
    payloads = p.select("p.*", "document", "path", "fetched_at")
    bad = payloads.select(F.explode_outer(F.array(D.payload_problem(payloads))).alias("reason"), "document", "path",
                          "fetched_at").where("reason IS NOT NULL")
    return D.decode_weather(payloads, on_bad="quarantine", as_text=True), bad


SPLITS = {PRICES.pipeline: _market(D.PRICE_SERIES_SCHEMA, D.PRICE_VALUE, D.decode_prices),
          GENERATION.pipeline: _market(D.GENERATION_SERIES_SCHEMA, D.GENERATION_VALUE, D.decode_generation),
          WEATHER.pipeline: _weather}


def land_documents(spark: SparkSession, spec: DomainSpec, paths: LakePaths, update_id: str,
                   max_files_per_trigger: int | None = None, fetched_at: Column | None = None) -> list[int]:
    """Decode the documents that are new under ``paths.raw(spec)``; returns the batches written."""
    if not fs.exists(spark, paths.raw(spec)):
        return []
    reader = spark.readStream.option("wholetext", True).option("maxFileAge", MAX_FILE_AGE).option("recursiveFileLookup", True)
    reader = (reader.option("maxFilesPerTrigger", max_files_per_trigger) if max_files_per_trigger
              else reader.option("maxBytesPerTrigger", MAX_BYTES_PER_TRIGGER))
    when = fetched_at if fetched_at is not None else F.col("_metadata.file_modification_time")
    fetched = reader.text(paths.raw(spec), wholetext=True).select(
        F.col("value").alias("document"), F.col("_metadata.file_path").alias("path"), when.alias("fetched_at"))
    done: list[int] = []

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows, bad = SPLITS[spec.pipeline](batch)
        name = f"{BATCH_PREFIX}{batch_id:012d}"
        aside = f"{paths.raw_quarantine(spec)}/{name}"
        bad.write.mode("overwrite").parquet(aside)
        counts = {r["reason"]: r["n"] for r in spark.read.schema(QUARANTINE_SCHEMA).parquet(aside)
                  .groupBy("reason").agg(F.count("*").alias("n")).collect()}  # one row per reason
        write_landing(rows, f"{paths.landing(spec)}/{name}", spec.column_names, landing_day(spec.time_column, spec.day_kind))
        key = f"{spec.pipeline}-documents-{name}"
        run_id = event_update_id(spark, paths.event_log(spec), key) or update_id
        append_event(quarantine_event(spark, run_id, f"{spec.pipeline}_documents", counts), paths.event_log(spec), key)
        done.append(batch_id)

    (fetched.writeStream.foreachBatch(write_batch).option("checkpointLocation", paths.raw_checkpoint(spec))
     .trigger(availableNow=True).start().awaitTermination())
    return done


def read_document_quarantine(spark: SparkSession, spec: DomainSpec, paths: LakePaths) -> DataFrame:
    """``reason, document, path, fetched_at`` of everything that was set aside while landing."""
    path = paths.raw_quarantine(spec)
    if not fs.list_dirs(spark, path):
        return spark.createDataFrame([], QUARANTINE_SCHEMA)
    return spark.read.schema(QUARANTINE_SCHEMA).option("recursiveFileLookup", True).parquet(path)
