"""Flagship job: the whole medallion on the benchmark tables, from files.

benchmark tables -> fetched documents landed as files (namespaced XML market
documents, JSON Lines weather payloads) -> file-source decode (fetch time =
file modification time) -> landing CSV per day -> bronze stream -> silver ->
event logs -> DQ consolidation -> history.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from lakeward import queries as Q
from lakeward.plans import derived
from lakeward.plans.domains import GENERATION, PRICES, WEATHER
from lakeward.plans.dq_job import read_history, run_consolidation
from lakeward.plans.parallel import spread
from lakeward.plans.pipeline import LakePaths, land, run_domains, run_pipeline
from lakeward.session import scratch_path
from lakeward.sources import documents as docs


def fetched_documents(spark: SparkSession, sf_dir: str, raw: str) -> list:
    """Land the derived documents as files; return the decoded rows per domain."""
    prices, generation, weather = f"{raw}/prices", f"{raw}/generation", f"{raw}/weather"
    derived.write_xml_documents(
        derived.price_documents(spread(Q.table(spark, sf_dir, "orders"))), "xml", prices,
        *Q.PRICE_DOCUMENT)
    derived.write_xml_documents(
        derived.generation_documents(spread(Q.table(spark, sf_dir, "lineitem"))), "xml",
        generation, *Q.GENERATION_DOCUMENT)
    (derived.weather_payloads(spread(Q.table(spark, sf_dir, "events"))).select("json")
     .write.mode("overwrite").text(weather))
    return [
        (PRICES, docs.decode_prices(
            docs.read_series_xml(spark, prices, docs.PRICE_SERIES_SCHEMA))),
        (GENERATION, docs.decode_generation(
            docs.read_series_xml(spark, generation, docs.GENERATION_SERIES_SCHEMA))),
        (WEATHER, docs.decode_weather(docs.read_weather_json(spark, weather, multi_line=False), as_text=True)),
    ]


def run_medallion(spark: SparkSession, sf_dir: str, base: str | None = None,
                  update_id: str = "update-0001") -> LakePaths:
    paths = LakePaths(base or scratch_path(spark, "medallion"))

    def domain(spec, rows):
        land(rows, spec, paths)
        run_pipeline(spark, spec, paths, update_id=update_id, bucket=Q.BACKFILL)

    run_domains([partial(domain, spec, rows)
                 for spec, rows in fetched_documents(spark, sf_dir, f"{paths.base}/raw")])
    run_consolidation(spark, paths.monitoring, paths.history)
    return paths


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = run_medallion(spark, sf_dir)
    return read_history(spark, paths.history)
