"""Plan-shape guards for the properties the engine relies on at scale."""

import datetime as dt
import json

from lakeward.operators.consolidate import consolidate
from lakeward.operators.expectations import rule_metrics
from lakeward.operators.merge import empty_history, merge_history
from lakeward.sources.event_logs import EVENT_LOG_SCHEMA, logs_from_folder


def _plan(df) -> str:
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")   # untruncated PushedFilters
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)


def _write_log(spark, path, ts):
    det = json.dumps({"flow_progress": {"data_quality": {"expectations": [
        {"dataset": "t", "name": "r", "passed_records": 1, "failed_records": 0}]}}})
    spark.createDataFrame([(("u",), ts, "flow_progress", det, "f")], EVENT_LOG_SCHEMA) \
        .write.mode("overwrite").parquet(path)


def test_watermark_and_nested_pruning_reach_the_log_scan(spark, workdir):
    t = dt.datetime(2024, 1, 10)
    _write_log(spark, f"{workdir}/mon/a_event_log/e1", t)
    logs = logs_from_folder(spark, f"{workdir}/mon")
    hist = merge_history(empty_history(spark), consolidate(logs, empty_history(spark))).checkpoint()
    plan = _plan(consolidate(logs, hist))
    assert "GreaterThan(timestamp,2024-01-10" in plan          # watermark pushed as a literal
    assert "EqualTo(event_type,flow_progress)" in plan
    assert "origin:struct<update_id:string>" in plan            # nested column pruning
    assert "flow_name" not in plan.split("ReadSchema:")[1].split("\n")[0]


def test_expectations_scan_only_rule_columns(spark, workdir):
    path = f"{workdir}/wide"
    spark.range(10).selectExpr("id", "id * 2 AS a", "'x' AS b", "id % 3 AS c") \
        .write.parquet(path)
    plan = _plan(rule_metrics(spark.read.parquet(path), {"r": "a >= 0"}, "w"))
    assert "ReadSchema: struct<a:bigint>" in plan
    assert "HashAggregate" in plan and "SinglePartition" in plan


def test_landing_write_rebalances_on_day(spark):
    from pyspark.sql import functions as F
    from lakeward.sources.landing import landing_day
    df = spark.range(5).select(F.timestamp_seconds(F.col("id") * 86400).alias("delivery_start"))
    out = df.select("delivery_start", landing_day("delivery_start", "delivery").alias("ingest_date")) \
        .hint("rebalance", "ingest_date")
    assert "REBALANCE_PARTITIONS_BY_COL" in _plan(out)


def _initial_plan(df) -> str:
    """The plan before execution; after a run the plan text holds that of the run too."""
    return _plan(df).split("== Initial Plan ==")[-1]


def _below_spread(df) -> str:
    """The part of a plan that runs in the tasks that scan the table."""
    plan = _initial_plan(df)
    assert "REBALANCE_PARTITIONS" in plan
    return plan.split("REBALANCE_PARTITIONS", 1)[1]


def _price_texts(spark, workdir):
    """Orders with their texts made behind a spread, as the decode queries have them."""
    from pyspark.sql import functions as F
    from lakeward.plans.derived import price_documents
    from lakeward.plans.parallel import spread
    path = f"{workdir}/orders"
    spark.range(40).select(
        F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("P").alias("o_orderstatus"),
        (F.col("id") * 1000.0).alias("o_totalprice"), F.lit(dt.datetime(2024, 1, 1)).alias("o_orderdate"),
        F.lit("1-URGENT").alias("o_orderpriority")).write.parquet(path)
    return price_documents(spread(spark.read.parquet(path)))


def test_quarantined_series_parse_behind_the_spread(spark, workdir):
    from pyspark.sql import functions as F
    from lakeward.sources import documents as D
    xml = F.when(F.col("doc_id") % 4 == 0, F.lit("Service unavailable")).otherwise(F.col("xml"))
    series = _price_texts(spark, workdir).select(D.parse_series_xml(xml, D.PRICE_SERIES_SCHEMA).alias("series"), "fetched_at")
    aside = D.quarantined_series(series, D.PRICE_VALUE)
    assert [r.reason for r in aside.collect()] == [D.MALFORMED] * 10
    assert "from_xml" in _initial_plan(aside) and "from_xml" not in _below_spread(aside)


def test_quarantined_documents_parse_behind_the_spread(spark, workdir):
    from pyspark.sql import functions as F
    from lakeward.sources import documents as D
    texts = _price_texts(spark, workdir)
    whole = F.concat(F.lit("<R"), F.when(F.col("doc_id") % 4 != 0, F.lit(f' xmlns="{D.PRICE_NAMESPACE}"')).otherwise(""),
                     F.lit(">"), "xml", F.lit("</R>"))
    parsed = D.parse_documents(texts.select(whole.alias("document"), "fetched_at"), D.PRICE_SERIES_SCHEMA)
    aside = D.quarantined_documents(parsed)
    assert [r.reason for r in aside.collect()] == [D.FOREIGN] * 10
    assert "from_xml" in _initial_plan(aside) and "from_xml" not in _below_spread(aside)


def test_spelled_documents_are_made_once_behind_the_spread(spark, workdir, monkeypatch):
    from pyspark.sql import DataFrameWriter
    from pyspark.sql import functions as F
    from lakeward import queries as Q
    from lakeward.sources import documents as D
    texts = _price_texts(spark, workdir)
    path = Q._land_spellings(texts, f"{workdir}/raw", *Q.PRICE_DOCUMENT)
    parsed = D.parse_documents(D.read_documents(spark, path), D.PRICE_SERIES_SCHEMA)
    code = F.crc32("xml")
    expected = texts.agg(F.count_if(code % 2 == 0), F.count_if(code % 2 == 1), F.count_if(code % 10 == 0)).first()
    held = {(r.problem, r.root): r.document.count("</TimeSeries>") + r.document.count("</md:TimeSeries>")
            for r in parsed.collect()}
    assert sorted(held.values()) == sorted(n for n in expected if n) and sum(expected[:2]) == 40
    written = []
    monkeypatch.setattr(DataFrameWriter, "text", lambda self, path, **_: written.append(self._df))
    Q._land_spellings(texts, f"{workdir}/again", *Q.PRICE_DOCUMENT)
    assert len(written) == 1 and "crc32" not in _below_spread(written[0])


def test_a_series_without_text_is_not_landed_silently(spark, workdir):
    import pytest
    from lakeward.plans.derived import write_xml_documents
    with pytest.raises(Exception, match="without text"):
        write_xml_documents(spark.createDataFrame([("<TimeSeries/>",), (None,)], "xml string"), "xml", f"{workdir}/x", "R")


def test_landing_documents_parses_once_for_what_is_set_aside(spark, workdir):
    from lakeward.sources import documents as D
    from lakeward.streaming.documents import SPLITS
    series = ("<TimeSeries><Period><timeInterval><start>2024-01-01T00:00Z</start></timeInterval><resolution>PT60M</resolution>"
              "<Point><position>{}</position><price.amount>1</price.amount></Point></Period></TimeSeries>")
    sound = f'<R xmlns="{D.PRICE_NAMESPACE}">{series.format(1)}{series.format("no")}</R>'
    empty, foreign = f'<R xmlns="{D.PRICE_NAMESPACE}"/>', "<R><TimeSeries/></R>"
    rows = [(text, f"f{i}", None) for i, text in enumerate((sound, empty, foreign, "Service unavailable", None))]
    schema = "document string, path string, fetched_at timestamp"
    spark.createDataFrame(rows, schema).write.parquet(f"{workdir}/docs")
    decoded, bad = SPLITS["entsoe"](spark.read.parquet(f"{workdir}/docs"))
    assert decoded.count() == 1
    got = {r.path: (r.reason, r.document) for r in bad.collect()}
    assert got["f0"][0] == "value is no number" and '"position":"no"' in got["f0"][1]
    assert {p: v for p, v in got.items() if p != "f0"} == {
        "f2": (D.FOREIGN, foreign), "f3": (D.MALFORMED, "Service unavailable"), "f4": (D.MALFORMED, None)}
    assert _initial_plan(bad).count("from_xml(") == 1


def test_bind_makes_arrays_only_for_lines_that_need_them(spark, workdir):
    from lakeward.sources.csv_lines import bind
    lines = ["a,b,c", "1,2.5,x", '2,bad,"q,""x"""', "3,,", '4,1.5,""', "5,1,x,more"]
    spark.createDataFrame([(v, "f", 0) for v in lines], "value string, file string, block long").coalesce(1).write.parquet(
        f"{workdir}/lines")
    bound = bind(spark.read.parquet(f"{workdir}/lines"), (("a", "INT"), ("b", "DOUBLE"), ("c", "STRING")), "_r")
    assert {tuple(r) for r in bound.collect()} == {
        (1, 2.5, "x", None), (2, None, 'q,"x"', '{"b":"bad"}'), (3, None, None, None), (4, 1.5, "", None),
        (5, 1.0, "x", '{"_line":"5,1,x,more"}')}
    assert "transform(split(value" not in _initial_plan(bound)


def test_landed_documents_are_compressed(spark, workdir):
    from lakeward import queries as Q
    from lakeward.sources import documents as D, fs
    texts = _price_texts(spark, workdir)
    path = Q._land_spellings(texts, f"{workdir}/raw", *Q.PRICE_DOCUMENT)
    names = [n for n in fs.list_files(spark, path) if n.startswith("part-")]
    assert names and all(n.endswith(".txt.gz") for n in names)
    assert D.read_documents(spark, path).where("document LIKE '%</md:Publication_MarketDocument>%'").count() > 0


def test_landing_is_compressed_and_read_with_plain_files(spark, workdir):
    from conftest import write_file
    from lakeward.plans.domains import PRICES
    from lakeward.plans.pipeline import LakePaths, land
    from lakeward.streaming.bronze import read_bronze, run_bronze
    paths = LakePaths(workdir)
    t = "2024-01-01 00:00:00+00:00"
    land(spark.sql("SELECT timestamp'2024-01-01' AS delivery_start, timestamp'2024-01-01 01:00:00' AS delivery_end, 2.5D AS "
                   "price_gbp_per_mwh, 'a,\"b' AS currency, 'Z' AS bidding_zone, timestamp'2024-01-02' AS fetched_at"), PRICES, paths)
    from lakeward.sources import fs
    day = f"{paths.landing(PRICES)}/ingest_date=2024-01-01"
    assert all(n.endswith(".csv.gz") for n in fs.list_files(spark, day) if n.startswith("part-"))
    write_file(f"{paths.landing(PRICES)}/x/plain.csv", f"{','.join(PRICES.column_names)}\n{t},{t},3.5,EUR,Z,{t}\n")
    run_bronze(spark, PRICES, paths.landing(PRICES), paths.bronze(PRICES), paths.checkpoint(PRICES), paths.event_log(PRICES), "u")
    got = read_bronze(spark, PRICES, paths.bronze(PRICES)).select("price_gbp_per_mwh", "currency", "_rescued_data").collect()
    assert sorted(map(tuple, got)) == [(2.5, 'a,"b', None), (3.5, "EUR", None)]


def test_lines_stay_where_they_are_read(spark, workdir, monkeypatch):
    """Headers are broadcast, so bronze does not shuffle its lines; many files fall back to a shuffle, with the same rows."""
    from lakeward.sources import csv_lines
    rows = [(v, f, 0) for f in ("f", "g") for v in (("a,b", "1,x", "2,y") if f == "f" else ("b,a", "z,3"))]
    spark.createDataFrame(rows, "value string, file string, block long").coalesce(1).write.parquet(f"{workdir}/lines")
    lines, columns = spark.read.parquet(f"{workdir}/lines"), (("a", "INT"), ("b", "STRING"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        bound = csv_lines.bind(lines, columns, "_r")
        plan = _initial_plan(bound)
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
        expected = [(1, "x", None), (2, "y", None), (3, "z", None)]
        assert sorted(map(tuple, bound.collect())) == expected
        monkeypatch.setattr(csv_lines, "BROADCAST_FILES", 1)
        many = csv_lines.bind(lines, columns, "_r")
        assert "SortMergeJoin" in _initial_plan(many) and sorted(map(tuple, many.collect())) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
