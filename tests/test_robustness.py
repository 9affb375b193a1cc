"""Landed files and documents that must not get lost, replays, crashes, time zones."""

import datetime as dt
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from conftest import ROOT, write_file
from lakeward.operators.merge import HISTORY_SCHEMA
from lakeward.plans.domains import PRICES
from lakeward.plans.dq_job import ensure_history, read_history, run_consolidation
from lakeward.plans.pipeline import LakePaths, read_silver, run_pipeline
from lakeward.session import checkpoint_root
from lakeward.sources import documents as D
from lakeward.sources import event_logs as L
from lakeward.sources import fs
from lakeward.sources.tables import BucketTable, SnapshotTable
from lakeward.streaming.bronze import read_bronze, run_bronze

HEADER = ",".join(PRICES.column_names)


def land_row(paths, name, price, age_days=0):
    path = f"{paths.landing(PRICES)}/2024-01-0{price}/{name}.csv"
    day = f"2024-01-0{price}"
    write_file(path, f"{HEADER}\n{day} 00:00:00,{day} 01:00:00,{price}.5,GBP,10Y,{day} 13:30:00\n")
    when = dt.datetime.now().timestamp() - age_days * 86400
    os.utime(path, (when, when))


def bronze(spark, paths, run):
    return run_bronze(spark, PRICES, paths.landing(PRICES), paths.bronze(PRICES),
                      paths.checkpoint(PRICES), paths.event_log(PRICES), run)


def test_old_files_are_read_after_newer_ones(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    for k, age in ((1, 0), (2, 10), (3, 400)):
        land_row(paths, f"f{k}", k, age)
        bronze(spark, paths, f"u{k}")
    assert read_bronze(spark, PRICES, paths.bronze(PRICES)).count() == 3


def test_replayed_batch_counts_for_one_run(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    land_row(paths, "f1", 1)
    bronze(spark, paths, "u1")
    run_consolidation(spark, paths.monitoring, paths.history)
    (tmp_path / "_checkpoints" / PRICES.bronze_table / "commits" / "0").unlink()
    for crc in (tmp_path / "_checkpoints" / PRICES.bronze_table / "commits").glob(".0.crc"):
        crc.unlink()
    bronze(spark, paths, "u2")
    run_consolidation(spark, paths.monitoring, paths.history)
    history = read_history(spark, paths.history)
    assert {r.update_id for r in history.select("update_id").distinct().collect()} == {"u1"}
    assert read_bronze(spark, PRICES, paths.bronze(PRICES)).count() == 1


def test_first_run_without_any_file(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    run_pipeline(spark, PRICES, paths, update_id="u0")
    assert read_bronze(spark, PRICES, paths.bronze(PRICES)).count() == 0
    assert read_silver(spark, PRICES, paths).count() == 0
    run_consolidation(spark, paths.monitoring, paths.history)
    land_row(paths, "f1", 1)
    run_pipeline(spark, PRICES, paths, update_id="u1", incremental=True)
    assert read_silver(spark, PRICES, paths).count() == 1


@pytest.mark.parametrize("drop_invalid", [False, True])
def test_update_rewrites_only_the_days_it_touches(spark, tmp_path, drop_invalid):
    paths = LakePaths(str(tmp_path))
    for k in (1, 2, 3):
        land_row(paths, f"f{k}", k)
    run_pipeline(spark, PRICES, paths, update_id="u1", incremental=True, drop_invalid=drop_invalid)
    table = BucketTable(spark, paths.silver(PRICES))
    before = table.folders()
    bytes_of = lambda p: {f.name: f.read_bytes() for f in (tmp_path / "silver" / PRICES.silver_table / p).iterdir()}
    old = {b: bytes_of(p) for b, p in before.items()}
    path = f"{paths.landing(PRICES)}/2024-01-02/again.csv"
    write_file(path, f"{HEADER}\n2024-01-02 00:00:00,2024-01-02 01:00:00,9.5,GBP,10Y,2024-01-05 13:30:00\n")
    read = []
    plain = BucketTable.read
    with pytest.MonkeyPatch.context() as m:
        m.setattr(BucketTable, "read", lambda self, schema=None, buckets=None: (
            read.append(buckets), plain(self, schema, buckets))[1])
        run_pipeline(spark, PRICES, paths, update_id="u2", incremental=True, drop_invalid=drop_invalid)
    after = table.folders()
    assert sorted(after) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert [b for b in after if after[b] != before[b]] == ["2024-01-02"]
    assert all(bytes_of(after[b]) == old[b] for b in ("2024-01-01", "2024-01-03"))
    assert read == ([] if drop_invalid else [{"2024-01-02"}])
    got = sorted((r.delivery_start.day, r.price_gbp_per_mwh) for r in read_silver(spark, PRICES, paths).collect())
    assert got == [(1, 1.5), (2, 9.5), (3, 3.5)]
    run_pipeline(spark, PRICES, paths, update_id="u3", incremental=True, drop_invalid=drop_invalid)
    assert table.folders() == after  # nothing new: nothing written


def test_crash_before_the_silver_commit_keeps_silver(spark, tmp_path, monkeypatch):
    paths = LakePaths(str(tmp_path))
    land_row(paths, "f1", 1)
    run_pipeline(spark, PRICES, paths, update_id="u1", incremental=True)
    land_row(paths, "f2", 2)
    with monkeypatch.context() as m:
        m.setattr(fs, "create_text", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            run_pipeline(spark, PRICES, paths, update_id="u2", incremental=True)
    assert read_silver(spark, PRICES, paths).count() == 1
    run_pipeline(spark, PRICES, paths, update_id="u3", incremental=True)
    assert read_silver(spark, PRICES, paths).count() == 2


def test_expired_snapshots_spare_live_buckets(spark, workdir):
    t = BucketTable(spark, f"{workdir}/t")
    rows = lambda *xs: spark.createDataFrame([(d, x) for d, x in xs], "d string, x int")
    t.commit_buckets(rows(("a", 1), ("b", 2)), F.col("d"), "x", keep_snapshots=1, keep_seconds=0)
    for x in (3, 4, 5):
        t.commit_buckets(rows(("b", x)), F.col("d"), "x", touched={"b"}, keep_snapshots=1, keep_seconds=0)
    assert sorted(map(tuple, t.read("d string, x int").collect())) == [("a", 1), ("b", 5)]
    assert len([n for n in fs.list_dirs(spark, t.root) if n.startswith("snap-")]) == 2


def test_crash_between_snapshot_and_commit_keeps_the_table(spark, workdir, monkeypatch):
    t = SnapshotTable(spark, f"{workdir}/t")
    t.commit(spark.range(3).toDF("x"))
    with monkeypatch.context() as m:
        m.setattr(fs, "create_text", lambda *a: (_ for _ in ()).throw(OSError("killed")))
        with pytest.raises(OSError):
            t.commit(spark.range(9).toDF("x"))
    assert t.read().count() == 3
    t.commit(t.read().union(spark.range(1).toDF("x")))
    assert t.read().count() == 4


def test_second_writer_of_a_commit_fails(spark, workdir):
    t = SnapshotTable(spark, f"{workdir}/t")
    t.commit(spark.range(1).toDF("x"))
    assert not fs.create_text(spark, f"{workdir}/t/_commit-00000000", "other")
    assert t.read().count() == 1


def test_history_is_not_created_over_snapshots(spark, workdir):
    spark.createDataFrame([], HISTORY_SCHEMA).write.parquet(f"{workdir}/h/snap-1-a")
    with pytest.raises(RuntimeError, match="snapshots"):
        ensure_history(spark, f"{workdir}/h")


def test_old_snapshots_expire_but_never_the_live_one(spark, workdir):
    t = SnapshotTable(spark, f"{workdir}/t")
    for k in range(4):
        t.commit(spark.range(k + 1).toDF("x"), keep_snapshots=2, keep_seconds=0)
    assert len([n for n in fs.list_dirs(spark, t.root) if n.startswith("snap-")]) == 2
    assert t.read().count() == 4


def test_no_machine_local_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(Session())


def test_discovery_stays_in_its_database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS lw_mon")
    try:
        spark.range(3).write.saveAsTable("lw_mon.p_event_log")
        spark.range(5).write.saveAsTable("default.p_event_log")
        spark.range(7).createOrReplaceTempView("q_event_log")
        found = L.discover_in_catalog(spark, "lw_mon")
        assert found == ["`lw_mon`.`p_event_log`"]
        logs = L.logs_from_catalog(spark, found)
        assert {k: v.count() for k, v in logs.items()} == {"p": 3}
    finally:
        spark.catalog.dropTempView("q_event_log")
        spark.sql("DROP TABLE IF EXISTS default.p_event_log")
        spark.sql("DROP DATABASE IF EXISTS lw_mon CASCADE")


@pytest.mark.parametrize("xml, reason", [
    ("not xml at all", "malformed"),
    ("<TimeSeries><Period><timeInterval><start>2020-01-01T00:00Z</start>", "malformed"),
    ("<TimeSeries><Period><timeInterval/><resolution>PT60M</resolution>"
     "<Point><position>1</position><price.amount>1</price.amount></Point></Period></TimeSeries>", "start"),
    ("<TimeSeries><Period><timeInterval><start>2020-01-01T00:00Z</start></timeInterval>"
     "<resolution>PT60M</resolution><Point><position>1</position><price.amount>x</price.amount></Point>"
     "<Point><position>2</position><price.amount>4</price.amount></Point></Period></TimeSeries>", "number")])
def test_bad_series_fail_or_are_kept_aside(spark, xml, reason):
    df = spark.createDataFrame([(xml, dt.datetime(2020, 1, 1))], "x string, fetched_at timestamp")
    series = df.select(D.parse_series_xml(F.col("x"), D.PRICE_SERIES_SCHEMA).alias("series"), "fetched_at")
    with pytest.raises(Exception, match="Bad document"):
        D.decode_prices(series).collect()
    assert D.decode_prices(series, on_bad="quarantine").count() == 0
    assert reason in D.quarantined_series(series, D.PRICE_VALUE).first().reason


def test_truncated_price_file_fails(spark, workdir):
    body = ("<TimeSeries><in_Domain.mRID>z</in_Domain.mRID><Period><timeInterval><start>2020-01-01T00:00Z</start>"
            "</timeInterval><resolution>PT60M</resolution><Point><position>1</position><price.amount>4</price.amount>"
            "</Point></Period></TimeSeries>")
    write_file(f"{workdir}/x/a.xml", f"<Doc>{body}{body[:-40]}")
    series = D.read_series_xml(spark, f"{workdir}/x", D.PRICE_SERIES_SCHEMA, F.lit(None).cast("timestamp"))
    with pytest.raises(Exception, match="Bad document"):
        D.decode_prices(series).collect()


def test_weather_values_fail_one_by_one(spark):
    payload = ('{"latitude": 1, "longitude": 2, "hourly": {"time": ["2020-01-01T00:00", "2020-01-01T01:00", '
               '"2020-01-01T02:00"], "relative_humidity_2m": [80.0, 81, 80.5], "temperature_2m": [1.5, "n/a", 3]}}')
    df = spark.createDataFrame([(payload,), ('{"error": true, "reason": "limit"}',)], "j string")
    p = df.select(D.parse_weather_json(F.col("j")).alias("p")).select("p.*", F.lit(None).cast("timestamp").alias("fetched_at"))
    rows = D.decode_weather(p, on_bad="quarantine").orderBy("observation_time").collect()
    assert [r.humidity_pct for r in rows] == [80, 81, None]
    assert [r.temp_celsius for r in rows] == [1.5, None, 3.0]
    assert D.quarantined_payloads(p).first().reason == "API error: limit"
    with pytest.raises(Exception, match="API error"):
        D.decode_weather(p).collect()


_ZONE_SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from lakeward.session import build_session
from lakeward import queries as Q
from lakeward.operators import consolidate as C
from lakeward.operators.merge import HISTORY_SCHEMA
from lakeward.sources.event_logs import EVENT_LOG_SCHEMA
from pyspark.sql import functions as F
s = build_session("local[2]", shuffle_partitions=2)
s.sparkContext.setLogLevel("ERROR")
d = '{{"flow_progress":{{"data_quality":{{"expectations":[{{"dataset":"t","name":"r","passed_records":1,"failed_records":0}}]}}}}}}'
log = s.sql("SELECT named_struct('update_id', 'u2') AS origin, TIMESTAMP'2024-11-03 05:50:00 UTC' AS timestamp, "
            "'flow_progress' AS event_type, '" + d + "' AS details, 'f' AS flow_name")
hist = s.createDataFrame([], HISTORY_SCHEMA).unionByName(s.sql(
    "SELECT 'p' AS pipeline_name, 'u1' AS update_id, TIMESTAMP'2024-11-03 05:30:00 UTC' AS run_timestamp, "
    "DATE'2024-11-03' AS run_date, 't' AS table_name, 'r' AS expectation, 1L AS passed_records, "
    "0L AS failed_records, 0D AS fail_pct"))
out = [sorted(r.update_id for r in C.consolidate({{"p": log}}, hist, pushdown=p).collect()) for p in (True, False)]
sf = "/root/testdata/sf0.001"
for q in ("watermark_filter", "merge_upsert"):
    df = getattr(Q, q)(s, sf)
    row = df.select(F.count("*").alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("h")).first()
    out.append((row.n, str(row.h)))
print("RESULT", out)
"""


def test_results_do_not_depend_on_the_drivers_time_zone():
    said = set()
    for zone in ("UTC", "America/New_York", "Europe/London"):
        run = subprocess.run([sys.executable, "-c", _ZONE_SCRIPT.format(root=str(ROOT))], timeout=600,
                             env={**os.environ, "TZ": zone}, capture_output=True, text=True)
        lines = [x for x in run.stdout.splitlines() if x.startswith("RESULT")]
        assert lines, run.stderr[-2000:]
        said.add(lines[0])
    assert len(said) == 1 and "[['u2'], ['u2']" in said.pop()
