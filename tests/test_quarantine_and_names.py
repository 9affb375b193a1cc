"""Quarantine beside silver, documents decoded once, tables by name."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from conftest import write_file
from lakeward.operators.lookup import codes_at, join_codes
from lakeward.plans.domains import PRICES, WEATHER
from lakeward.plans.dq_job import run_consolidation
from lakeward.plans.pipeline import LakePaths, read_quarantine, read_silver, read_silver_days, run_pipeline
from lakeward.sources.catalog import LakeCatalog
from lakeward.sources.event_logs import discover_in_catalog, logs_from_catalog, read_event_log
from lakeward.sources.tables import BucketTable
from lakeward.streaming.documents import land_documents, read_document_quarantine
from test_documents import GEN_DOC, PRICE_DOC, SERIES, WEATHER as WEATHER_DOC, price_document
from test_streaming import BAD, GOOD, HEADER


def quarantine_events(spark, paths, spec=PRICES):
    rows = read_event_log(spark, paths.event_log(spec)).where("event_type = 'quarantine_progress'").collect()
    return sorted((r.origin.update_id, json.loads(r.details)["quarantine_progress"]["num_records"]) for r in rows)


@pytest.mark.parametrize("incremental", [False, True])
def test_silver_and_quarantine_are_the_latest_rows(spark, workdir, incremental):
    paths = LakePaths(workdir)
    land = paths.landing(PRICES)
    write_file(f"{land}/a/a.csv", HEADER + GOOD + BAD)
    run_pipeline(spark, PRICES, paths, update_id="u1", drop_invalid=True, incremental=incremental)
    aside = read_quarantine(spark, PRICES, paths).collect()
    by_rules = sorted((tuple(r._failed_rules), r.delivery_start and r.delivery_start.hour) for r in aside)
    assert by_rules == [(("valid_bidding_zone", "valid_price"), 2), (("valid_delivery_start", "valid_bidding_zone"), None),
                        (("valid_price",), 1)]
    assert read_silver(spark, PRICES, paths).count() == 3
    # A later fetch mends one of the rows: it moves over, in the same commit.
    write_file(f"{land}/b/b.csv", HEADER + "2020-01-01 01:00:00+00:00,2020-01-01 02:00:00+00:00,9.0,GBP,10YGB----------A,"
               "2020-01-05 00:00:00+00:00\n")
    run_pipeline(spark, PRICES, paths, update_id="u2", drop_invalid=True, incremental=incremental)
    assert sorted(r._failed_rules[0] for r in read_quarantine(spark, PRICES, paths).collect()) == [
        "valid_bidding_zone", "valid_delivery_start"]
    assert read_silver(spark, PRICES, paths).where("price_gbp_per_mwh = 9.0").count() == 1
    table = BucketTable(spark, paths.silver(PRICES))
    assert not set(table.folders().values()) & set(table.folders(aside=True).values())
    events = quarantine_events(spark, paths)
    assert events[0] == ("u1", 3) and events[1][0] == "u2"
    # The other events are counted as before.
    assert run_consolidation(spark, paths.monitoring, paths.history) > 0


def test_documents_are_decoded_once_and_bad_ones_set_aside(spark, workdir):
    paths = LakePaths(workdir)
    raw = paths.raw(PRICES)
    write_file(f"{raw}/2020-01-01.xml", PRICE_DOC)
    write_file(f"{raw}/2020-01-02.xml", "Service unavailable")
    write_file(f"{raw}/2020-01-03.xml", price_document(SERIES + SERIES.replace("5.5", "n/a")))
    assert land_documents(spark, PRICES, paths, "u1") == [0]
    aside = read_document_quarantine(spark, PRICES, paths).collect()
    assert sorted(r.reason for r in aside) == ["malformed record", "value is no number"]
    assert any("n/a" in r.document and r.path.endswith("2020-01-03.xml") for r in aside)
    run_pipeline(spark, PRICES, paths, update_id="u1")
    assert read_silver(spark, PRICES, paths).count() == 3
    assert land_documents(spark, PRICES, paths, "u2") == []            # nothing new
    write_file(f"{raw}/2020-01-04.xml", GEN_DOC)                        # another document type
    assert land_documents(spark, PRICES, paths, "u3") == [1]
    assert sorted(r.reason for r in read_document_quarantine(spark, PRICES, paths).collect())[0] == "foreign namespace"
    assert quarantine_events(spark, paths) == [("u1", 2), ("u3", 1)]


def test_a_replayed_document_batch_lands_once(spark, tmp_path):
    paths = LakePaths(str(tmp_path))
    write_file(f"{paths.raw(WEATHER)}/a.json", WEATHER_DOC)
    write_file(f"{paths.raw(WEATHER)}/b.json", '{"error": true, "reason": "limit"}')
    assert land_documents(spark, WEATHER, paths, "u1") == [0]
    for f in (tmp_path / "_checkpoints" / "openmeteo_documents" / "commits").iterdir():  # killed before the commit
        f.unlink()
    assert land_documents(spark, WEATHER, paths, "u2") == [0]
    run_pipeline(spark, WEATHER, paths, update_id="u2")
    assert read_silver(spark, WEATHER, paths).count() == 3
    assert [r.reason for r in read_document_quarantine(spark, WEATHER, paths).collect()] == ["API error: limit"]
    assert quarantine_events(spark, paths, WEATHER) == [("u1", 1)]


def test_names_follow_the_commits(spark, workdir):
    paths = LakePaths(workdir)
    catalog = LakeCatalog(spark, "lw_names", paths)
    catalog.publish()
    silver, bronze, history = (catalog.name(t) for t in (PRICES.silver_table, PRICES.bronze_table, "dq_expectation_history"))
    assert [spark.table(t).count() for t in (silver, bronze, history)] == [0, 0, 0]
    assert spark.table(silver).columns == list(PRICES.silver_columns)
    write_file(f"{paths.landing(PRICES)}/a/a.csv", HEADER + GOOD)
    run_pipeline(spark, PRICES, paths, update_id="u1", incremental=True, catalog=catalog)
    old = spark.table(silver)
    assert (old.count(), spark.table(bronze).count()) == (2, 2)
    write_file(f"{paths.landing(PRICES)}/a/b.csv", HEADER + GOOD.replace("40.5", "41.5").replace("2020-01-02 13", "2020-01-03 13"))
    run_pipeline(spark, PRICES, paths, update_id="u2", incremental=True, catalog=catalog)
    assert old.where("price_gbp_per_mwh = 40.5").count() == 1           # the state it was analysed on
    assert spark.table(silver).where("price_gbp_per_mwh = 41.5").count() == 1 and spark.table(bronze).count() == 4
    logs = logs_from_catalog(spark, discover_in_catalog(spark, "lw_names"))
    assert run_consolidation(spark, paths.monitoring, paths.history, logs=logs, catalog=catalog) == spark.table(history).count() > 0
    assert run_consolidation(spark, paths.monitoring, paths.history, logs=logs, catalog=catalog) == 0
    spark.sql("DROP DATABASE lw_names CASCADE")


def test_a_name_points_at_many_folders_and_ignores_rows_set_aside(spark, workdir):
    paths = LakePaths(workdir)
    catalog = LakeCatalog(spark, "lw_many", paths)
    for day in (1, 2, 3):
        write_file(f"{paths.landing(PRICES)}/{day}/a.csv", HEADER + (GOOD + BAD).replace("2020-01-01", f"2020-01-0{day + 1}"))
        run_pipeline(spark, PRICES, paths, update_id=f"u{day}", incremental=True, drop_invalid=True, catalog=catalog)
    table = BucketTable(spark, paths.silver(PRICES))
    assert len(table.folders()) >= 3 and table.folders(aside=True)
    key = lambda df: sorted(map(tuple, df.collect()))
    assert key(spark.table(catalog.name(PRICES.silver_table))) == key(read_silver(spark, PRICES, paths))
    spark.sql("DROP DATABASE lw_many CASCADE")


@pytest.mark.parametrize("bucket, folders", [("day", 2), ("month", 1)])
def test_a_window_opens_its_folders_only(spark, workdir, bucket, folders):
    paths = LakePaths(workdir)
    days = [f"2020-0{m}-0{d}" for m in (1, 2) for d in (1, 2, 3)]
    for d in days:
        write_file(f"{paths.landing(PRICES)}/{d}/a.csv", HEADER + f"{d} 00:00:00+00:00,{d} 01:00:00+00:00,1.0,GBP,Z,{d} 13:00:00+00:00\n"
                   f"{d} 23:00:00+00:00,{d} 23:30:00+00:00,2.0,GBP,Z,{d} 13:00:00+00:00\n")
    run_pipeline(spark, PRICES, paths, update_id="u1", bucket=bucket)
    assert read_silver_days(spark, PRICES, LakePaths(workdir + "/none"), dt.date(2020, 2, 2), dt.date(2020, 2, 3)) is None
    rows = read_silver_days(spark, PRICES, paths, dt.date(2020, 2, 2), dt.date(2020, 2, 3))
    # 23:00 belongs to the delivery day after.
    assert sorted((r.delivery_start.day, r.delivery_start.hour) for r in rows.collect()) == [(1, 23), (2, 0), (2, 23), (3, 0)]
    opened = {f.rpartition("/")[0] for f in rows.inputFiles()}
    assert len(opened) == folders and all("2020-02" in f for f in opened)


def test_versioned_codes_with_defaults(spark, workdir):
    day = lambda y: dt.date(y, 1, 1)
    spark.createDataFrame([("a", day(2000), "old"), ("a", day(2010), "new"), ("a", day(2030), "later"), ("b", None, "always"),
                           ("c", day(2030), "later"), (None, day(2000), "nobody"), ("d", day(2000), None)],
                          "code string, valid_from date, name string").write.parquet(workdir)
    codes = codes_at(spark.read.parquet(workdir), "code", F.lit(day(2020)))
    rows = spark.createDataFrame([(i, c) for i, c in enumerate(["a", "b", "c", "d", None, "x", "a"])], "i int, code string")
    for threshold in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        try:
            got = join_codes(rows, "code", codes, "code", {"name": "Unknown"})
            assert [r.name for r in sorted(got.collect())] == ["new", "always", "Unknown", None, "Unknown", "Unknown", "new"]
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
