from lakeward.operators.merge import HISTORY_SCHEMA
from lakeward.plans.dq_job import read_history, run_consolidation
from lakeward.sources import fs
from lakeward.sources.tables import SnapshotTable


def test_snapshot_commit_pointer_and_meta(spark, workdir):
    t = SnapshotTable(spark, f"{workdir}/t")
    assert not t.exists() and t.read() is None and t.current_meta() is None
    t.commit(spark.range(3).toDF("x"), meta="bronze_batch=4")
    assert t.current_meta() == "bronze_batch=4"
    first = t.current_path()
    # Rewrite the table from its own live snapshot (MERGE-style): new snapshot, pointer flips.
    t.commit(t.read().union(spark.range(10, 12).toDF("x")))
    assert t.current_path() != first and t.current_meta() == ""
    assert sorted(r.x for r in t.read().collect()) == [0, 1, 2, 10, 11]
    assert fs.exists(spark, first)          # old snapshot kept intact


def test_history_created_even_without_logs(spark, workdir):
    assert run_consolidation(spark, f"{workdir}/monitoring", f"{workdir}/monitoring/hist") == 0
    hist = read_history(spark, f"{workdir}/monitoring/hist")
    assert hist.schema == HISTORY_SCHEMA and hist.count() == 0
    assert SnapshotTable(spark, f"{workdir}/monitoring/hist").exists()


def test_folder_discovery_takes_only_event_logs(spark, workdir):
    from lakeward.sources.event_logs import discover_in_folder, logs_from_folder
    mon = f"{workdir}/mon"
    for name in ("b_event_log", "a_event_log", "dq_expectation_history", "event_log_backup"):
        spark.range(1).write.parquet(f"{mon}/{name}/part")
    assert discover_in_folder(spark, mon) == ["a_event_log", "b_event_log"]
    assert sorted(logs_from_folder(spark, mon)) == ["a", "b"]
