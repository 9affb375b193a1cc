from lakeward.session import checkpoint_root, ensure_utc, scratch_path


def test_checkpoint_root_is_stable_and_scratch_is_fresh(spark):
    root = checkpoint_root(spark)
    assert checkpoint_root(spark) == root
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a != b and a.startswith(root.rstrip("/"))


def test_session_is_utc(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/London")
    ensure_utc(spark)
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
