"""Session helpers: UTC clock, adaptive execution, shared scratch space."""

from __future__ import annotations

import gc
import io
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every lakeward job relies on. Time zone is pinned because day
# boundaries (delivery day, run_date) are defined in UTC.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app_name: str = "lakeward",
                  shuffle_partitions: int | None = None,
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session configured for lakeward jobs.

    On a cluster leave ``master`` unset and let spark-submit decide; tests pass
    ``local[*]`` and a small ``shuffle_partitions``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(CORE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_utc(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Pin the session clock to UTC (day boundaries and ``date(ts)`` depend on it)."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and job scratch space.

    Uses the cluster's ``spark.checkpoint.dir`` when it is configured. Only in a
    single-JVM session (``local[*]``) without it a fresh temporary folder is
    registered; on any other master a machine-local folder would be a different
    folder on every node, so the setting is required.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or \
        sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        configured = tempfile.mkdtemp(prefix="lakeward-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint root."""
    return f"{checkpoint_root(spark).rstrip('/')}/lakeward-scratch/{name}-{uuid.uuid4().hex[:12]}"


def release_shuffles(spark: SparkSession) -> None:
    """Let shuffle files of finished jobs go now, not when the driver next collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application.

    Needed where the package is on the driver's path only: the zipped package goes to the
    shared scratch folder, and Spark hands it to every worker.
    """
    from lakeward.sources import fs
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, str(f.relative_to(root.parent)))
    path = f"{scratch_path(spark, 'package')}/{root.name}.zip"
    fs.write_bytes(spark, path, held.getvalue())
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
