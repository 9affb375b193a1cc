import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from lakeward.session import build_session, checkpoint_root
    # One JVM and tiny tables: list folders on the driver, keep small partitions apart.
    s = build_session("local[4]", app_name="lakeward-tests", shuffle_partitions=4, extra_conf={
        "spark.sql.sources.parallelPartitionDiscovery.threshold": "100000",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k"})
    s.sparkContext.setLogLevel("ERROR")
    checkpoint_root(s)
    yield s


@pytest.fixture()
def workdir(spark):
    from lakeward.session import scratch_path
    return scratch_path(spark, "test")


def write_file(path: str, text: str) -> str:
    p = Path(path.replace("file:", "", 1) if path.startswith("file:") else path)
    p.parent.mkdir(parents=True, exist_ok=True)
    p.write_text(text)
    return str(p)
