"""Reading expectation counters out of event-log JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Where the counters sit in an event's ``details`` JSON and their shape.
EXPECTATIONS_PATH = "$.flow_progress.data_quality.expectations"
EXPECTATIONS_SCHEMA = ("array<struct<dataset:string, name:string, "
                       "passed_records:bigint, failed_records:bigint>>")


def expectations_array(details: Column) -> Column:
    """``details`` JSON text -> array of expectation counter structs.

    Broken JSON, a missing path or a non-array value give NULL (so ``explode``
    yields no row for that event) instead of failing the job.
    """
    return F.from_json(F.get_json_object(details, EXPECTATIONS_PATH), EXPECTATIONS_SCHEMA)


def expectations_details(counters: Column) -> Column:
    """array<struct<dataset,name,passed_records,failed_records>> -> ``details`` JSON text."""
    return F.to_json(F.struct(F.struct(F.struct(counters.alias("expectations"))
                                       .alias("data_quality")).alias("flow_progress")))
