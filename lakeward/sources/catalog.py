"""Tables by name: catalog views over the live folders of the lake's tables.

A commit makes new folders live; ``publish`` points the table's name at them with one
``CREATE OR REPLACE VIEW``, which a catalog does atomically. A query that was analysed
before keeps reading the folders it found, which stay for the retention time of the table.
A job that dies between its commit and the publication leaves the name at the older state;
the next update of the table publishes before it reads. The view's text grows with the number of live
folders (some 70 bytes each), not with the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from lakeward.operators.merge import HISTORY_SCHEMA
from lakeward.plans.domains import DOMAINS, DomainSpec
from lakeward.sources import fs
from lakeward.sources.event_logs import EVENT_LOG_SCHEMA
from lakeward.sources.tables import BucketTable, SnapshotTable


def quoted(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def publish_folders(spark: SparkSession, name: str, schema: str | T.StructType, root: str, folders: Sequence[str]) -> None:
    """Point the view ``name`` at Parquet ``folders`` below ``root`` (none: an empty table).

    Columns are those of ``schema``; more columns in the files are not shown.
    """
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    if folders:
        inner = folders[0] if len(folders) == 1 else "{" + ",".join(folders) + "}"
        path = f"{root.rstrip('/')}/{inner}".replace("`", "``")
        columns = ", ".join(f"`{f.name}`" for f in fields)
        query = f"SELECT {columns} FROM parquet.`{path}`"
    else:
        empty = ", ".join(f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in fields)
        query = f"SELECT {empty} WHERE false"
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(name)} AS {query}")


class LakeCatalog:
    """The tables of a lake (``LakePaths``) as views of one database."""

    def __init__(self, spark: SparkSession, database: str, paths):
        self.spark, self.database, self.paths = spark, database, paths
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def publish_bronze(self, spec: DomainSpec) -> None:
        # One glob: batches that land later are part of the table without a new view.
        root = self.paths.bronze(spec)
        publish_folders(self.spark, self.name(spec.bronze_table), spec.bronze_schema, root,
                        ["batch-*"] if fs.list_dirs(self.spark, root) else [])

    def publish_silver(self, spec: DomainSpec) -> None:
        table = BucketTable(self.spark, self.paths.silver(spec))
        publish_folders(self.spark, self.name(spec.silver_table), spec.silver_schema, table.root,
                        list(table.folders().values()))

    def publish_event_log(self, spec: DomainSpec) -> None:
        root = self.paths.event_log(spec)
        publish_folders(self.spark, self.name(spec.event_log), EVENT_LOG_SCHEMA, root,
                        ["*"] if fs.list_dirs(self.spark, root) else [])

    def publish_history(self) -> None:
        table = SnapshotTable(self.spark, self.paths.history)
        live = table.current_path()
        publish_folders(self.spark, self.name(table.root.rpartition("/")[2]), HISTORY_SCHEMA, table.root,
                        [live.rpartition("/")[2]] if live else [])

    def publish(self, *specs: DomainSpec) -> None:
        for spec in specs or DOMAINS.values():
            self.publish_bronze(spec)
            self.publish_silver(spec)
            self.publish_event_log(spec)
        self.publish_history()
