"""Helpers shared by the training-data operators: tables, words, lineage cuts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.session import release_shuffles, scratch_path
from lakeward.sources import fs

# White space of the word rule [^\x20\x09-\x0D]+ : space, tab, LF, VT, FF, CR.
SPACE_CHARS = " \t\n\x0b\f\r"
SPACE_CLASS = "[\\x20\\x09-\\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text in order; null or blank text: empty array."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_CLASS))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts lineage in storage that every executor can read, so a lost executor
    costs a re-read and never a recomputation of what came before.
    """
    spark, schema = df.sparkSession, df.schema
    path = scratch_path(spark, name)
    # Before the write as well: right after a job its last events still hold its plan.
    release_shuffles(spark)
    df.write.parquet(path)
    del df
    release_shuffles(spark)
    out = spark.read.schema(schema).parquet(path)
    out.cut_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``cut`` wrote, once what was made of them is itself written.

    Nothing recomputes from them then, also when an executor is lost.
    """
    for table in tables:
        fs.delete(table.sparkSession, table.cut_path)
