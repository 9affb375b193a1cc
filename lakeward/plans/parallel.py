"""Parallelism for CPU-heavy steps on inputs of few splits, as the caller's choice."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of ``df`` anew in partitions that AQE sizes from measured bytes.

    For callers that know their input has few splits (the benchmark tables are one
    file each) and spread narrow rows before a step that makes documents of them.
    The plan is the same for every size and master, and nothing runs to decide it.
    """
    return df.hint("rebalance")
