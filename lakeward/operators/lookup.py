"""Code lookups from a table: versioned codes, a default for unknown ones.

The fixed lists of ``functions.lookups`` are literal maps. A list that changes, or is too long for a
plan, lives in a table of ``code, valid_from`` and value columns. The version of a code is the
latest one that is valid at the given time, so the join never multiplies rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.operators.dedup import dedup_latest


def codes_at(codes: DataFrame, key: str, as_of: Column, valid_from: str = "valid_from") -> DataFrame:
    """One row per code: its latest version with ``valid_from`` at or before ``as_of`` (NULL: always valid)."""
    known = codes.where(F.col(key).isNotNull() & (F.col(valid_from).isNull() | (F.col(valid_from) <= as_of)))
    return dedup_latest(known, [key], order_by=valid_from).drop(valid_from)


def join_codes(rows: DataFrame, code: str, codes: DataFrame, key: str, defaults: Mapping[str, object]) -> DataFrame:
    """``rows`` with the columns of ``defaults`` from ``codes``; a code without an entry, or NULL, gets the defaults.

    ``codes`` has one row per code. There is no hint: the optimizer broadcasts the list while its
    measured size is below the session's threshold; beyond it the join is shuffled on the
    code, and adaptive execution splits the partition of a hot code.
    """
    listed = codes.select(F.col(key).alias("_code"), *[F.col(c).alias(f"_{c}") for c in defaults], F.lit(True).alias("_found"))
    joined = rows.join(listed, rows[code] == F.col("_code"), "left")
    return joined.select(*[rows[c] for c in rows.columns], *[
        F.when(F.col("_found"), F.col(f"_{c}")).otherwise(F.lit(v)).alias(c) for c, v in defaults.items()])
