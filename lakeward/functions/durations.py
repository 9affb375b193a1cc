"""ISO-8601 period resolutions and settlement-slot arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the only resolution form the source documents use, e.g. PT15M, PT60M.
RESOLUTION_PATTERN = r"^PT([0-9]+)M$"


def resolution_minutes(resolution: Column | str) -> Column:
    """``PT<n>M`` -> n (INT). Any other text, or NULL, fails the query with a clear message."""
    res = F.col(resolution) if isinstance(resolution, str) else resolution
    digits = F.regexp_extract(res, RESOLUTION_PATTERN, 1)
    return (F.when(digits != "", digits.cast("int"))
            .otherwise(F.raise_error(F.concat(F.lit("Unsupported resolution: "),
                                              F.coalesce(res, F.lit("NULL")))))
            .cast("int"))


def minutes_interval(minutes: Column) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), minutes, F.lit(0))


def slot_start(period_start: Column, position: Column, minutes: Column) -> Column:
    """Start of point ``position`` (1-based) in a period: start + (position - 1) * step.

    Points are placed independently, so gaps in the position numbering stay gaps.
    """
    return period_start + minutes_interval((position - F.lit(1)) * minutes)


def slot_end(slot_start_col: Column, minutes: Column) -> Column:
    return slot_start_col + minutes_interval(minutes)
