"""Timestamp parsing for landed documents (all instants are UTC)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Instant forms used by the market documents ("2019-12-31T23:00Z"),
# with or without seconds, "Z" or a "+hh:mm" offset.
INSTANT_FORMATS = ("yyyy-MM-dd'T'HH:mmXXX", "yyyy-MM-dd'T'HH:mm:ssXXX",
                   "yyyy-MM-dd'T'HH:mm:ss.SSSXXX")


def try_instant(text: Column) -> Column:
    """ISO instant with a zone designator (``Z`` or an offset) -> TIMESTAMP, or NULL."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(fmt)) for fmt in INSTANT_FORMATS])


def parse_instant(text: Column) -> Column:
    """:func:`try_instant`, but text that matches none of the forms fails the query, as a bad document should."""
    parsed = try_instant(text)
    return (F.when(text.isNull(), F.lit(None).cast("timestamp"))
            .when(parsed.isNotNull(), parsed)
            .otherwise(F.raise_error(F.concat(F.lit("Unparseable instant: "), text)))
            .cast("timestamp"))


def parse_naive_utc(text: Column) -> Column:
    """Zone-less ISO local time (``2020-01-01T00:00``) read as a UTC instant."""
    return F.to_utc_timestamp(F.to_timestamp_ntz(text), "UTC")


def format_instant(ts: Column) -> Column:
    """TIMESTAMP -> ``yyyy-MM-ddTHH:mmZ`` text (UTC); used to build documents."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm"), F.lit("Z"))
