"""Decode landed market (XML) and weather (JSON) documents into tidy rows.

The decode runs on the executors: landed XML files are read as one row per document,
weather files by the JSON source, and an XML/JSON text column is parsed with
``from_xml`` / ``from_json``. The nested structure is flattened with ``explode`` /
``posexplode`` and document-level fields ride along on every row. No Python runs per row.

Market documents are matched by namespace, not by spelling (``lakeward.sources.namespaces``):
elements of the document type's namespace count whatever their prefix, all others do
not exist for the decode. A document whose root lies in another namespace has no rows and
is listed by ``quarantined_documents``.

A bad record fails the decode (``on_bad="fail"``, the default): a document that is
no well-formed XML or JSON or declares namespaces below its root, a number or position that
is missing or none, a period without a start or a known resolution, an API error
payload. Only what is decoded is judged: the first period of a price series, all periods
of a generation series, nothing of a consumption series. ``on_bad="quarantine"`` leaves
bad records out and ``quarantined_documents`` / ``quarantined_series`` /
``quarantined_payloads`` return them with the reason, so they can be kept and counted.
Numbers are read as text and cast one by one, so one bad value never empties its
neighbours.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeward.functions.durations import (RESOLUTION_PATTERN, resolution_minutes, slot_end,
                                          slot_start)
from lakeward.functions.lookups import production_type, weather_condition
from lakeward.functions.timestamps import parse_instant, parse_naive_utc, try_instant
from lakeward.sources.namespaces import in_namespace, root_problem, root_tag

# Namespaces and element names of the two market document types. Names
# containing dots are quoted.
PRICE_NAMESPACE = "urn:iec62325.351:tc57wg16:451-3:publicationdocument:7:3"
GENERATION_NAMESPACE = "urn:iec62325.351:tc57wg16:451-6:generationloaddocument:3:0"
_PERIOD = ("Period ARRAY<STRUCT<timeInterval: STRUCT<start: STRING>, resolution: STRING, "
           "Point: ARRAY<STRUCT<position: STRING, {value}: STRING>>>>, _corrupt STRING")
PRICE_SERIES_SCHEMA = ("`currency_Unit.name` STRING, `in_Domain.mRID` STRING, "
                       + _PERIOD.format(value="`price.amount`"))
GENERATION_SERIES_SCHEMA = ("`inBiddingZone_Domain.mRID` STRING, "
                            "`outBiddingZone_Domain.mRID` STRING, "
                            "MktPSRType STRUCT<psrType: STRING>, "
                            + _PERIOD.format(value="quantity"))
NAMESPACES = {PRICE_SERIES_SCHEMA: PRICE_NAMESPACE, GENERATION_SERIES_SCHEMA: GENERATION_NAMESPACE}
# Hourly variables of the weather payload (parallel arrays aligned with `time`).
WEATHER_PAYLOAD_SCHEMA = (
    "latitude STRING, longitude STRING, hourly STRUCT<time: ARRAY<STRING>, "
    "temperature_2m: ARRAY<STRING>, apparent_temperature: ARRAY<STRING>, "
    "relative_humidity_2m: ARRAY<STRING>, cloud_cover: ARRAY<STRING>, "
    "wind_speed_10m: ARRAY<STRING>, weather_code: ARRAY<STRING>>, "
    "error BOOLEAN, reason STRING, _corrupt STRING")
CORRUPT = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
DEFAULT_LOCATION = "london"

PRICE_COLUMNS = ("delivery_start", "delivery_end", "price_gbp_per_mwh", "currency",
                 "bidding_zone", "fetched_at")
GENERATION_COLUMNS = ("delivery_start", "delivery_end", "production_type_code",
                      "production_type", "quantity_mw", "bidding_zone", "fetched_at")
WEATHER_COLUMNS = ("observation_time", "location", "latitude", "longitude", "temp_celsius",
                   "feels_like_celsius", "humidity_pct", "clouds_pct", "wind_speed_ms",
                   "weather_main", "weather_description", "fetched_at")


def _fetched_at(fetched_at: Column | None) -> Column:
    # A landed file's modification time is when it was fetched.
    return fetched_at if fetched_at is not None else F.col("_metadata.file_modification_time")


def read_documents(spark: SparkSession, path: str, fetched_at: Column | None = None) -> DataFrame:
    """Landed XML files as fetched: ``document`` (the whole text), ``path`` and ``fetched_at``.

    A document is one API response, so a row is as bounded as the response was.
    """
    raw = spark.read.text(path, wholetext=True)
    return raw.select(F.col("value").alias("document"), F.col("_metadata.file_path").alias("path"),
                      _fetched_at(fetched_at).alias("fetched_at"))


def parse_documents(documents: DataFrame, schema: str, namespace: str | None = None) -> DataFrame:
    """``documents`` with ``root`` (its start tag), ``problem`` (null: sound) and ``series`` (an array).

    ``schema`` is that of one series; ``namespace`` defaults to the one of the document type.
    """
    namespace = namespace or NAMESPACES[schema]
    rooted = documents.withColumn("root", root_tag(F.col("document")))
    text = in_namespace(F.col("document"), F.col("root"), namespace)
    known = rooted.withColumn("problem", root_problem(F.col("document"), F.col("root"), namespace))
    foreign = F.col("problem") == FOREIGN
    # A broken document is malformed whatever its namespace.
    parsed = known.withColumn("parsed", F.when(F.col("problem").isNull() | foreign, F.from_xml(
        text, f"TimeSeries ARRAY<{_ddl(T.StructType.fromDDL(schema))}>, _corrupt STRING", CORRUPT)))
    broken = (F.col("problem").isNull() | foreign) & (F.col("parsed").isNull() | F.col("parsed._corrupt").isNotNull())
    return parsed.select(*rooted.columns, F.when(broken, MALFORMED).otherwise(F.col("problem")).alias("problem"),
                         F.when(F.col("problem").isNull(), F.col("parsed.TimeSeries")).alias("series"))


def _ddl(kind: T.DataType) -> str:
    """DDL of a type; field names may hold dots."""
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{_ddl(kind.elementType)}>"
    if isinstance(kind, T.StructType):
        return "STRUCT<" + ", ".join(f"`{f.name}`: {_ddl(f.dataType)}" for f in kind) + ">"
    return kind.simpleString()


FOREIGN, MALFORMED = "foreign namespace", "malformed record"


def document_series(parsed: DataFrame) -> DataFrame:
    """``series, document_problem, fetched_at``: one row per series, and one per bad document.

    Documents of another namespace have no series of ours and give no row.
    """
    # No filter on the problem alone: it would be pushed below the parse and judge every document twice.
    rows = parsed.select(F.when(F.col("problem") != FOREIGN, F.col("problem")).alias("document_problem"),
                         "fetched_at", _explode_present(F.col("series"), "series"))
    return rows.where(F.col("series").isNotNull() | F.col("document_problem").isNotNull())


def quarantined_documents(parsed: DataFrame) -> DataFrame:
    """``reason, root, document, fetched_at`` of the documents that give no series because of what they are."""
    return parsed.select(_explode_present(F.array("problem"), "reason"), "root", "document", "fetched_at").where(
        "reason IS NOT NULL")


def read_series_xml(spark: SparkSession, path: str, schema: str, fetched_at: Column | None = None,
                    namespace: str | None = None) -> DataFrame:
    """Series of the XML documents under ``path``: ``series, document_problem, fetched_at``."""
    return document_series(parse_documents(read_documents(spark, path, fetched_at), schema, namespace))


def parse_series_xml(xml_text: Column, schema: str) -> Column:
    """One ``<TimeSeries>`` element as text -> struct per ``schema``."""
    return F.from_xml(xml_text, schema, CORRUPT)


# What counts as a number in a document.
FLOAT_PATTERN = r"^\s*[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\s*$|^\s*[+-]?(?i)(nan|inf|infinity)\s*$"
INT_PATTERN = r"^\s*[+-]?[0-9]+\s*$"


def decoded_periods(series: Column, value: str) -> Column:
    """The periods of a series that are decoded: a price series' first, a generation series' all."""
    if value == PRICE_VALUE:
        return F.slice(series["Period"], 1, 1)
    return F.when(series["outBiddingZone_Domain.mRID"].isNull(), series["Period"])


def series_problem(series: Column, value: str, document_problem: Column | None = None) -> Column:
    """Why a parsed series cannot be decoded (null: it can)."""
    periods = decoded_periods(series, value)

    def some(check) -> Column:
        return F.coalesce(F.exists(periods, check), F.lit(False))

    def no_number(text: Column, pattern: str, kind: str) -> Column:
        return ~F.coalesce(text.rlike(pattern) & F.trim(text).try_cast(kind).isNotNull(), F.lit(False))

    start = lambda p: p["timeInterval"]["start"]
    bad_point = lambda x: no_number(x[value], FLOAT_PATTERN, "double") | no_number(x["position"], INT_PATTERN, "int")
    found = (F.when(series.isNull() | series["_corrupt"].isNotNull(), MALFORMED)
             .when(some(lambda p: start(p).isNull()), "period without a start")
             .when(some(lambda p: try_instant(start(p)).isNull()), "Unparseable instant")
             .when(some(lambda p: ~F.coalesce(p["resolution"].rlike(RESOLUTION_PATTERN), F.lit(False))),
                   "Unsupported resolution")
             .when(some(lambda p: F.exists(p["Point"], bad_point)), "value is no number"))
    return found if document_problem is None else F.coalesce(document_problem, found)


def _problem(series: DataFrame, value: str) -> Column:
    document = F.col("document_problem") if "document_problem" in series.columns else None
    return series_problem(F.col("series"), value, document)


def payload_problem(payload: DataFrame) -> Column:
    return (F.when(payload["_corrupt"].isNotNull(), "malformed record")
            .when(F.coalesce(payload["error"], F.lit(False)), F.concat(
                F.lit("API error: "), F.coalesce(payload["reason"], F.lit("no reason")))))


def _unless_bad(problem: Column, value: Column, on_bad: str) -> Column:
    """``value`` of a sound record; a bad one raises or (quarantine) gives null."""
    if on_bad not in ("fail", "quarantine"):
        raise ValueError(f"on_bad is {on_bad!r}, not 'fail' or 'quarantine'")
    sound = F.when(problem.isNull(), value)
    return sound if on_bad == "quarantine" else sound.otherwise(
        F.raise_error(F.concat(F.lit("Bad document: "), problem)))


PRICE_VALUE, GENERATION_VALUE = "price.amount", "quantity"


def quarantined_series(series: DataFrame, value: str) -> DataFrame:
    """``reason, series, fetched_at`` of the records that ``on_bad="quarantine"`` leaves out."""
    return series.select(_explode_present(F.array(_problem(series, value)), "reason"), "series", "fetched_at").where(
        "reason IS NOT NULL")


def quarantined_payloads(payloads: DataFrame) -> DataFrame:
    """``reason, raw, fetched_at`` of the weather records that cannot be decoded."""
    return payloads.select(_explode_present(F.array(payload_problem(payloads)), "reason"),
                           F.col("_corrupt").alias("raw"), "fetched_at").where("reason IS NOT NULL")


def _explode_present(arr: Column, alias: str) -> Column:
    """``explode`` for arrays computed from a parsed document.

    Plain ``explode`` makes Catalyst infer ``size(arr) > 0`` and push it below
    the projection, which evaluates the document parser a second time (and,
    behind a repartition, in the scan stage). ``explode_outer`` + a filter on the
    generated column keeps one parse per document; the rows are the same. The
    quarantines explode the array of their one reason for that: a filter on the reason
    itself would parse all documents in the few tasks that scan the table.
    """
    return F.explode_outer(arr).alias(alias)


def _points(periods: DataFrame, carried: list[str], value: str, alias: str) -> DataFrame:
    """One row per point of ``period``; start and resolution are parsed once per period."""
    parsed = periods.select(
        *carried, parse_instant(F.col("period.timeInterval.start")).alias("period_start"),
        F.when(F.size("period.Point") > 0, resolution_minutes(F.col("period.resolution"))).alias("step"),
        F.col("period.Point").alias("points"))
    pts = parsed.select(*carried, "period_start", "step", _explode_present(F.col("points"), "pt")).filter(
        F.col("pt").isNotNull())
    start = slot_start(F.col("period_start"), F.trim("pt.position").cast("int"), F.col("step"))
    return pts.select(start.alias("delivery_start"), slot_end(start, F.col("step")).alias("delivery_end"),
                      F.trim(F.col(f"pt.`{value}`")).cast("double").alias(alias), *carried)


def decode_prices(series: DataFrame, on_bad: str = "fail") -> DataFrame:
    """Price series -> one row per point of the series' FIRST period.

    Series without a period yield no rows; missing positions stay missing.
    """
    first = _unless_bad(_problem(series, PRICE_VALUE),
                        F.get(decoded_periods(F.col("series"), PRICE_VALUE), 0), on_bad)
    periods = series.select(F.col("series.`currency_Unit.name`").alias("currency"),
                            F.col("series.`in_Domain.mRID`").alias("bidding_zone"), "fetched_at",
                            first.alias("period"))
    return _points(periods, ["currency", "bidding_zone", "fetched_at"], PRICE_VALUE,
                   "price_gbp_per_mwh").select(*PRICE_COLUMNS)


def decode_generation(series: DataFrame, on_bad: str = "fail") -> DataFrame:
    """Generation series -> one row per period x point x production type.

    Consumption series (those carrying an out-domain) are skipped; every period
    of a series is decoded with its own start and resolution.
    """
    periods = decoded_periods(F.col("series"), GENERATION_VALUE)
    s = series.select(F.col("series.`inBiddingZone_Domain.mRID`").alias("bidding_zone"),
                      F.col("series.MktPSRType.psrType").alias("production_type_code"), "fetched_at",
                      _explode_present(_unless_bad(_problem(series, GENERATION_VALUE), periods, on_bad),
                                       "period"))
    rows = _points(s.filter(F.col("period").isNotNull()),
                   ["bidding_zone", "production_type_code", "fetched_at"], GENERATION_VALUE, "quantity_mw")
    return rows.withColumn("production_type", production_type(F.col("production_type_code"))).select(
        *GENERATION_COLUMNS)


def read_weather_json(spark: SparkSession, path: str, fetched_at: Column | None = None,
                      multi_line: bool = True) -> DataFrame:
    """Scan weather payload files.

    ``multi_line=True``: one (pretty-printed) JSON document per file, as fetched.
    ``False``: JSON Lines, one payload per line (splittable, for bulk landings).
    """
    raw = spark.read.schema(WEATHER_PAYLOAD_SCHEMA).options(**CORRUPT).option(
        "multiLine", multi_line).json(path)
    return raw.select("*", _fetched_at(fetched_at).alias("fetched_at"))


def parse_weather_json(json_text: Column) -> Column:
    return F.from_json(json_text, WEATHER_PAYLOAD_SCHEMA, CORRUPT)


def decode_weather(payloads: DataFrame, location: str | Column = DEFAULT_LOCATION,
                   on_bad: str = "fail", as_text: bool = False) -> DataFrame:
    """Weather payloads -> one row per hour.

    ``hourly.time`` drives the rows; every other variable is read by index and
    is NULL when its array (or the element) is missing — a missing variable
    never loses the hour. A payload without ``hourly`` yields no rows.

    ``as_text`` passes every number on as it stands in the payload, for landing: bronze
    casts it and keeps what does not fit in ``_rescued_data``, counted. Without it numbers
    are typed here: a whole number written as a float (80.0) is an integer, and a value
    that does not fit its column's type is NULL in its own hour only.
    """
    loc = F.lit(location) if isinstance(location, str) else location
    h = (payloads.select("latitude", "longitude", "fetched_at", "hourly",
                         F.posexplode_outer(_unless_bad(payload_problem(payloads), F.col("hourly.time"),
                                                        on_bad)).alias("i", "time"))
         .filter(F.col("i").isNotNull()))

    def text(name: str) -> Column:
        return F.get(F.col(f"hourly.{name}"), F.col("i"))

    def number(value: Column) -> Column:
        return value if as_text else value.try_cast("double")

    def whole(name: str) -> Column:
        value = text(name).try_cast("double")
        return F.when(value == F.floor(value), value.try_cast("int"))

    def count(name: str) -> Column:
        return text(name) if as_text else whole(name)

    cond = weather_condition(whole("weather_code"))
    return h.select(
        parse_naive_utc(F.col("time")).alias("observation_time"),
        loc.alias("location"),
        number(F.col("latitude")).alias("latitude"), number(F.col("longitude")).alias("longitude"),
        number(text("temperature_2m")).alias("temp_celsius"),
        number(text("apparent_temperature")).alias("feels_like_celsius"),
        count("relative_humidity_2m").alias("humidity_pct"),
        count("cloud_cover").alias("clouds_pct"),
        number(text("wind_speed_10m")).alias("wind_speed_ms"),
        cond["main"].alias("weather_main"),
        cond["description"].alias("weather_description"),
        "fetched_at")
