"""Landed documents derived from the benchmark tables.

The engine's real inputs are market XML and weather JSON fetched from remote
services. To exercise the same decode -> landing -> bronze -> silver path on
data whose volume grows with the benchmark scale, these functions *encode*
rows of the driver tables as such documents, entirely with Spark expressions:

* ``orders``   -> one price ``TimeSeries`` per order (first period used),
* ``lineitem`` -> one generation ``TimeSeries`` per line (1-2 periods,
  consumption series when the line is returned),
* ``events``   -> one weather payload per event (3 hourly slots).

The mapping is simple arithmetic on the row so an independent SQL oracle can
compute the expected decoded rows straight from the same tables.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.functions.json_paths import expectations_details
from lakeward.functions.timestamps import format_instant

RESOLUTIONS = ("PT15M", "PT30M", "PT60M")


def _el(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))


def _num(c: Column) -> Column:
    return c.cast("string")


def _period(start: Column, resolution: Column, points: list[tuple[Column, Column]],
            value_tag: str) -> Column:
    pts = [_el("Point", F.concat(_el("position", _num(p)), _el(value_tag, _num(v))))
           for p, v in points]
    return _el("Period", F.concat(
        _el("timeInterval", _el("start", format_instant(start))),
        _el("resolution", resolution), *pts))


def price_documents(orders: DataFrame) -> DataFrame:
    """orders -> (doc_id, xml, fetched_at): one price TimeSeries per order."""
    o = orders
    start = F.col("o_orderdate").cast("timestamp")
    currency = F.when(F.col("o_orderstatus") == "P", "EUR").otherwise("GBP")
    zone = F.concat(F.lit("10Y"), F.substring("o_orderpriority", 1, 1), F.lit("-ZONE"))
    p1 = _period(start, F.lit("PT60M"), [
        (F.lit(1), F.col("o_totalprice") / 1000 - 20),
        (F.col("o_orderkey") % 3 + 2, F.col("o_totalprice") / 800 - 100),
    ], "price.amount")
    p2 = _period(start + F.expr("INTERVAL 1 DAY"), F.lit("PT30M"),
                 [(F.lit(1), F.col("o_totalprice") / 1000)], "price.amount")
    periods = (F.when(F.col("o_orderpriority") == "5-LOW", F.lit(""))
               .when(F.col("o_orderkey") % 2 == 0, F.concat(p1, p2))
               .otherwise(p1))
    xml = _el("TimeSeries", F.concat(_el("currency_Unit.name", currency),
                                     _el("in_Domain.mRID", zone), periods))
    fetched = start + F.make_dt_interval(F.lit(0), (F.col("o_custkey") % 36).cast("int"))
    return o.select(F.col("o_orderkey").alias("doc_id"), xml.alias("xml"),
                    fetched.alias("fetched_at"))


def generation_documents(lineitem: DataFrame) -> DataFrame:
    """lineitem -> (xml, fetched_at): one generation TimeSeries per line."""
    start = F.col("l_shipdate").cast("timestamp")
    res = F.element_at(F.array(*[F.lit(r) for r in RESOLUTIONS]),
                       (F.col("l_orderkey") % 3 + 1).cast("int"))
    zone = F.concat(F.lit("10YZ"), (F.col("l_suppkey") % 4).cast("string"))
    code = F.concat(F.lit("B"), F.lpad((F.col("l_partkey") % 27).cast("string"), 2, "0"))
    p1 = _period(start, res, [
        (F.col("l_linenumber"), F.col("l_quantity")),
        (F.col("l_linenumber") + 2, F.col("l_extendedprice") / 2),
    ], "quantity")
    p2 = _period(start + F.expr("INTERVAL 1 DAY"), F.lit("PT60M"),
                 [(F.lit(1), F.col("l_tax") * 100 - 4)], "quantity")
    periods = F.when(F.col("l_linenumber") % 2 == 0, F.concat(p1, p2)).otherwise(p1)
    out_domain = F.when(F.col("l_returnflag") == "R",
                        _el("outBiddingZone_Domain.mRID", zone)).otherwise(F.lit(""))
    xml = _el("TimeSeries", F.concat(
        _el("inBiddingZone_Domain.mRID", zone), out_domain,
        _el("MktPSRType", _el("psrType", code)), periods))
    fetched = start + F.make_dt_interval(F.lit(0), (F.col("l_partkey") % 48).cast("int"))
    return lineitem.select(xml.alias("xml"), fetched.alias("fetched_at"))


def weather_payloads(events: DataFrame) -> DataFrame:
    """events -> (json, fetched_at): one 3-hour weather payload per event.

    ``error`` events carry an empty ``time`` array (no rows); ``view`` events
    lack the apparent-temperature variable (NULL feels-like).
    """
    t0 = F.date_trunc("hour", F.col("ts").cast("timestamp"))
    hours = [t0 + F.make_dt_interval(F.lit(0), F.lit(h)) for h in range(3)]
    v = F.col("value")
    time_arr = F.when(F.col("event_type") == "error", F.array().cast("array<string>")) \
        .otherwise(F.array(*[F.date_format(h, "yyyy-MM-dd'T'HH:mm") for h in hours]))
    nul_d = F.lit(None).cast("double")
    nul_i = F.lit(None).cast("int")
    hourly = F.struct(
        time_arr.alias("time"),
        F.array(v / 5 - 30, v / 5 - 31, nul_d).alias("temperature_2m"),
        F.when(F.col("event_type") != "view", F.array(v / 5 - 33, v / 5 - 34, v / 5 - 35))
        .alias("apparent_temperature"),
        F.array((F.col("user_id") % 110).cast("int"), ((F.col("user_id") + 7) % 110).cast("int"),
                nul_i).alias("relative_humidity_2m"),
        F.array((v.cast("int") % 101).cast("int"), F.lit(50), F.lit(100)).alias("cloud_cover"),
        F.array(v / 10 - 2, v / 10, v / 10 + 1).alias("wind_speed_10m"),
        F.array((F.col("user_id") % 100).cast("int"), nul_i, F.lit(3)).alias("weather_code"))
    payload = F.struct((F.lit(51.5) + (F.col("user_id") % 10) / 100).alias("latitude"),
                       F.lit(-0.1278).alias("longitude"), hourly.alias("hourly"))
    return events.select(F.to_json(payload).alias("json"),
                         F.col("ts").cast("timestamp").alias("fetched_at"))


# The pipelines the benchmark events table is split into (one per event type).
EVENT_PIPELINES = ("click", "error", "purchase", "signup", "view")


def event_log_rows(events: DataFrame) -> DataFrame:
    """events -> event-log rows (plus ``event_kind`` = the source event type).

    * run (``update_id``) = day of the event and ``user_id % 3``;
    * ``value > 450`` marks a non-progress event (``user_action``);
    * ``k % 17 = 0`` (k from ``props``) has progress metrics but no counters,
      ``k % 23 = 0`` carries truncated (broken) JSON, ``k % 29 = 0`` lacks the
      second rule's ``failed_records``.
    """
    k = F.get_json_object("props", "$.k").cast("bigint")
    c1 = F.struct(F.concat(F.lit("bronze_"), F.col("event_type")).alias("dataset"),
                  F.lit("valid_value").alias("name"),
                  F.floor(F.col("value") * 10).cast("bigint").alias("passed_records"),
                  (F.col("user_id") % 4).alias("failed_records"))
    c2 = F.struct(F.concat(F.lit("silver_"), F.col("event_type")).alias("dataset"),
                  F.lit("plausible_value").alias("name"),
                  (F.col("event_id") % 50).alias("passed_records"),
                  F.when(k % 29 != 0, k % 7).alias("failed_records"))
    good = expectations_details(F.array(c1, c2))
    details = (F.when(k % 17 == 0, F.to_json(F.struct(F.struct(
                   F.struct(F.col("event_id").alias("num_output_rows")).alias("metrics"))
                   .alias("flow_progress"))))
               .when(k % 23 == 0, F.lit('{"flow_progress":{"data_quality":{"expectations":[{'))
               .otherwise(good))
    update_id = F.concat(F.lit("run-"), F.date_format("ts", "yyyy-MM-dd"), F.lit("-"),
                         (F.col("user_id") % 3).cast("string"))
    return events.select(
        F.struct(update_id.alias("update_id")).alias("origin"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.when(F.col("value") > 450, "user_action").otherwise("flow_progress").alias("event_type"),
        details.alias("details"),
        F.col("event_type").alias("event_kind"))


SERIES_PER_DOCUMENT = 2000


def prefixed(xml: Column, prefix: str) -> Column:
    """All elements of an XML text under a namespace prefix."""
    return F.regexp_replace(xml, "<(/?)", f"<$1{prefix}:")


def write_xml_documents(series: DataFrame, column: str, path: str, root: str,
                        namespace: str | None = None, prefix: str = "") -> None:
    """Land ``<TimeSeries>`` text rows as XML documents, one document per file.

    Up to ``SERIES_PER_DOCUMENT`` series of a task are wrapped in a root element, as a
    fetched market document is; with ``prefix`` all elements carry it. Nothing is collected.
    """
    write_spelled_documents(series.withColumn("spelling", F.lit("only")), column, path, root,
                            {"only": (namespace, prefix)})


def write_spelled_documents(series: DataFrame, column: str, path: str, root: str,
                            spellings: Mapping[str, tuple[str | None, str]]) -> None:
    """:func:`write_xml_documents` in several spellings (name -> namespace, prefix) by one pass.

    ``series`` names each row's in its column ``spelling``; a document holds series of one
    spelling, rows of none (NULL) are left out. Files are gzipped: a document is read whole,
    so nothing is lost by a form that cannot be split, and markup is most of its bytes.
    """
    import pyarrow as pa
    import pyarrow.compute as pc

    tags = {}
    for name, (namespace, prefix) in spellings.items():
        colon = f"{prefix}:" if prefix else ""
        bind = f' xmlns{":" + prefix if prefix else ""}="{namespace}"' if namespace else ""
        tags[name] = f"<{colon}{root}{bind}>", f"</{colon}{root}>"

    def wrap(batches):
        held = {name: pa.array([], pa.string()) for name in tags}

        def document(name: str, texts) -> pa.RecordBatch:
            if texts.null_count:
                raise ValueError("a series without text cannot be landed")
            body = pa.array(tags[name], pa.string())
            whole = pa.concat_arrays([body[:1], texts, body[1:]])
            return pa.RecordBatch.from_arrays([pc.binary_join(pa.ListArray.from_arrays(
                pa.array([0, len(whole)], pa.int32()), whole), "\n")], [column])

        for batch in batches:
            texts = batch.column(column).cast(pa.string())
            for name in tags:
                mine = pa.concat_arrays([held[name], texts.filter(pc.equal(batch.column("spelling"), name))])
                full = len(mine) // SERIES_PER_DOCUMENT * SERIES_PER_DOCUMENT
                for i in range(0, full, SERIES_PER_DOCUMENT):
                    yield document(name, mine[i:i + SERIES_PER_DOCUMENT])
                held[name] = mine[full:]
        for name, rest in held.items():
            if len(rest):
                yield document(name, rest)

    text = F.col(column)
    for name, (_, prefix) in spellings.items():
        if prefix:
            text = F.when(F.col("spelling") == name, prefixed(F.col(column), prefix)).otherwise(text)
    (series.select(text.alias(column), "spelling").mapInArrow(wrap, f"{column} string")
     .write.mode("overwrite").option("maxRecordsPerFile", 1).option("compression", "gzip").text(path))
