import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import write_file
from lakeward.sources import documents as D

NS_PRICE = "urn:iec62325.351:tc57wg16:451-3:publicationdocument:7:3"
NS_GEN = "urn:iec62325.351:tc57wg16:451-6:generationloaddocument:3:0"
FETCHED = dt.datetime(2020, 1, 2, 13, 30)

PRICE_DOC = f"""<?xml version="1.0" encoding="UTF-8"?>
<Publication_MarketDocument xmlns="{NS_PRICE}">
  <mRID>x</mRID>
  <TimeSeries>
    <currency_Unit.name>GBP</currency_Unit.name>
    <in_Domain.mRID codingScheme="A01">10YGB----------A</in_Domain.mRID>
    <Period>
      <timeInterval><start>2019-12-31T23:00Z</start><end>2020-01-01T23:00Z</end></timeInterval>
      <resolution>PT60M</resolution>
      <Point><position>1</position><price.amount>40.5</price.amount></Point>
      <Point><position>3</position><price.amount>-1.25</price.amount></Point>
    </Period>
    <Period>
      <timeInterval><start>2020-01-01T23:00Z</start></timeInterval>
      <resolution>PT60M</resolution>
      <Point><position>1</position><price.amount>99</price.amount></Point>
    </Period>
  </TimeSeries>
  <TimeSeries>
    <currency_Unit.name>GBP</currency_Unit.name>
    <in_Domain.mRID>10YGB----------A</in_Domain.mRID>
  </TimeSeries>
</Publication_MarketDocument>
"""

GEN_DOC = f"""<GL_MarketDocument xmlns="{NS_GEN}">
  <TimeSeries>
    <inBiddingZone_Domain.mRID>10YGB----------A</inBiddingZone_Domain.mRID>
    <MktPSRType><psrType>B16</psrType></MktPSRType>
    <Period>
      <timeInterval><start>2019-12-31T23:00Z</start></timeInterval>
      <resolution>PT30M</resolution>
      <Point><position>1</position><quantity>10</quantity></Point>
      <Point><position>2</position><quantity>12.5</quantity></Point>
    </Period>
    <Period>
      <timeInterval><start>2020-01-01T12:00Z</start></timeInterval>
      <resolution>PT15M</resolution>
      <Point><position>2</position><quantity>7</quantity></Point>
    </Period>
  </TimeSeries>
  <TimeSeries>
    <outBiddingZone_Domain.mRID>10YGB----------A</outBiddingZone_Domain.mRID>
    <MktPSRType><psrType>B10</psrType></MktPSRType>
    <Period>
      <timeInterval><start>2019-12-31T23:00Z</start></timeInterval>
      <resolution>PT60M</resolution>
      <Point><position>1</position><quantity>500</quantity></Point>
    </Period>
  </TimeSeries>
  <TimeSeries>
    <inBiddingZone_Domain.mRID>10YGB----------A</inBiddingZone_Domain.mRID>
    <MktPSRType><psrType>B77</psrType></MktPSRType>
    <Period>
      <timeInterval><start>2019-12-31T23:00Z</start></timeInterval>
      <resolution>PT60M</resolution>
      <Point><position>1</position><quantity>1</quantity></Point>
    </Period>
  </TimeSeries>
</GL_MarketDocument>
"""


def test_price_xml_first_period_only(spark, workdir):
    write_file(f"{workdir}/prices/2020-01-01.xml", PRICE_DOC)
    series = D.read_series_xml(spark, f"{workdir}/prices", D.PRICE_SERIES_SCHEMA, F.lit(FETCHED))
    rows = D.decode_prices(series).orderBy("delivery_start").collect()
    t0 = dt.datetime(2019, 12, 31, 23)
    assert [(r.delivery_start, r.delivery_end, r.price_gbp_per_mwh, r.currency, r.bidding_zone)
            for r in rows] == [
        (t0, t0 + dt.timedelta(hours=1), 40.5, "GBP", "10YGB----------A"),
        (t0 + dt.timedelta(hours=2), t0 + dt.timedelta(hours=3), -1.25, "GBP", "10YGB----------A")]
    assert {r.fetched_at for r in rows} == {FETCHED}


def test_generation_xml_all_periods_skip_consumption(spark, workdir):
    write_file(f"{workdir}/gen/2020-01-01.xml", GEN_DOC)
    series = D.read_series_xml(spark, f"{workdir}/gen", D.GENERATION_SERIES_SCHEMA, F.lit(FETCHED))
    rows = D.decode_generation(series).orderBy("production_type_code", "delivery_start").collect()
    t0 = dt.datetime(2019, 12, 31, 23)
    got = [(r.delivery_start, r.delivery_end, r.production_type_code, r.production_type, r.quantity_mw)
           for r in rows]
    assert got == [
        (t0, t0 + dt.timedelta(minutes=30), "B16", "Solar", 10.0),
        (t0 + dt.timedelta(minutes=30), t0 + dt.timedelta(minutes=60), "B16", "Solar", 12.5),
        (dt.datetime(2020, 1, 1, 12, 15), dt.datetime(2020, 1, 1, 12, 30), "B16", "Solar", 7.0),
        (t0, t0 + dt.timedelta(hours=1), "B77", "Unknown", 1.0)]


def test_bad_resolution_fails(spark, workdir):
    write_file(f"{workdir}/bad/x.xml", PRICE_DOC.replace("PT60M", "PT1H"))
    series = D.read_series_xml(spark, f"{workdir}/bad", D.PRICE_SERIES_SCHEMA, F.lit(FETCHED))
    with pytest.raises(Exception, match="Unsupported resolution"):
        D.decode_prices(series).collect()


def test_from_xml_text_column(spark):
    ts = PRICE_DOC.split("<TimeSeries>")[1].split("</TimeSeries>")[0]
    df = spark.createDataFrame([(f"<TimeSeries>{ts}</TimeSeries>", FETCHED)], "x string, fetched_at timestamp")
    series = df.select(D.parse_series_xml(F.col("x"), D.PRICE_SERIES_SCHEMA).alias("series"), "fetched_at")
    assert D.decode_prices(series).count() == 2


WEATHER = """{"latitude": 51.5, "longitude": -0.13, "hourly": {
  "time": ["2020-01-01T00:00", "2020-01-01T01:00", "2020-01-01T02:00"],
  "temperature_2m": [5.5, null, 4.0],
  "relative_humidity_2m": [80, 81, 82],
  "cloud_cover": [10, 20, 30],
  "wind_speed_10m": [3.0, 2.5, -1.0],
  "weather_code": [61, 4, null]}}"""


def test_weather_json_parallel_arrays(spark, workdir):
    write_file(f"{workdir}/w/a.json", WEATHER)
    write_file(f"{workdir}/w/b.json", '{"latitude": 1.0, "longitude": 2.0, "hourly": {"time": []}}')
    write_file(f"{workdir}/w/c.json", '{"latitude": 1.0, "longitude": 2.0}')
    payloads = D.read_weather_json(spark, f"{workdir}/w", F.lit(FETCHED))
    rows = D.decode_weather(payloads).orderBy("observation_time").collect()
    assert len(rows) == 3
    assert [r.temp_celsius for r in rows] == [5.5, None, 4.0]
    assert [r.feels_like_celsius for r in rows] == [None, None, None]   # variable missing
    assert [r.humidity_pct for r in rows] == [80, 81, 82]
    assert [(r.weather_main, r.weather_description) for r in rows] == [
        ("Rain", "slight rain"), ("Unknown", "unknown"), ("Unknown", "unknown")]
    assert rows[0].observation_time == dt.datetime(2020, 1, 1) and rows[0].location == "london"
    assert rows[0].latitude == 51.5


def test_price_first_period_without_points_gives_no_rows(spark):
    ts = ("<TimeSeries><currency_Unit.name>GBP</currency_Unit.name><in_Domain.mRID>Z</in_Domain.mRID>"
          "<Period><timeInterval><start>2020-01-01T00:00Z</start></timeInterval>"
          "<resolution>PT60M</resolution></Period>"
          "<Period><timeInterval><start>2020-01-02T00:00Z</start></timeInterval>"
          "<resolution>PT60M</resolution><Point><position>1</position>"
          "<price.amount>5</price.amount></Point></Period></TimeSeries>")
    df = spark.createDataFrame([(ts, FETCHED)], "x string, fetched_at timestamp")
    series = df.select(D.parse_series_xml(F.col("x"), D.PRICE_SERIES_SCHEMA).alias("series"), "fetched_at")
    assert D.decode_prices(series).count() == 0


# ---------------------------------------------------------------- namespaces and what is judged

def price_document(body: str, root='Publication_MarketDocument', attrs=f'xmlns="{NS_PRICE}"') -> str:
    return f"<{root} {attrs}>{body}</{root}>"


SERIES = ("<TimeSeries><currency_Unit.name>GBP</currency_Unit.name><in_Domain.mRID codingScheme='A01'>Z</in_Domain.mRID>"
          "<Period><timeInterval><start>2020-01-01T00:00Z</start></timeInterval><resolution>PT60M</resolution>"
          "<Point><position>1</position><price.amount>5.5</price.amount></Point></Period></TimeSeries>")


def parsed_prices(spark, *documents):
    df = spark.createDataFrame([(d, FETCHED) for d in documents], "document string, fetched_at timestamp")
    return D.parse_documents(df, D.PRICE_SERIES_SCHEMA)


def with_prefix(xml, prefix):
    import re
    return re.sub(r"<(/?)(?=[A-Za-z])", rf"<\1{prefix}:", xml)


SPELLINGS = {
    "default": price_document(SERIES),
    "byte order mark": "﻿" + price_document(SERIES),
    "declaration and comments": '<?xml version="1.0"?>\n<!-- a <b> -->\n<!DOCTYPE x>\n' + price_document(SERIES),
    "single quotes": price_document(SERIES, attrs=f"xmlns = '{NS_PRICE}'"),
    "prefix": with_prefix(price_document(SERIES, attrs=f'xmlns:a.b-c="{NS_PRICE}"'), "a.b-c"),
    "several prefixes": price_document(with_prefix(SERIES, "q"), "p:Doc", f'xmlns:p="{NS_PRICE}" xmlns:q="{NS_PRICE}"'),
    "more namespaces": price_document(SERIES + with_prefix(SERIES, "x"), attrs=f'xmlns:x="urn:x" xmlns="{NS_PRICE}"'),
}


@pytest.mark.parametrize("name", sorted(SPELLINGS))
def test_documents_are_matched_by_namespace(spark, name):
    rows = D.decode_prices(D.document_series(parsed_prices(spark, SPELLINGS[name]))).collect()
    assert [(r.price_gbp_per_mwh, r.currency, r.bidding_zone) for r in rows] == [(5.5, "GBP", "Z")]


def test_documents_that_hold_nothing_of_ours(spark):
    parsed = parsed_prices(
        spark, price_document(SERIES, attrs='xmlns="urn:foreign"'), price_document(SERIES, attrs=""),
        price_document(SERIES, "p:Doc", f'xmlns:p="{NS_PRICE}"'), price_document("<x/>"))
    assert D.decode_prices(D.document_series(parsed)).count() == 0
    assert [r.reason for r in D.quarantined_documents(parsed).collect()] == [D.FOREIGN] * 2


@pytest.mark.parametrize("document, reason", [
    (None, "malformed record"), ("", "malformed record"), ("Service unavailable", "malformed record"),
    (price_document(SERIES)[:-20], "malformed record"),
    (price_document(SERIES.replace("<TimeSeries>", f'<TimeSeries xmlns="{NS_PRICE}">')), "namespace declared below the root")])
def test_bad_documents_fail_or_are_set_aside(spark, document, reason):
    parsed = parsed_prices(spark, document, price_document(SERIES))
    with pytest.raises(Exception, match=f"Bad document: {reason}"):
        D.decode_prices(D.document_series(parsed)).collect()
    assert D.decode_prices(D.document_series(parsed), on_bad="quarantine").count() == 1
    assert [(r.reason, r.document) for r in D.quarantined_documents(parsed).collect()] == [(reason, document)]


def judged(spark, series, schema=D.PRICE_SERIES_SCHEMA):
    df = spark.createDataFrame([(series, FETCHED)], "x string, fetched_at timestamp")
    return df.select(D.parse_series_xml(F.col("x"), schema).alias("series"), "fetched_at")


PERIOD = SERIES[SERIES.index("<Period>"):SERIES.index("</TimeSeries>")]


@pytest.mark.parametrize("old, new, reason", [
    ("<price.amount>5.5</price.amount>", "", "value is no number"), ("<position>1</position>", "", "value is no number"),
    ("5.5", "5d", "value is no number"), ("5.5", "0x1p3", "value is no number"), (">1<", ">1.0<", "value is no number"),
    (">1<", ">99999999999<", "value is no number"), ("<start>2020-01-01T00:00Z</start>", "", "period without a start"),
    ("2020-01-01T00:00Z", "yesterday", "Unparseable instant"), ("PT60M", "PT1H", "Unsupported resolution"),
    ("<resolution>PT60M</resolution>", "", "Unsupported resolution")])
def test_bad_parts_of_a_decoded_period(spark, old, new, reason):
    series = judged(spark, SERIES.replace(old, new))
    with pytest.raises(Exception, match=reason):
        D.decode_prices(series).collect()
    assert D.decode_prices(series, on_bad="quarantine").count() == 0
    assert [r.reason for r in D.quarantined_series(series, D.PRICE_VALUE).collect()] == [reason]


@pytest.mark.parametrize("text, value", [(" 5.5 ", 5.5), ("+1e1", 10.0), (".5", 0.5), ("5.", 5.0), ("-0", 0.0)])
def test_numbers_as_the_source_reads_them(spark, text, value):
    assert [r.price_gbp_per_mwh for r in D.decode_prices(judged(spark, SERIES.replace("5.5", text))).collect()] == [value]


def test_parts_that_are_not_decoded_are_not_judged(spark):
    later = SERIES.replace("</TimeSeries>", PERIOD.replace("<start>2020-01-01T00:00Z</start>", "") + "</TimeSeries>")
    assert D.decode_prices(judged(spark, later)).count() == 1
    consumed = ("<TimeSeries><outBiddingZone_Domain.mRID>Z</outBiddingZone_Domain.mRID>"
                + PERIOD.replace("price.amount", "quantity").replace("5.5", "n/a") + "</TimeSeries>")
    assert D.decode_generation(judged(spark, consumed, D.GENERATION_SERIES_SCHEMA)).count() == 0
    made = consumed.replace("outBidding", "inBidding")
    with pytest.raises(Exception, match="value is no number"):
        D.decode_generation(judged(spark, made, D.GENERATION_SERIES_SCHEMA)).collect()


def test_weather_values_that_do_not_fit_reach_bronze_and_are_rescued(spark, workdir):
    from lakeward.plans.domains import WEATHER as SPEC
    from lakeward.plans.pipeline import LakePaths, land
    from lakeward.streaming.bronze import read_bronze, run_bronze
    payload = ('{"latitude": 51.5, "longitude": -0.13, "hourly": {"time": ["2020-01-01T00:00", "2020-01-01T01:00"],'
               '"temperature_2m": ["warm", 4.0], "relative_humidity_2m": [80, 80.5], "weather_code": [1.5, 3]}}')
    df = spark.createDataFrame([(payload, FETCHED)], "x string, fetched_at timestamp")
    payloads = df.select(D.parse_weather_json(F.col("x")).alias("p"), "fetched_at").select("p.*", "fetched_at")
    rows = D.decode_weather(payloads, as_text=True)
    assert [(r.temp_celsius, r.humidity_pct, r.weather_main) for r in rows.orderBy("observation_time").collect()] == [
        ("warm", "80", "Unknown"), ("4.0", "80.5", "Clouds")]
    paths = LakePaths(workdir)
    land(rows, SPEC, paths)
    run = run_bronze(spark, SPEC, paths.landing(SPEC), paths.bronze(SPEC), paths.checkpoint(SPEC),
                     paths.event_log(SPEC), "u1")
    bronze = read_bronze(spark, SPEC, paths.bronze(SPEC)).orderBy("observation_time").collect()
    assert [(r.temp_celsius, r.humidity_pct, r.latitude) for r in bronze] == [(None, 80, 51.5), (4.0, None, 51.5)]
    assert all(r._rescued_data for r in bronze)
    assert [c["failed_records"] for c in run.counters[0] if c["name"] == "no_rescued_data"] == [2]
