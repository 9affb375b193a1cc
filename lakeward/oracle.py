"""Independent SQL oracles (DuckDB dialect) for ``lakeward.queries``.

Each string runs on the benchmark tables registered as views and must return
the same rows (as a multiset) and column names as the Spark query of the same
key. The oracles compute results straight from the tables: decoded document
rows are produced arithmetically, not by parsing the documents.
"""

from __future__ import annotations

from lakeward.oracle_values import (CUSTOMER_RULES, GENERATION, LINEITEM_RULES, ORDERS_RULES, PRICES,
                                    PRODUCTION_TYPES, WEATHER, WEATHER_CODES)


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


PT_VALUES = "VALUES " + ", ".join(f"({_q(k)}, {_q(v)})" for k, v in PRODUCTION_TYPES.items())
WC_VALUES = "VALUES " + ", ".join(f"({k}, {_q(m)}, {_q(d)})" for k, (m, d) in WEATHER_CODES.items())
LOOKUP_CTES = (f"pt(code, name) AS ({PT_VALUES}), "
               f"wc(code, main, descr) AS ({WC_VALUES})")


def _rule_metrics_sql(tbl: str, rules: dict[str, str]) -> str:
    parts = []
    for name, pred in rules.items():
        parts.append(
            f"SELECT {_q(tbl)} AS table_name, {_q(name)} AS expectation, "
            f"count(*) FILTER (WHERE {pred}) AS passed_records, "
            f"count(*) - count(*) FILTER (WHERE {pred}) AS failed_records FROM {tbl}")
    return "\nUNION ALL\n".join(parts)


def _dedup_sql(select: str, source: str, keys: str, order: str) -> str:
    return (f"SELECT {select} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
            f"ORDER BY {order}) AS _rn FROM {source}) WHERE _rn = 1")


SQL: dict[str, str] = {}

SQL["dedup_latest_events"] = _dedup_sql(
    "user_id, event_type, event_id, value, props, ts AS ingested_at", "events",
    "user_id, event_type", "ts DESC NULLS LAST, event_id DESC NULLS LAST")

_LI_TIE = ", ".join(f"{c} DESC NULLS LAST" for c in (
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus"))
SQL["dedup_latest_lineitem"] = _dedup_sql(
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, "
    "l_tax, l_returnflag, l_linestatus, l_shipdate", "lineitem",
    "l_orderkey, l_linenumber", "l_shipdate DESC NULLS LAST, " + _LI_TIE)

SQL["dedup_null_keys"] = _dedup_sql(
    "user_key, event_type, event_id, ts AS ingested_at",
    "(SELECT *, nullif(user_id, 8) AS user_key FROM events)",
    "user_key, event_type", "ts DESC NULLS LAST, event_id DESC NULLS LAST")

SQL["expect_warn"] = "\nUNION ALL\n".join([
    _rule_metrics_sql("lineitem", LINEITEM_RULES),
    _rule_metrics_sql("orders", ORDERS_RULES),
    _rule_metrics_sql("customer", CUSTOMER_RULES)])

SQL["expect_drop"] = ("SELECT * FROM customer WHERE "
                      + " AND ".join(f"({p})" for p in CUSTOMER_RULES.values()))

SQL["decode_lookup"] = f"""
WITH {LOOKUP_CTES},
l AS (SELECT l_orderkey, l_linenumber,
             'B' || lpad(CAST(l_partkey % 27 AS VARCHAR), 2, '0') AS production_type_code,
             CASE WHEN l_suppkey % 11 <> 0 THEN CAST(l_partkey % 100 AS INTEGER) END AS weather_code
      FROM lineitem)
SELECT l.l_orderkey, l.l_linenumber, l.production_type_code, l.weather_code,
       coalesce(pt.name, 'Unknown') AS production_type,
       coalesce(wc.main, 'Unknown') AS weather_main,
       coalesce(wc.descr, 'unknown') AS weather_description
FROM l LEFT JOIN pt ON pt.code = l.production_type_code
       LEFT JOIN wc ON wc.code = l.weather_code
"""

_RES_CASE = ("CASE l_orderkey % 3 WHEN 0 THEN 'PT15M' WHEN 1 THEN 'PT30M' ELSE 'PT60M' END")
_MIN_CASE = "CASE l_orderkey % 3 WHEN 0 THEN 15 WHEN 1 THEN 30 ELSE 60 END"

SQL["slot_times"] = f"""
SELECT l_orderkey, l_linenumber, {_RES_CASE} AS resolution,
       l_shipdate + to_minutes(CAST((l_linenumber - 1) * {_MIN_CASE} AS BIGINT)) AS delivery_start,
       l_shipdate + to_minutes(CAST(l_linenumber * {_MIN_CASE} AS BIGINT)) AS delivery_end
FROM lineitem
"""

SQL["delivery_day"] = """
SELECT CAST(ts + INTERVAL 1 HOUR AS DATE) AS delivery_date, count(*) AS n_rows
FROM events GROUP BY 1
"""

SQL["calendar_day"] = f"""
SELECT calendar_date, n_rows,
       CAST(date_diff('day', calendar_date, DATE '2024-02-01') AS INTEGER) AS offset_days
FROM (SELECT CAST(ts AS DATE) AS calendar_date, count(*) AS n_rows FROM events GROUP BY 1)
"""

SQL["parallel_arrays"] = """
SELECT vec_id, label, pos, x, list_reverse(embedding)[pos + 1] AS x_mirror
FROM (SELECT vec_id, label, embedding,
             CAST(unnest(range(len(embedding))) AS INTEGER) AS pos, unnest(embedding) AS x
      FROM embeddings)
"""

_PRICE_BASE = """
SELECT *, CASE WHEN o_orderstatus = 'P' THEN 'EUR' ELSE 'GBP' END AS currency,
       '10Y' || substr(o_orderpriority, 1, 1) || '-ZONE' AS bidding_zone,
       o_orderdate + to_hours(CAST(o_custkey % 36 AS BIGINT)) AS fetched_at
FROM orders WHERE o_orderpriority IS DISTINCT FROM '5-LOW'
"""
PRICE_ROWS_SQL = f"""
WITH o AS ({_PRICE_BASE})
SELECT o_orderdate AS delivery_start, o_orderdate + INTERVAL 60 MINUTE AS delivery_end,
       o_totalprice / 1000 - 20 AS price_gbp_per_mwh, currency, bidding_zone, fetched_at FROM o
UNION ALL
SELECT o_orderdate + to_minutes(CAST((o_orderkey % 3 + 1) * 60 AS BIGINT)),
       o_orderdate + to_minutes(CAST((o_orderkey % 3 + 2) * 60 AS BIGINT)),
       o_totalprice / 800 - 100, currency, bidding_zone, fetched_at FROM o
"""
SQL["decode_price_xml"] = PRICE_ROWS_SQL

GENERATION_ROWS_SQL = f"""
WITH {LOOKUP_CTES},
l AS (SELECT *, {_MIN_CASE} AS m,
             '10YZ' || CAST(l_suppkey % 4 AS VARCHAR) AS bidding_zone,
             'B' || lpad(CAST(l_partkey % 27 AS VARCHAR), 2, '0') AS production_type_code,
             l_shipdate + to_hours(CAST(l_partkey % 48 AS BIGINT)) AS fetched_at
      FROM lineitem WHERE l_returnflag IS DISTINCT FROM 'R'),
p AS (
  SELECT l_shipdate + to_minutes(CAST((l_linenumber - 1) * m AS BIGINT)) AS delivery_start,
         l_shipdate + to_minutes(CAST(l_linenumber * m AS BIGINT)) AS delivery_end,
         production_type_code, l_quantity AS quantity_mw, bidding_zone, fetched_at FROM l
  UNION ALL
  SELECT l_shipdate + to_minutes(CAST((l_linenumber + 1) * m AS BIGINT)),
         l_shipdate + to_minutes(CAST((l_linenumber + 2) * m AS BIGINT)),
         production_type_code, l_extendedprice / 2, bidding_zone, fetched_at FROM l
  UNION ALL
  SELECT l_shipdate + INTERVAL 1 DAY, l_shipdate + INTERVAL 1 DAY + INTERVAL 60 MINUTE,
         production_type_code, l_tax * 100 - 4, bidding_zone, fetched_at
  FROM l WHERE l_linenumber % 2 = 0)
SELECT delivery_start, delivery_end, p.production_type_code,
       coalesce(pt.name, 'Unknown') AS production_type, quantity_mw, bidding_zone, fetched_at
FROM p LEFT JOIN pt ON pt.code = p.production_type_code
"""
SQL["decode_generation_xml"] = GENERATION_ROWS_SQL

WEATHER_ROWS_SQL = f"""
WITH {LOOKUP_CTES},
e AS (SELECT *, date_trunc('hour', ts) AS t0 FROM events
      WHERE event_type IS DISTINCT FROM 'error'),
h AS (SELECT e.*, unnest([0, 1, 2]) AS i FROM e),
r AS (
  SELECT t0 + to_hours(CAST(i AS BIGINT)) AS observation_time,
         'london' AS location,
         51.5 + (user_id % 10) / 100 AS latitude,
         CAST(-0.1278 AS DOUBLE) AS longitude,
         CASE i WHEN 0 THEN value / 5 - 30 WHEN 1 THEN value / 5 - 31 END AS temp_celsius,
         CASE WHEN event_type = 'view' THEN NULL
              ELSE CASE i WHEN 0 THEN value / 5 - 33 WHEN 1 THEN value / 5 - 34
                          ELSE value / 5 - 35 END END AS feels_like_celsius,
         CASE i WHEN 0 THEN CAST(user_id % 110 AS INTEGER)
                WHEN 1 THEN CAST((user_id + 7) % 110 AS INTEGER) END AS humidity_pct,
         CASE i WHEN 0 THEN CAST(CAST(trunc(value) AS BIGINT) % 101 AS INTEGER)
                WHEN 1 THEN 50 ELSE 100 END AS clouds_pct,
         CASE i WHEN 0 THEN value / 10 - 2 WHEN 1 THEN value / 10 ELSE value / 10 + 1 END
           AS wind_speed_ms,
         CASE i WHEN 0 THEN CAST(user_id % 100 AS INTEGER) WHEN 2 THEN 3 END AS code,
         ts AS fetched_at
  FROM h)
SELECT observation_time, location, latitude, longitude, temp_celsius, feels_like_celsius,
       humidity_pct, clouds_pct, wind_speed_ms,
       coalesce(wc.main, 'Unknown') AS weather_main,
       coalesce(wc.descr, 'unknown') AS weather_description, fetched_at
FROM r LEFT JOIN wc ON wc.code = r.code
"""
SQL["decode_bad_documents"] = """
WITH o AS (SELECT CASE WHEN o_orderkey % 17 = 0 OR o_orderkey % 13 = 0 THEN 'malformed record'
    WHEN o_orderpriority = '5-LOW' THEN 'no period'
    WHEN o_orderkey % 11 = 0 THEN 'value is no number'
    WHEN o_orderkey % 19 = 0 THEN 'period without a start' ELSE 'decoded rows' END AS reason FROM orders),
e AS (SELECT CASE WHEN event_id % 7 <> 0 THEN 'decoded rows' WHEN event_id % 2 = 0 THEN 'API error: limit'
    ELSE 'malformed record' END AS reason, event_type FROM events)
SELECT 'price' AS source, reason, CAST(count(*) * CASE reason WHEN 'decoded rows' THEN 2 ELSE 1 END AS BIGINT) AS n
FROM o WHERE reason <> 'no period' GROUP BY reason
UNION ALL SELECT 'weather', reason, CAST(count(*) * CASE reason WHEN 'decoded rows' THEN 3 ELSE 1 END AS BIGINT)
FROM e WHERE reason <> 'decoded rows' OR event_type <> 'error' GROUP BY reason"""

SQL["decode_weather_json"] = WEATHER_ROWS_SQL

# ---------------------------------------------------------------------------
# Event logs and consolidation
# ---------------------------------------------------------------------------

_EV = """
ev AS (SELECT event_type AS pipeline_name,
              'run-' || strftime(ts, '%Y-%m-%d') || '-' || CAST(user_id % 3 AS VARCHAR) AS update_id,
              ts, CASE WHEN value > 450 THEN 'user_action' ELSE 'flow_progress' END AS et,
              CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
              value, user_id, event_id, event_type
       FROM events)"""

_X = """
x AS (SELECT pipeline_name, update_id, ts, et, 'bronze_' || event_type AS table_name,
             'valid_value' AS expectation, CAST(floor(value * 10) AS BIGINT) AS p,
             user_id % 4 AS f
      FROM ev WHERE k % 17 <> 0 AND k % 23 <> 0
      UNION ALL
      SELECT pipeline_name, update_id, ts, et, 'silver_' || event_type, 'plausible_value',
             event_id % 50, CASE WHEN k % 29 <> 0 THEN k % 7 END
      FROM ev WHERE k % 17 <> 0 AND k % 23 <> 0)"""


def _agg(src: str) -> str:
    return f"""SELECT pipeline_name, update_id, max(ts) AS run_timestamp,
       CAST(max(ts) AS DATE) AS run_date, table_name, expectation,
       CAST(sum(p) AS BIGINT) AS passed_records, CAST(sum(f) AS BIGINT) AS failed_records,
       CAST((sum(f) * 20000 + (sum(p) + sum(f))) // (2 * nullif(sum(p) + sum(f), 0)) AS DOUBLE)
         / 100 AS fail_pct
FROM {src} GROUP BY pipeline_name, update_id, table_name, expectation"""


SQL["union_tagged"] = f"""WITH {_EV}
SELECT pipeline_name, update_id, ts, et AS event_type FROM ev"""

SQL["json_explode"] = f"""WITH {_EV}, {_X}
SELECT pipeline_name, update_id, ts, table_name, expectation, p AS passed_records,
       f AS failed_records FROM x"""

SQL["dq_consolidate"] = f"""WITH {_EV}, {_X}
{_agg("(SELECT * FROM x WHERE et = 'flow_progress')")}"""
SQL["dq_consolidate_join"] = SQL["dq_consolidate"]
SQL["consolidate_rerun"] = SQL["dq_consolidate"]

SQL["watermark_max"] = f"""WITH {_EV}, {_X}
SELECT pipeline_name, max(ts) AS watermark FROM x WHERE et = 'flow_progress'
GROUP BY pipeline_name"""

_CUT = "TIMESTAMP '2024-01-15 00:00:00'"

SQL["watermark_filter"] = f"""WITH {_EV},
wm AS (SELECT event_type AS pipeline_name, max(ts) AS watermark FROM events
       WHERE ts < {_CUT} AND event_type <> 'signup' GROUP BY 1)
SELECT ev.pipeline_name, update_id, ts FROM ev LEFT JOIN wm USING (pipeline_name)
WHERE et = 'flow_progress' AND ts > coalesce(watermark, TIMESTAMP '1900-01-01')"""

SQL["merge_upsert"] = f"""WITH {_EV}, {_X},
h1 AS ({_agg(f"(SELECT * FROM x WHERE et = 'flow_progress' AND ts < {_CUT})")}),
wm AS (SELECT pipeline_name, max(run_timestamp) AS watermark FROM h1 GROUP BY 1),
s2 AS ({_agg('''(SELECT x.* FROM x LEFT JOIN wm USING (pipeline_name)
                 WHERE et = 'flow_progress'
                   AND ts > coalesce(watermark, TIMESTAMP '1900-01-01'))''')})
SELECT * FROM h1 WHERE NOT EXISTS (
  SELECT 1 FROM s2 WHERE s2.pipeline_name = h1.pipeline_name AND s2.update_id = h1.update_id
    AND s2.table_name = h1.table_name AND s2.expectation = h1.expectation)
UNION ALL SELECT * FROM s2"""

SQL["fail_pct"] = """
SELECT user_id, n - f AS passed_records, f AS failed_records,
       CAST((f * 20000 + n) // (2 * nullif(n, 0)) AS DOUBLE) / 100 AS fail_pct
FROM (SELECT user_id, count(*) FILTER (WHERE event_type = 'error') AS f, count(*) AS n
      FROM events GROUP BY user_id)"""

SQL["discover_logs"] = """
SELECT event_type AS pipeline_name, count(*) AS n_events FROM events GROUP BY 1"""

SQL["event_log_roundtrip"] = _rule_metrics_sql("lineitem", LINEITEM_RULES)

# ---------------------------------------------------------------------------
# Medallion
# ---------------------------------------------------------------------------

SQL["bronze_stream_ingest"] = f"""
SELECT *, CAST(NULL AS VARCHAR) AS _rescued_data FROM ({PRICE_ROWS_SQL})"""


def _silver_sql(spec, rows_sql: str) -> str:
    order = ", ".join([f"{spec.order_column} DESC NULLS LAST"]
                      + [f"{c} DESC NULLS LAST" for c in spec.tiebreak])
    cols = ", ".join(f"{c} AS ingested_at" if c == spec.order_column else c
                     for c in spec.column_names)
    return _dedup_sql(cols, f"({rows_sql})", ", ".join(spec.keys), order)


SQL["silver_prices"] = _silver_sql(PRICES, PRICE_ROWS_SQL)
SQL["silver_generation"] = _silver_sql(GENERATION, GENERATION_ROWS_SQL)
SQL["silver_weather"] = _silver_sql(WEATHER, WEATHER_ROWS_SQL)


def _counts_sql(pipeline: str, tbl: str, rules: dict[str, str], source: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {_q(pipeline)} AS pipeline_name, {_q(tbl)} AS table_name, {_q(n)} AS expectation, "
        f"count(*) FILTER (WHERE {p}) AS p, count(*) - count(*) FILTER (WHERE {p}) AS f "
        f"FROM {source}" for n, p in rules.items())


def _with_pct(counts: str) -> str:
    return f"""SELECT pipeline_name, table_name, expectation, p AS passed_records,
       f AS failed_records,
       CAST((f * 20000 + (p + f)) // (2 * nullif(p + f, 0)) AS DOUBLE) / 100 AS fail_pct
FROM ({counts})"""


_pdq = []
for _spec, _rows in ((PRICES, PRICE_ROWS_SQL), (GENERATION, GENERATION_ROWS_SQL),
                     (WEATHER, WEATHER_ROWS_SQL)):
    _pdq.append(_counts_sql(_spec.pipeline, _spec.bronze_table, _spec.bronze_rules,
                            f"(SELECT *, CAST(NULL AS VARCHAR) AS _rescued_data FROM ({_rows}))"))
    _pdq.append(_counts_sql(_spec.pipeline, _spec.silver_table, _spec.silver_rules,
                            f"({_silver_sql(_spec, _rows)})"))
SQL["medallion_dq"] = _with_pct("\nUNION ALL\n".join(_pdq))

_RESCUE_RULES = {
    "no_rescued_data": "NOT (o_orderkey % 10 = 0 OR o_orderkey % 11 = 0)",
    "valid_delivery_start": "o_orderkey % 13 <> 0",
    "valid_bidding_zone": "o_orderkey % 7 <> 0",
}
SQL["bronze_rescue"] = f"""
SELECT table_name, expectation, p AS passed_records, f AS failed_records FROM (
{_counts_sql(PRICES.pipeline, PRICES.bronze_table, _RESCUE_RULES, "orders")})"""

SQL["incremental_silver"] = SQL["dedup_latest_events"]

_DAY = "2024-01-15"
SQL["delivery_window"] = f"""
SELECT event_id, user_id, event_type, ts FROM events
WHERE ts >= TIMESTAMP '{_DAY}' - INTERVAL 1 HOUR AND ts < TIMESTAMP '{_DAY}' + INTERVAL 23 HOUR"""
SQL["calendar_window"] = f"""
SELECT event_id, user_id, event_type, ts FROM events WHERE CAST(ts AS DATE) = DATE '{_DAY}'"""

SQL["silver_drop_invalid"] = f"""
WITH b AS (
  SELECT CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate END AS delivery_start,
         o_orderdate + INTERVAL 1 HOUR AS delivery_end,
         CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice / 1000 - 20 END AS price_gbp_per_mwh,
         'GBP' AS currency,
         CASE WHEN o_orderkey % 7 <> 0 THEN '10Y' || substr(o_orderpriority, 1, 1) END AS bidding_zone,
         CASE WHEN o_orderkey % 11 <> 0
              THEN o_orderdate + to_hours(CAST(o_custkey % 36 AS BIGINT)) END AS fetched_at
  FROM orders),
s AS ({_silver_sql(PRICES, "SELECT * FROM b")})
SELECT * FROM s WHERE {" AND ".join(f"({p})" for p in PRICES.silver_drop_rules.values())}"""
SQL["silver_incremental"] = SQL["silver_prices"]


def _without_fetch(rows_sql: str, columns) -> str:
    cols = ", ".join("CAST(NULL AS TIMESTAMP) AS fetched_at" if c == "fetched_at" else c
                     for c in columns)
    return f"SELECT {cols} FROM ({rows_sql})"


SQL["scan_price_xml_files"] = _without_fetch(PRICE_ROWS_SQL, PRICES.column_names)
SQL["scan_generation_xml_files"] = _without_fetch(GENERATION_ROWS_SQL, GENERATION.column_names)
SQL["scan_weather_json_files"] = _without_fetch(WEATHER_ROWS_SQL, WEATHER.column_names)

_NULLS = "CAST(NULL AS TIMESTAMP) AS delivery_start, CAST(NULL AS TIMESTAMP) AS delivery_end, CAST(NULL AS DOUBLE) AS price_gbp_per_mwh"
SQL["decode_namespaces"] = f"""
WITH o AS (SELECT *, CASE WHEN o_orderstatus = 'P' THEN 'EUR' ELSE 'GBP' END AS currency,
                  '10Y' || substr(o_orderpriority, 1, 1) || '-ZONE' AS bidding_zone,
                  o_orderdate + to_hours(CAST(o_custkey % 36 AS BIGINT)) AS fetched_at FROM orders),
d AS (SELECT * FROM o WHERE o_orderpriority IS DISTINCT FROM '5-LOW' AND o_orderkey % 6 IN (0, 1, 2))
SELECT 'decoded' AS reason, CAST(NULL AS VARCHAR) AS document_id, o_orderdate AS delivery_start,
       o_orderdate + INTERVAL 60 MINUTE AS delivery_end, o_totalprice / 1000 - 20 AS price_gbp_per_mwh,
       currency, bidding_zone, fetched_at FROM d
UNION ALL
SELECT 'decoded', NULL, o_orderdate + to_minutes(CAST((o_orderkey % 3 + 1) * 60 AS BIGINT)),
       o_orderdate + to_minutes(CAST((o_orderkey % 3 + 2) * 60 AS BIGINT)), o_totalprice / 800 - 100,
       currency, bidding_zone, fetched_at FROM d
UNION ALL
SELECT CASE o_orderkey % 6 WHEN 3 THEN 'foreign namespace' ELSE 'namespace declared below the root' END,
       'order-' || CAST(o_orderkey AS VARCHAR), {_NULLS}, NULL, NULL, fetched_at
FROM o WHERE o_orderkey % 6 IN (3, 5)"""

SQL["decode_judged_parts"] = f"""
WITH o AS (SELECT *, CASE WHEN o_orderkey % 7 = 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'decoded' ELSE 'period without a start' END
        WHEN o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 OR o_orderkey % 17 = 0 THEN 'value is no number'
        WHEN o_orderkey % 19 = 0 THEN 'Unsupported resolution' ELSE 'decoded' END AS reason FROM ({_PRICE_BASE}))
SELECT 'price' AS source, reason, o_orderdate AS delivery_start, o_totalprice / 1000 - 20 AS value, bidding_zone, fetched_at
FROM o WHERE reason = 'decoded'
UNION ALL SELECT 'price', reason, o_orderdate + to_minutes(CAST((o_orderkey % 3 + 1) * 60 AS BIGINT)),
       o_totalprice / 800 - 100, bidding_zone, fetched_at FROM o WHERE reason = 'decoded'
UNION ALL SELECT 'price', reason, NULL, NULL, bidding_zone, fetched_at FROM o WHERE reason <> 'decoded'
UNION ALL SELECT 'generation', 'decoded', delivery_start, quantity_mw, bidding_zone, fetched_at FROM ({GENERATION_ROWS_SQL})"""

SQL["bronze_by_header"] = """
SELECT o_orderdate AS delivery_start, o_orderdate + INTERVAL 1 HOUR AS delivery_end,
       CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice / 1000 END AS price_gbp_per_mwh,
       CASE WHEN o_orderkey % 3 = 1 THEN NULL WHEN o_orderkey % 4 = 1 THEN 'G,"BP"' ELSE 'GBP' END AS currency,
       '10Y' || substr(o_orderpriority, 1, 1) AS bidding_zone,
       CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate END AS fetched_at,
       CASE WHEN o_orderkey % 10 = 0 THEN 'n/a' END AS rescued_price_gbp_per_mwh,
       CASE WHEN o_orderkey % 11 = 0 THEN 'yesterday' END AS rescued_fetched_at,
       CASE WHEN o_orderkey % 3 = 2 THEN o_orderpriority END AS rescued_source,
       CASE WHEN o_orderkey % 3 = 2 THEN CAST(o_orderkey AS VARCHAR) END AS rescued_order_no,
       CAST(NULL AS VARCHAR) AS rescued__line
FROM orders"""

SQL["bronze_rescue_rows"] = """
SELECT CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate END AS delivery_start,
       o_orderdate + INTERVAL 1 HOUR AS delivery_end,
       CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice / 1000 - 20 END AS price_gbp_per_mwh,
       'GBP' AS currency,
       CASE WHEN o_orderkey % 7 <> 0 THEN '10Y' || substr(o_orderpriority, 1, 1) END AS bidding_zone,
       CASE WHEN o_orderkey % 11 <> 0 THEN o_orderdate + to_hours(CAST(o_custkey % 36 AS BIGINT)) END AS fetched_at,
       CASE WHEN o_orderkey % 10 = 0 THEN 'n/a' END AS bad_price,
       CASE WHEN o_orderkey % 11 = 0 THEN 'yesterday' END AS bad_fetched_at,
       CAST(o_orderkey % 10 = 0 AS INTEGER) + CAST(o_orderkey % 11 = 0 AS INTEGER) AS n_rescued
FROM orders"""

SQL["silver_quarantine"] = f"""
WITH b AS (
  SELECT CASE WHEN o_orderkey % 13 <> 0 THEN o_orderdate END AS delivery_start,
         o_orderdate + INTERVAL 1 HOUR AS delivery_end,
         CASE WHEN o_orderkey % 10 <> 0 THEN o_totalprice / 1000 - 20 END AS price_gbp_per_mwh,
         'GBP' AS currency,
         CASE WHEN o_orderkey % 7 <> 0 THEN '10Y' || substr(o_orderpriority, 1, 1) END AS bidding_zone,
         CASE WHEN o_orderkey % 11 <> 0
              THEN o_orderdate + to_hours(CAST(o_custkey % 36 AS BIGINT)) END AS fetched_at
  FROM orders)
SELECT *, concat_ws(',', {", ".join(f"CASE WHEN NOT coalesce({p}, false) THEN {_q(n)} END" for n, p in PRICES.silver_drop_rules.items())}) AS failed_rules
FROM ({_silver_sql(PRICES, "SELECT * FROM b")})"""

SQL["landed_documents"] = f"""
WITH o AS (SELECT * FROM ({_PRICE_BASE}))
SELECT 'landed' AS reason, o_orderdate AS delivery_start, o_totalprice / 1000 - 20 AS price_gbp_per_mwh,
       bidding_zone, CAST(1 AS BIGINT) AS n FROM o WHERE o_orderkey % 3 <> 0
UNION ALL SELECT 'landed', o_orderdate + to_minutes(CAST((o_orderkey % 3 + 1) * 60 AS BIGINT)), o_totalprice / 800 - 100,
       bidding_zone, 1 FROM o WHERE o_orderkey % 3 <> 0
UNION ALL SELECT 'value is no number', NULL, NULL, bidding_zone, count(*) FROM o WHERE o_orderkey % 3 = 0 GROUP BY bidding_zone
UNION ALL SELECT unnest(['foreign namespace', 'malformed record']), NULL, NULL, NULL, 2"""

_WAVE = "TIMESTAMP '1998-06-01 00:00:00'"


def _state_sql(label: str, rows: str) -> str:
    return f"""SELECT '{label}' AS state, 'silver' AS source, bidding_zone, delivery_start AS "at", price_gbp_per_mwh AS value
FROM ({_silver_sql(PRICES, rows)})
UNION ALL SELECT '{label}', 'bronze', bidding_zone, max(fetched_at), CAST(count(*) AS DOUBLE) FROM ({rows}) GROUP BY bidding_zone"""


_RUNS = {"update-0001-0": f"fetched_at < {_WAVE}", "update-0001-1": f"NOT fetched_at < {_WAVE}"}
_BY_RUN = {run: f"SELECT * FROM ({PRICE_ROWS_SQL}) WHERE {cond}" for run, cond in _RUNS.items()}


def _history_sql(label: str, runs) -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{label}', '{run} {name}', NULL, NULL, CAST(count(*) FILTER (WHERE {rule}) AS DOUBLE)
FROM (SELECT *, CAST(NULL AS VARCHAR) AS _rescued_data FROM ({_BY_RUN[run]}))"""
        for run in runs for name, rule in PRICES.bronze_rules.items())


SQL["tables_by_name"] = "\nUNION ALL ".join([
    _state_sql("before", _BY_RUN["update-0001-0"]), _history_sql("before", ["update-0001-0"]),
    _state_sql("after", PRICE_ROWS_SQL), _history_sql("after", list(_RUNS))])

SQL["silver_window"] = f"""
SELECT * FROM ({_silver_sql(PRICES, PRICE_ROWS_SQL)})
WHERE CAST(delivery_start + INTERVAL 1 HOUR AS DATE) BETWEEN DATE '1995-03-30' AND DATE '1995-04-02'"""

SQL["decode_lookup_table"] = SQL["decode_lookup"]
