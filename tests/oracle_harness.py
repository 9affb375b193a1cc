"""Run a lakeward query and its DuckDB oracle side by side and compare results.

Usage: python tests/oracle_harness.py [sf_dir] [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
if str(ROOT) not in sys.path:
    sys.path.insert(0, str(ROOT))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(v)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None) if v.tzinfo is None else v.astimezone(dt.timezone.utc).replace(tzinfo=None)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, repr(x)) for x in row)


# Spark simpleString -> DuckDB type name, for the schema check.
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT",
                 "boolean": "BOOLEAN"}


def compare(spark, con, name: str, sf_dir: str, fn, sql: str | None):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(_norm(r[c]) for c in scols) for r in sdf.collect()]
    t1 = time.time()
    if sql is None:
        return {"name": name, "ok": None, "rows": len(srows), "spark_s": round(t1 - t0, 2)}
    rel = con.sql(sql)
    dcols = list(rel.columns)
    drows = [tuple(_norm(x) for x in r) for r in rel.fetchall()]
    res = {"name": name, "rows": len(srows), "oracle_rows": len(drows),
           "spark_s": round(t1 - t0, 2)}
    if sorted(scols) != sorted(dcols):
        res.update(ok=False, why=f"columns differ: spark={scols} oracle={dcols}")
        return res
    stypes = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in sdf.schema.fields}
    dtypes = dict(zip(dcols, (str(t) for t in rel.types)))
    tdiff = {c: (stypes[c], dtypes[c]) for c in scols if stypes[c] != dtypes[c]}
    if tdiff:
        res.update(ok=False, why=f"types differ (spark, oracle): {tdiff}")
        return res
    order = [dcols.index(c) for c in sorted(scols)]
    sorder = [scols.index(c) for c in sorted(scols)]
    a = sorted((tuple(r[i] for i in sorder) for r in srows), key=_key)
    b = sorted((tuple(r[i] for i in order) for r in drows), key=_key)
    if a == b:
        res["ok"] = True
        return res
    diff_a = [r for r in a if r not in set(b)][:3]
    diff_b = [r for r in b if r not in set(a)][:3]
    res.update(ok=False, why=f"values differ; cols={sorted(scols)} spark_only={diff_a} oracle_only={diff_b}")
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    wanted = argv[2:]
    from __spark_entry__ import oracle_sql, queries
    from lakeward.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if wanted and name not in wanted:
            continue
        try:
            res = compare(spark, con, name, sf_dir, fn, sqls.get(name))
        except Exception as e:  # noqa: BLE001
            res = {"name": name, "ok": False, "why": f"{type(e).__name__}: {str(e)[:800]}"}
        bad += res.get("ok") is False
        print(res, flush=True)
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main(sys.argv)
