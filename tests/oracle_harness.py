"""Run a registered Spark query and its DuckDB oracle; compare the results.

Mirrors the correctness gate: row count, column names, and an
order-insensitive comparison of all values (columns sorted by name).

CLI: ``python tests/oracle_harness.py [sf_dir] [name ...]``; with
``HARNESS_STRICT=1`` float values must be bit-identical (default: equal to
9 decimals).
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    # DuckDB zone: UTC unless HARNESS_DUCK_TZ names another (oracle texts use
    # zone-free TIMESTAMP values only, so results must not depend on it)
    con.execute(f"SET TimeZone='{os.environ.get('HARNESS_DUCK_TZ', 'UTC')}'")
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"create view {t} as select * from read_parquet('{p}')")
    return con


_TYPE = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT",
         "string": "VARCHAR", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN",
         "date": "DATE", "smallint": "SMALLINT", "tinyint": "TINYINT"}


STRICT = os.environ.get("HARNESS_STRICT") == "1"


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if STRICT else round(v, 9)
    if isinstance(v, decimal.Decimal):
        return float(v) if STRICT else round(float(v), 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = queries()[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    sql = oracle_sql().get(name)
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["oracle"] = "none"
        return res
    rel = con.sql(sql)
    d_cols = rel.columns
    s_types = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
    d_types = {c: str(t) for c, t in zip(rel.columns, rel.types)}
    bad = {c: (s_types[c], d_types.get(c)) for c in s_types
           if _TYPE.get(s_types[c], s_types[c]) != d_types.get(c)}
    res["types_match"] = not bad
    if bad:
        res["type_diff"] = bad
    d_rows = rel.fetchall()
    res["oracle_rows"] = len(d_rows)
    res["cols_match"] = sorted(s_cols) == sorted(d_cols)
    if not res["cols_match"]:
        res["spark_cols"] = sorted(s_cols)
        res["oracle_cols"] = sorted(d_cols)
        res["match"] = False
        return res
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    res["match"] = a == b and res["types_match"]
    if not res["match"]:
        sa, sb = set(a), set(b)
        res["only_spark"] = list(sa - sb)[:3]
        res["only_oracle"] = list(sb - sa)[:3]
        res["cols"] = sorted(s_cols)
    return res


def main(argv):
    from hackney.session import get_session
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = get_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    from __spark_entry__ import queries
    con = duck(sf_dir)
    ok = True
    for name in names or sorted(queries()):
        try:
            r = compare(spark, name, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": name, "error": repr(e)[:800]}
        ok &= bool(r.get("match", r.get("oracle") == "none"))
        print(r, flush=True)
    print("ALL OK" if ok else "MISMATCH")


if __name__ == "__main__":
    main(sys.argv[1:])
