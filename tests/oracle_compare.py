"""Run registered Spark queries and their DuckDB oracles side by side and compare results
(row count, column names, order-insensitive values).  Usage:

    python tests/oracle_compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def norm(v):
    if v is None:
        return "NULL"
    try:
        import pandas as pd
        if v is pd.NaT:
            return "NULL"
    except Exception:
        pass
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return repr(round(float(v), 9))
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return norm(v.item())
        except Exception:
            pass
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime().isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{norm(x)}" for k, x in sorted(v.items())) + "}"
    return str(v)


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
                 "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE", "float": "FLOAT",
                 "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_diff(sdf, con, sql_text):
    s = {f.name: SPARK_TO_DUCK.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in sdf.schema.fields}
    d = {r[0]: r[1] for r in con.execute("DESCRIBE " + sql_text).fetchall()}
    return {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}


def rows_of(columns, records):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in records), [columns[i] for i in order]


def compare(spark, key, q, o, sf_dir, con=None):
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = q(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    if o is None:
        return {"key": key, "status": "rows-only", "rows": len(srows), "spark_s": round(t1 - t0, 2)}
    res = con.execute(o)
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    t2 = time.time()
    s_sorted, scols = rows_of(sdf.columns, srows)
    o_sorted, ocols_s = rows_of(ocols, orows)
    out = {"key": key, "rows": len(srows), "oracle_rows": len(orows), "spark_s": round(t1 - t0, 2),
           "duck_s": round(t2 - t1, 2)}
    types = type_diff(sdf, con, o)
    if scols != ocols_s:
        out["status"] = f"COLUMNS {scols} vs {ocols_s}"
    elif types:
        out["status"] = f"TYPES {types}"
    elif s_sorted != o_sorted:
        diff = [(a, b) for a, b in zip(s_sorted, o_sorted) if a != b][:2]
        out["status"] = f"VALUES first diffs {diff}" if len(srows) == len(orows) else "ROWCOUNT"
    else:
        out["status"] = "ok"
    return out


def main(argv):
    from vantage.plans.catalog import load_all
    from vantage.session import build_session
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    keys = [a for a in argv[1:] if not a.startswith("/")]
    Q, O = load_all()  # noqa: E741
    tz = os.environ.get("VANTAGE_TEST_TZ")
    spark = build_session(extra={"spark.sql.session.timeZone": tz} if tz else None)
    con = duck(sf_dir)
    bad = 0
    for k in keys or sorted(Q):
        try:
            r = compare(spark, k, Q[k], O.get(k), sf_dir, con)
        except Exception as e:  # report and continue
            r = {"key": k, "status": f"ERROR {type(e).__name__}: {str(e)[:300]}"}
        if r["status"] not in ("ok", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"{len(keys or Q) - bad} ok / {bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
