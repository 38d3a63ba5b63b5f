"""Compare a registered Spark query with its DuckDB oracle, as the driver does:
row count, column names, column types (by family) and an order-insensitive
hash of the values with columns sorted by name.

Usage: python -m tests.oracle_compare [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as _dt
import decimal
import hashlib
import math
import sys
import time

import os as _os

EXACT = _os.environ.get("ORACLE_EXACT_FLOATS") == "1"   # hash raw doubles, no rounding

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return "nan"
        if math.isinf(f):
            return "inf" if f > 0 else "-inf"
        return f if EXACT else round(f, 9)
    if isinstance(v, _dt.datetime):
        return v.isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def value_hash(columns, rows) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    canon = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(canon).encode()).hexdigest()


def _family(t: str) -> str:
    t = t.lower()
    if any(x in t for x in ("int", "long", "short", "byte")):
        return "int"
    if any(x in t for x in ("double", "float", "real", "decimal")):
        return "float"
    if "bool" in t:
        return "bool"
    if "date" in t and "time" not in t:
        return "date"
    if "timestamp" in t:
        return "ts"
    if any(x in t for x in ("string", "varchar", "text")):
        return "str"
    return t


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_cols = sdf.columns
    s_types = [f.dataType.simpleString() for f in sdf.schema.fields]
    s_rows = [tuple(r) for r in sdf.collect()]
    t_spark = time.time() - t0
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = [str(t) for t in rel.types]
    d_rows = rel.fetchall()
    res["duck_rows"] = len(d_rows)
    ok = True
    if sorted(s_cols) != sorted(d_cols):
        ok = False
        res["cols"] = (s_cols, d_cols)
    else:
        sm = dict(zip(s_cols, s_types))
        dm = dict(zip(d_cols, d_types))
        bad = {c: (sm[c], dm[c]) for c in s_cols if _family(sm[c]) != _family(dm[c])}
        if bad:
            res["types"] = bad
    if len(s_rows) != len(d_rows):
        ok = False
    if ok:
        ok = value_hash(s_cols, s_rows) == value_hash(d_cols, d_rows)
        if not ok:
            ss = sorted(repr(tuple(_norm(r[i]) for i in sorted(range(len(s_cols)), key=lambda i: s_cols[i]))) for r in s_rows)
            dd = sorted(repr(tuple(_norm(r[i]) for i in sorted(range(len(d_cols)), key=lambda i: d_cols[i]))) for r in d_rows)
            diff_s = [x for x in ss if x not in set(dd)][:3]
            diff_d = [x for x in dd if x not in set(ss)][:3]
            res["diff"] = {"spark_only": diff_s, "duck_only": diff_d, "cols": sorted(s_cols)}
    res["status"] = "match" if ok else "MISMATCH"
    return res


def main(argv):
    import os
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from cartwheel.session import get_spark
    import __spark_entry__ as E
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = get_spark("local[8]", 8)
    con = duck(sf_dir)
    qs = E.queries()
    oracle = E.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, oracle.get(name), sf_dir)
        except Exception as e:  # report and continue
            r = {"name": name, "status": "ERROR", "error": repr(e)[:800]}
        if r["status"] not in ("match", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"done: {bad} problems")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
