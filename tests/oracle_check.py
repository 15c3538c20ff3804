"""Run registered queries on Spark and their SQL twins on DuckDB and
compare: row count, column names, column type family, and an
order-insensitive hash of the values (exact, and at 9 significant digits).

    python tests/oracle_check.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _cell(v, digits: int | None):
    if v is None:
        return "∅"
    if isinstance(v, float) and math.isnan(v):
        return "∅"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int,)):
        return str(v)
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if f == 0:
            f = 0.0
        if f == int(f) and abs(f) < 1e15:
            return str(int(f))
        return repr(f) if digits is None else f"{f:.{digits}g}"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def digest(columns: list[str], rows: list[tuple], digits: int | None) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(_cell(r[i], digits) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def family(t: str) -> str:
    t = t.lower()
    if any(k in t for k in ("int", "long", "bigint", "short", "byte")):
        return "int"
    if any(k in t for k in ("double", "float", "decimal", "real")):
        return "float"
    if "bool" in t:
        return "bool"
    if "date" in t or "time" in t:
        return "time"
    return "str"


def compare(spark, con, name: str, sf_dir: str, fn, sql: str) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    s_cols = sdf.columns
    s_types = {f.name: family(f.dataType.simpleString()) for f in sdf.schema.fields}
    rel = con.sql(sql)
    d_cols = rel.columns
    d_types = {c: family(str(t)) for c, t in zip(rel.columns, rel.types)}
    d_rows = rel.fetchall()
    t2 = time.time()
    out = {
        "rows": (len(s_rows), len(d_rows)),
        "cols_ok": sorted(s_cols) == sorted(d_cols),
        "types_ok": s_types == d_types,
        "exact": False,
        "sig9": False,
        "spark_s": round(t1 - t0, 2),
        "duck_s": round(t2 - t1, 2),
    }
    if out["cols_ok"]:
        out["exact"] = digest(s_cols, s_rows, None) == digest(d_cols, d_rows, None)
        out["sig9"] = digest(s_cols, s_rows, 9) == digest(d_cols, d_rows, 9)
    else:
        out["col_diff"] = (sorted(set(s_cols) - set(d_cols)), sorted(set(d_cols) - set(s_cols)))
    if not out["types_ok"] and out["cols_ok"]:
        out["type_diff"] = {c: (s_types[c], d_types.get(c)) for c in s_cols if s_types[c] != d_types.get(c)}
    return out


def main(argv: list[str]) -> int:
    from reclaim.plans import oracle
    from reclaim.plans.registry import queries
    from reclaim.session import local_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    only = set(argv[1:])
    spark = local_session(8)
    con = duck(sf_dir)
    bad = 0
    for name, fn in queries().items():
        if only and name not in only:
            continue
        if not oracle.known(name):
            print(f"{name:28s} (rows only)", flush=True)
            continue
        try:
            r = compare(spark, con, name, sf_dir, fn, oracle.sql(name))
        except Exception as e:  # report and continue
            bad += 1
            print(f"{name:28s} ERROR {type(e).__name__}: {str(e)[:400]}", flush=True)
            continue
        ok = r["rows"][0] == r["rows"][1] and r["cols_ok"] and r["exact"]
        bad += 0 if ok else 1
        print(f"{name:28s} {'OK ' if ok else 'BAD'} {r}", flush=True)
    print(f"mismatching: {bad}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
