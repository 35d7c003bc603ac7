"""Side-by-side check of every query against its DuckDB oracle.

Usage: python tests/oracle_check.py [sf_dir] [key ...]
Prints one line per key: OK / DIFF with row counts and the first differing
rows. Values are compared order-insensitively; floats to 9 significant
digits.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

STRICT = os.environ.get("ORACLE_STRICT") == "1"   # compare floats bit for bit

from vintage.sources.tables import DRIVER_TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm_val(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if STRICT else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()[:10] if type(v).__name__ == "date" else v.isoformat()
    if type(v).__name__ == "Decimal":
        return float(f"{float(v):.9g}")
    return v


def _key(row):
    return tuple((0, "") if x is None else (1, str(x)) for x in row)


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    if sorted(spark_cols) != sorted(duck_cols):
        return False, f"columns differ: spark={spark_cols} duck={duck_cols}"
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    a = sorted((tuple(_norm_val(r[i]) for i in si) for r in spark_rows), key=_key)
    b = sorted((tuple(_norm_val(r[i]) for i in di) for r in duck_rows), key=_key)
    if len(a) != len(b):
        return False, f"rows spark={len(a)} duck={len(b)}"
    for x, y in zip(a, b):
        if x != y:
            return False, f"first diff cols={order}\n  spark={x}\n  duck ={y}"
    return True, f"{len(a)} rows"


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    from __spark_entry__ import oracle_sql, queries
    from vintage.session import build_session
    spark = build_session("local[8]", 8)
    con = duck(sf_dir)
    qs, sqls = queries(), oracle_sql()
    ok_all = True
    for k in (keys or list(qs)):
        t0 = time.time()
        try:
            df = qs[k](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"ERR  {k}: spark {type(e).__name__}: {str(e)[:400]}")
            ok_all = False
            continue
        t1 = time.time()
        if k not in sqls:
            print(f"ROWS {k}: {len(rows)} rows (no oracle) {t1 - t0:.1f}s")
            continue
        try:
            res = con.execute(sqls[k])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"ERR  {k}: duckdb {type(e).__name__}: {str(e)[:400]}")
            ok_all = False
            continue
        ok, msg = compare(rows, cols, drows, dcols)
        ok_all &= ok
        print(f"{'OK  ' if ok else 'DIFF'} {k}: {msg} ({t1 - t0:.1f}s)")
    spark.stop()
    sys.exit(0 if ok_all else 1)


if __name__ == "__main__":
    main()
