"""Compare catalog queries with their DuckDB SQL on the same parquet tables.

Order-insensitive: rows are compared as sorted multisets after sorting columns by name,
timestamps as text and doubles rounded to 6 places.

    python tests/oracle_harness.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm_val(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, pd.Timestamp) or hasattr(v, "isoformat"):
        return str(pd.Timestamp(v))
    if hasattr(v, "item"):
        return _norm_val(v.item())
    return v


def normalize(pdf: pd.DataFrame) -> tuple[list[str], list[tuple]]:
    cols = sorted(pdf.columns)
    rows = [tuple(_norm_val(v) for v in r) for r in pdf[cols].itertuples(index=False, name=None)]
    rows.sort(key=lambda r: tuple((x is None, str(type(x)), x) for x in r))
    return cols, rows


def compare(spark, key: str, fn, sql: str, sf_dir: str, con) -> dict:
    t = time.time()
    s = fn(spark, sf_dir).toPandas()
    ts = time.time() - t
    d = con.execute(sql).df()
    sc, sr = normalize(s)
    dc, dr = normalize(d)
    res = {"key": key, "rows_spark": len(sr), "rows_duck": len(dr), "cols_ok": sc == dc,
           "values_ok": sc == dc and sr == dr, "sec": round(ts, 2)}
    if not res["values_ok"]:
        res["cols"] = (sc, dc)
        diff = [r for r in sr if r not in set(dr)][:3] if sc == dc else []
        res["sample_spark_only"] = diff
        res["sample_duck_only"] = [r for r in dr if r not in set(sr)][:3] if sc == dc else []
    return res


def main(argv: list[str]) -> int:
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from zoneflow.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    spark = build_session(master="local[8]", shuffle_partitions=8)
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys or sorted(qs):
        if k not in sqls:
            print(f"{k:28s} (no oracle)")
            continue
        try:
            r = compare(spark, k, qs[k], sqls[k], sf_dir, con)
        except Exception as e:  # report and continue with the next key
            r = {"key": k, "error": repr(e)[:400]}
        ok = r.get("values_ok")
        bad += not ok
        print(f"{k:28s} {'OK ' if ok else 'BAD'} {r}", flush=True)
    print("mismatches:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
