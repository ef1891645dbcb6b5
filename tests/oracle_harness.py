"""Run a registered query in Spark and its oracle SQL in DuckDB, compare the results.

Comparison: same column names (sorted), same row count, same multiset of rows after
normalising numbers to 9 significant digits; column type categories are reported.

    python -m tests.oracle_harness [--sf /root/testdata/sf0.01] [key ...]
"""

from __future__ import annotations

import argparse
import datetime as dt
import decimal
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, __import__("os").path.dirname(__import__("os").path.dirname(
    __import__("os").path.abspath(__file__))))

from riskline.sources.tables import TABLES, table_path  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, float, decimal.Decimal)):
        f = float(v)
        if f != f:
            return "nan"
        return float(f"{f:.9g}") + 0.0
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(_norm(x) for x in v)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return str(v)


def _cat_spark(t: str) -> str:
    t = t.lower()
    if t.startswith(("bigint", "int", "smallint", "tinyint")):
        return "int"
    if t.startswith(("double", "float")):
        return "float"
    if t.startswith("decimal"):
        return "decimal"
    if t.startswith("string") or t.startswith("varchar"):
        return "string"
    if t.startswith("timestamp"):
        return "timestamp"
    if t.startswith("bool"):
        return "bool"
    if t.startswith("array"):
        return "list"
    return t


def _cat_duck(t: str) -> str:
    t = t.upper()
    if t in ("BIGINT", "INTEGER", "SMALLINT", "TINYINT", "HUGEINT", "UBIGINT", "UINTEGER"):
        return "int"
    if t in ("DOUBLE", "FLOAT"):
        return "float"
    if t.startswith("DECIMAL"):
        return "decimal"
    if t == "VARCHAR":
        return "string"
    if t.startswith("TIMESTAMP"):
        return "timestamp"
    if t == "BOOLEAN":
        return "bool"
    if t.endswith("[]"):
        return "list"
    return t.lower()


def duck_conn(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def compare(spark, con, key: str, sf_dir: str, verbose: bool = False) -> dict:
    from riskline.plans.catalog import entries

    e = entries()[key]
    t0 = time.time()
    sdf = e.fn(spark, sf_dir)
    srows = sdf.collect()
    t_spark = time.time() - t0
    scols = sdf.columns
    stypes = {f.name: _cat_spark(f.dataType.simpleString()) for f in sdf.schema.fields}
    res = {"key": key, "spark_rows": len(srows), "spark_s": round(t_spark, 2)}
    if not e.oracle:
        res["status"] = "rows-only"
        return res
    t0 = time.time()
    rel = con.sql(e.oracle)
    dcols = rel.columns
    dtypes = {c: _cat_duck(str(t)) for c, t in zip(rel.columns, rel.types)}
    drows = rel.fetchall()
    res["duck_s"] = round(time.time() - t0, 2)
    res["duck_rows"] = len(drows)
    if sorted(scols) != sorted(dcols):
        res["status"] = f"COLUMNS differ: spark={sorted(scols)} duck={sorted(dcols)}"
        return res
    order = sorted(scols)
    si = [scols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    sc = Counter(tuple(_norm(r[i]) for i in si) for r in srows)
    dc = Counter(tuple(_norm(r[i]) for i in di) for r in drows)
    tdiff = {c: (stypes[c], dtypes[c]) for c in order if stypes[c] != dtypes[c]}
    if tdiff:
        res["type_diff"] = tdiff
    if sc == dc:
        res["status"] = "MATCH"
    else:
        only_s = list((sc - dc).elements())[:3]
        only_d = list((dc - sc).elements())[:3]
        res["status"] = "VALUES differ"
        res["cols"] = order
        res["only_spark"] = only_s
        res["only_duck"] = only_d
    return res


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("keys", nargs="*")
    a = ap.parse_args(argv)
    from riskline.plans.catalog import entries
    from riskline.session import local_session

    spark = local_session(8, 8)
    con = duck_conn(a.sf)
    keys = a.keys or sorted(entries())
    bad = 0
    for k in keys:
        try:
            r = compare(spark, con, k, a.sf)
        except Exception as exc:  # report and continue
            r = {"key": k, "status": f"ERROR {type(exc).__name__}: {str(exc)[:400]}"}
        ok = r["status"] in ("MATCH", "rows-only")
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(r), flush=True)
    print(f"{len(keys) - bad}/{len(keys)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
