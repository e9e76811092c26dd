"""Run a registered query and its SQL twin and compare every value, ignoring row order.

    python tests/oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DATA = os.environ.get("GLEANER_TESTDATA", "/root/testdata")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        v = float(v) if v != v.to_integral_value() else int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return int(v) if v.is_integer() and abs(v) < 1e15 else round(v, 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    return v


def spark_rows(df):
    cols = sorted(df.columns)
    return cols, sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)


def sql_rows(con, sql):
    rel = con.sql(sql)
    order = sorted(range(len(rel.columns)), key=lambda i: rel.columns[i])
    cols = [rel.columns[i] for i in order]
    return cols, sorted((tuple(plain(r[i]) for i in order) for r in rel.fetchall()), key=repr), [str(rel.types[i]) for i in order]


TYPE_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "float": "FLOAT",
}


def compare(spark, con, name, sf_dir, queries, oracles):
    df = queries[name](spark, sf_dir)
    cols, got = spark_rows(df)
    if name not in oracles:
        return f"rows-only ({len(got)} rows)", True
    want_cols, want, types = sql_rows(con, oracles[name])
    if cols != want_cols:
        return f"columns differ: {cols} != {want_cols}", False
    simple = [df.schema[c].dataType.simpleString() for c in cols]
    bad = [(c, s, t) for c, s, t in zip(cols, simple, types) if TYPE_NAMES.get(s) != t]
    if bad:
        return f"types differ: {bad}", False
    if got != want:
        extra = [r for r in got if r not in set(want)][:2]
        missing = [r for r in want if r not in set(got)][:2]
        return f"values differ: {len(got)} vs {len(want)} rows\n    spark only {extra}\n    sql only   {missing}", False
    if not got:
        return "ok but EMPTY", True
    return f"ok ({len(got)} rows)", True


def main(argv):
    from gleaner.catalog import load
    from gleaner.session import local_session

    sf_dir = argv[0] if argv else f"{DATA}/sf0.01"
    queries, oracles = load()
    names = [n for n in queries if not argv[1:] or any(n == a or (a.endswith("*") and n.startswith(a[:-1])) for a in argv[1:])]
    spark, con = local_session(8), connect(sf_dir)
    failed = 0
    for name in names:
        start = time.time()
        try:
            message, ok = compare(spark, con, name, sf_dir, queries, oracles)
        except Exception as exc:  # noqa: BLE001 - the report is the point
            message, ok = f"ERROR {type(exc).__name__}: {str(exc)[:600]}", False
        failed += not ok
        if not ok or "EMPTY" in message or argv[1:]:
            print(f"{'PASS' if ok else 'FAIL'} {name} {time.time() - start:.1f}s {message}", flush=True)
    print(f"{len(names) - failed}/{len(names)} passed")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
