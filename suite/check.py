"""Run registered queries next to their oracles: ``python -m suite.check [sf_dir] [name ...]``.

Compares column names, rough types, row count and the whole sorted content."""

from __future__ import annotations

import datetime
import decimal
import math
import os
import sys
import time
import traceback

import duckdb

from carelattice.session import build_session
from suite.registry import ORACLES, QUERIES
from suite.views import TABLES


STRICT = bool(os.environ.get("STRICT"))


def norm(value):
    if isinstance(value, bool) or value is None:
        return str(value)
    if STRICT and isinstance(value, (decimal.Decimal, int, float)):
        return repr(value)
    if isinstance(value, (decimal.Decimal, int)):
        return f"{float(value):.9g}"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(norm(v) for v in value) + "]"
    return str(value)


def duck(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


KIND = {"bigint": "int", "int": "int", "integer": "int", "smallint": "int", "tinyint": "int",
        "hugeint": "int", "string": "str", "varchar": "str", "double": "float", "float": "float"}


def kind(type_name: str) -> str:
    t = str(type_name).lower()
    if t.startswith("decimal"):
        return "decimal"
    if t.startswith("timestamp"):
        return "timestamp"
    return KIND.get(t, t)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, con, sf_dir, name):
    started = time.time()
    df = QUERIES[name](spark, sf_dir)
    got = df.collect()
    took = time.time() - started
    if name not in ORACLES:
        return f"rows-only {len(got)}", took, True
    cur = con.execute(ORACLES[name])
    columns = [d[0] for d in cur.description]
    types = [str(d[1]) for d in cur.description]
    want = cur.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"COLUMNS {sorted(set(columns) ^ set(df.columns))}", took, False
    spark_types = dict(df.dtypes)
    odd = [
        (c, spark_types[c], t) for c, t in zip(columns, types)
        if kind(spark_types[c]) != kind(t) and t.upper() not in ("NULL",)
    ]
    note = f" types {odd}" if odd else ""
    a, b = rows_of(df.columns, got), rows_of(columns, want)
    if len(a) != len(b):
        return f"ROWS spark {len(a)} oracle {len(b)}{note}", took, False
    if a != b:
        i = next(i for i in range(len(a)) if a[i] != b[i])
        bad = sum(x != y for x, y in zip(a, b))
        return f"VALUES {bad} differ, first\n   {sorted(df.columns)}\n   spark  {a[i]}\n   oracle {b[i]}{note}", took, False
    return f"ok {len(a)} rows{note}", took, True


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:] or list(QUERIES)
    spark = build_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g", "spark.driver.host": "127.0.0.1",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    for name in names:
        try:
            text, took, good = compare(spark, con, sf_dir, name)
        except Exception as error:
            text, took, good = "ERROR " + "".join(traceback.format_exception_only(error))[:1500], 0, False
        failed += not good
        print(f"{'  ' if good else '!!'} {name:34s} {took:6.2f}s {text}", flush=True)
    print(f"{len(names)} queries, {failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
