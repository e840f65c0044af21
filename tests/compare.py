"""Run registered queries against their DuckDB counterparts.

Usage: python tests/compare.py [sf_dir] [query ...]
"""

import math
import os
import sys
import tempfile
import time
from decimal import Decimal

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, Decimal):
        return str(value.normalize())
    if isinstance(value, float) and math.isfinite(value):
        return round(value, 6)
    if isinstance(value, (list, tuple)):
        return [_plain(v) for v in value]
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(
        [tuple(_plain(r[i]) for i in order) for r in rows],
        key=lambda r: [(v is None, type(v).__name__, str(v)) for v in r],
    )


def compare(spark, con, name, fn, sql, sf_dir):
    """None when equal, else what differs."""
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    want = rows_of(rel.columns, rel.fetchall())
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    if not got:
        return "no rows"
    for a, b in zip(got, want, strict=True):
        if a != b:
            return f"{a} != {b}"
    return None


def main():
    import __spark_entry__ as entry
    from ledgerloom.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(entry.queries())
    spark = build_session(master="local[8]", **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="run-")})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            sql = entry.oracle_sql().get(name)
            if sql is None:
                result = f"rows only: {entry.queries()[name](spark, sf_dir).count()}"
            else:
                result = compare(spark, con, name, entry.queries()[name], sql, sf_dir)
                bad += result is not None
        except Exception as error:  # noqa: BLE001
            result, bad = f"{type(error).__name__}: {str(error)[:600]}", bad + 1
        print(f"{name:28s} {time.time() - start:6.1f}s  {result or 'ok'}", flush=True)
    print(f"{bad} of {len(names)} differ")


if __name__ == "__main__":
    main()
