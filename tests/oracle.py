"""Run catalogue queries next to their SQL twins in DuckDB and compare the rows.

``python -m tests.oracle [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import math
import sys
import time
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, Decimal)):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=repr)


def compare(spark: SparkSession, sf_dir: str, function, sql: str | None, connection) -> tuple[bool, str]:
    df = function(spark, sf_dir)
    got_columns, got = as_rows(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return len(got) > 0, f"{len(got)} rows (no twin)"
    result = connection.execute(sql)
    want_columns, want = as_rows([d[0] for d in result.description], result.fetchall())
    if got_columns != want_columns:
        return False, f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return False, f"rows {len(got)} != {len(want)}: {[r for r in got if r not in set(want)][:2]} / {[r for r in want if r not in set(got)][:2]}"
    different = [(a, b) for a, b in zip(got, want) if a != b]
    if different:
        return False, f"{len(different)} of {len(got)} rows differ, e.g. {different[:2]}"
    return True, f"{len(got)} rows"


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    from tidewright.catalog import ORACLES, QUERIES
    from tidewright.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(master="local[8]")
    spark.sparkContext.setLogLevel("ERROR")
    connection, failed = duck(sf_dir), 0
    for name in names:
        started = time.time()
        try:
            ok, note = compare(spark, sf_dir, QUERIES[name], ORACLES.get(name), connection)
        except Exception as error:  # noqa: BLE001 - report and go on
            ok, note = False, f"{type(error).__name__}: {str(error)[:700]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - started:.1f}s {note}", flush=True)
    print(f"{len(names) - failed}/{len(names)} ok")
    return failed


if __name__ == "__main__":
    sys.exit(main())
