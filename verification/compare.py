"""Run registered queries in Spark and DuckDB and compare every value.

``python -m verification.compare [SF_DIR] [query ...]``"""

from __future__ import annotations

import math
import sys
import time

import duckdb
from pyspark.sql import SparkSession

from verification.feeds import TABLES
from verification.oracle import ORACLE
from verification.queries import REGISTRY


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, bool):
        return int(value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def difference(spark: SparkSession, con, sf_dir: str, name: str) -> tuple[int, str | None]:
    """Number of rows and the first difference, if any."""
    df = REGISTRY[name](spark, sf_dir)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cursor = con.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    want = _rows(names, cursor.fetchall())
    if sorted(df.columns) != sorted(names):
        return len(got), f"columns {sorted(set(df.columns) ^ set(names))}"
    if len(got) != len(want):
        return len(got), f"{len(got)} rows, expected {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            columns = sorted(names)
            return len(got), "; ".join(f"{c}: {x!r} / {y!r}" for c, x, y in zip(columns, a, b) if x != y)
    return len(got), None


def main() -> int:
    from shelfmark.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark, con = local_session(8), connect(sf_dir)
    bad = 0
    for name in sys.argv[2:] or REGISTRY:
        started = time.time()
        try:
            rows, problem = difference(spark, con, sf_dir, name) if name in ORACLE else (0, "no SQL")
        except Exception as error:  # report and go on with the other queries
            rows, problem = 0, f"{type(error).__name__}: {str(error)[:400]}"
        bad += problem is not None
        print(f"{'ok ' if problem is None else 'BAD'} {name:34s} {rows:7d} rows {time.time() - started:6.2f} s {problem or ''}", flush=True)
    print(f"{bad} of {len(sys.argv[2:] or REGISTRY)} differ")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
