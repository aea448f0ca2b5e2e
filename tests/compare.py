"""Runs registered queries and their SQL twins side by side.

``python tests/compare.py [sf_dir] [query ...]``
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return db


def _plain(value):
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return round(value, 6)
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return value


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(_plain(row[i]) for i in order) for row in data), key=repr)


def difference(frame, db, sql: str) -> str | None:
    """What is different, ``None`` when the two agree."""
    want = db.execute(sql)
    names = [d[0] for d in want.description]
    expected = rows(names, want.fetchall())
    got = rows(frame.columns, frame.collect())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if len(got) != len(expected):
        return f"{len(got)} rows != {len(expected)}"
    for left, right in zip(got, expected):
        if left != right:
            names = sorted(names)
            bad = [(n, a, b) for n, a, b in zip(names, left, right) if a != b]
            return f"{sum(a != b for a, b in zip(got, expected))} rows differ; {left[:2]}: {str(bad)[:1500]}"
    return None


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main(sf_dir: str = "/root/testdata/sf0.01", *wanted: str) -> int:
    import __spark_entry__ as entry

    spark, db, failed = session(), connect(sf_dir), 0
    spark.conf.set("spark.sql.debug.maxToStringFields", "200")
    queries, twins = entry.queries(), entry.oracle_sql()
    for name in wanted or queries:
        start = time.time()
        try:
            frame = queries[name](spark, sf_dir)
            problem = difference(frame, db, twins[name]) if name in twins else f"no twin, {frame.count()} rows"
        except Exception as failure:
            problem = f"{type(failure).__name__}: {str(failure)[:1500]}"
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
