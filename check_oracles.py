"""Compare queries with their DuckDB counterparts: python check_oracles.py [sf_dir] [key ...]"""

from __future__ import annotations

import sys
import time
import traceback
from pathlib import Path

import duckdb

from shelftrail import session
from workload.oracles import ORACLES
from workload.queries import QUERIES


def _normal(rows: list[tuple], columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


def compare(spark, duck, sf_dir: str, key: str) -> str:
    """'' when rows, column names and values agree, else what differs."""
    df = QUERIES[key](spark, sf_dir)
    got = _normal([tuple(r) for r in df.collect()], df.columns)
    answer = duck.execute(ORACLES[key])
    columns = [c[0] for c in answer.description]
    expected = _normal(answer.fetchall(), columns)
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    if len(got) != len(expected):
        return f"rows {len(got)} != {len(expected)}"
    wrong = [(g, e) for g, e in zip(got, expected) if g != e]
    return f"{len(wrong)} of {len(got)} rows differ, e.g. {wrong[0]}" if wrong else ""


def connect(sf_dir: str):
    duck = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return duck


def main(sf_dir: str = "/root/testdata/sf0.01", *keys: str) -> int:
    spark = session.build("oracle check", "local[8]", spark_sql_shuffle_partitions="8", spark_driver_memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    duck, failed = connect(sf_dir), 0
    for key in keys or QUERIES:
        start = time.time()
        try:
            problem = compare(spark, duck, sf_dir, key)
        except Exception as error:
            traceback.print_exc(limit=2)
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(problem)
        print(f"{'FAIL' if problem else 'ok':4} {key} {time.time() - start:.1f}s {problem}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(bool(main(*sys.argv[1:])))
