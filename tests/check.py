"""Runs queries against their SQL twins: `python tests/check.py <sf_dir> [name ...]`."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

import __spark_entry__ as contract  # noqa: E402

TABLES = ["documents", "pages", "benchmark", "conversations", "embeddings"]


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]").appName("lexmill-check")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def normal(rows, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    def cell(v):
        return None if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(cell(r[i]) for i in order) for r in rows), key=repr)


def differences(spark: SparkSession, con, sf_dir: str, name: str) -> str:
    """Empty if the query and its SQL give the same columns and rows."""
    frame = contract.queries()[name](spark, sf_dir)
    sql = contract.oracle_sql().get(name)
    got = normal([tuple(r) for r in frame.collect()], frame.columns)
    if sql is None:
        return "" if got else "no rows"
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(columns)}"
    want = normal(cursor.fetchall(), columns)
    if got == want:
        return ""
    extra, missing = sorted(set(got) - set(want), key=repr), sorted(set(want) - set(got), key=repr)
    return (f"{len(got)} rows against {len(want)}; {len(extra)} only here, {len(missing)} only there\n"
            + "\n".join(f"  here  {str(r)[:300]}" for r in extra[:4]) + "\n" + "\n".join(f"  there {str(r)[:300]}" for r in missing[:4]))


if __name__ == "__main__":
    folder, names = sys.argv[1], sys.argv[2:] or list(contract.queries())
    spark, con, bad = session(), duck(folder), 0
    for n in names:
        start = time.time()
        try:
            problem = differences(spark, con, folder, n)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        bad += bool(problem)
        print(f"{'BAD ' if problem else 'ok  '} {n} {time.time() - start:.1f}s {problem}", flush=True)
    sys.exit(bool(bad))
