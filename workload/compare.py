"""Run queries on Spark and their SQL on DuckDB, and say where they differ.

    python -m workload.compare [name ...] [--sf 0.01]
"""

from __future__ import annotations

import argparse
import os
import time
from collections import Counter

from pyspark.sql import SparkSession

from workload.oracles import ORACLES
from workload.queries import QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TESTDATA = "/root/testdata"
DUCKDB_NAMES = {"string": "varchar", "int": "integer"}


def session(cores: int = 8) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidestrata")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def oracle_rows(folder: str, sql: str):
    import duckdb

    db = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if os.path.exists(path):
            db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    kinds = {row[0]: row[1].lower() for row in db.execute(f"DESCRIBE {sql}").fetchall()}
    cursor = db.execute(sql)
    return [c[0] for c in cursor.description], kinds, cursor.fetchall()


def ordered(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(row[i] for i in order) for row in rows)


def differences(spark: SparkSession, name: str, folder: str) -> str | None:
    """None when both engines give the same columns and rows."""
    frame = QUERIES[name](spark, folder)
    ours = [tuple(row) for row in frame.collect()]
    columns, kinds, theirs = oracle_rows(folder, ORACLES[name])
    if sorted(frame.columns) != sorted(columns):
        return f"columns {sorted(frame.columns)} <> {sorted(columns)}"
    named = {c: DUCKDB_NAMES.get(kind, kind) for c, kind in frame.dtypes}
    if named != kinds:
        return f"types {sorted(set(named.items()) ^ set(kinds.items()))}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} <> {len(theirs)}"
    mine, other = ordered(frame.columns, ours), ordered(columns, theirs)
    if mine != other:
        return f"values, e.g. {list((mine - other).items())[:2]} <> {list((other - mine).items())[:2]}"
    return None


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("names", nargs="*")
    parser.add_argument("--sf", default="0.01")
    chosen = parser.parse_args()
    spark = session()
    folder = f"{TESTDATA}/sf{chosen.sf}"
    for name in chosen.names or QUERIES:
        start = time.perf_counter()
        try:
            problem = differences(spark, name, folder)
        except Exception as error:
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{name:24} {time.perf_counter() - start:6.1f}s  {problem or 'same'}", flush=True)


if __name__ == "__main__":
    main()
