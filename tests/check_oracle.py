"""Compare registered queries with their SQL: ``python tests/check_oracle.py SF_DIR [key ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    if isinstance(value, Decimal):
        return float(value)
    return value


def canon(columns: list[str], rows) -> tuple[list[str], list]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    named = [columns[i] for i in order]
    return named, sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


def compare(spark, con, sf_dir: str, key: str, sql: str) -> str:
    """Empty if both agree, else what differs."""
    df = contract.queries()[key](spark, sf_dir)
    mine = canon(df.columns, [tuple(r) for r in df.collect()])
    relation = con.sql(sql)
    theirs = canon(relation.columns, relation.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} != {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows != {len(theirs[1])}"
    bad = [(a, b) for a, b in zip(mine[1], theirs[1], strict=True) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else ""


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    connection = duck(sys.argv[1])
    wanted = sys.argv[2:] or list(contract.queries())
    for name in wanted:
        begin = time.time()
        try:
            found = compare(session, connection, sys.argv[1], name, contract.oracle_sql().get(name, "select 1"))
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            found = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if not found else 'FAIL'} {name} {time.time() - begin:.1f}s {found}", flush=True)
