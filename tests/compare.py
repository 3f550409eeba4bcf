"""Order-insensitive comparison of a Spark result with SQL on the same tables."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession


def local_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(names: list[str], rows: list) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(repr(row[i]) for i in order) for row in rows)


def differences(frame: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if equal, else a description."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    want = _rows(names, result.fetchall())
    got = _rows(frame.columns, frame.collect())
    if want == got:
        return ""
    extra, lacking = got - want, want - got
    return (
        f"rows {sum(got.values())} vs {sum(want.values())}; "
        f"only here {list(extra.items())[:2]}; only there {list(lacking.items())[:2]}"
    )
