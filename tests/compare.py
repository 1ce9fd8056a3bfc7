"""Order-insensitive comparison of a query with its SQL on DuckDB."""

import glob
import math
import os

import duckdb
from pyspark.sql import DataFrame

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def duck(sf_dir: str = SF_DIR) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    table = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [columns[i] for i in order], sorted(table, key=repr)


def spark_table(df: DataFrame):
    return _canonical(df.columns, [tuple(r) for r in df.collect()])


def duck_table(con: duckdb.DuckDBPyConnection, sql: str):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return _canonical(columns, cursor.fetchall())
