"""Run a query in Spark and its SQL in DuckDB and compare columns, types and rows."""

from __future__ import annotations

import glob
import os

import duckdb
import pyarrow as pa


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(table: pa.Table) -> list[tuple]:
    names = sorted(table.column_names)
    columns = [table.column(n).to_pylist() for n in names]
    return sorted(zip(*columns, strict=True), key=lambda row: [(v is not None, str(v)) for v in row])


def type_of(field: pa.Field) -> str:
    if pa.types.is_large_string(field.type):
        return "string"
    return str(field.type)


def differences(spark_table: pa.Table, duck_table: pa.Table) -> list[str]:
    found = []
    ours = {f.name: type_of(f) for f in spark_table.schema}
    theirs = {f.name: type_of(f) for f in duck_table.schema}
    if ours != theirs:
        found.append(f"schema {sorted(set(ours.items()) ^ set(theirs.items()))}")
        if set(ours) != set(theirs):
            return found
    a, b = rows_of(spark_table), rows_of(duck_table)
    if len(a) != len(b):
        found.append(f"rows {len(a)} != {len(b)}")
    wrong = [(x, y) for x, y in zip(a, b, strict=False) if x != y]
    if wrong:
        found.append(f"{len(wrong)} rows differ, first: {wrong[0]}")
    return found
