"""Comparing a registered query with its SQL counterpart."""

from __future__ import annotations

import duckdb
from pyspark.sql import DataFrame

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def spark_rows(df: DataFrame) -> tuple[list[str], list[tuple]]:
    columns = sorted(df.columns)
    rows = df.select(*[f"`{c}`" for c in columns]).collect()
    return columns, sorted((tuple(r) for r in rows), key=repr)


def sql_rows(con: duckdb.DuckDBPyConnection, sql: str) -> tuple[list[str], list[tuple], list]:
    rel = con.sql(sql)
    columns = sorted(rel.columns)
    ordered = rel.select(", ".join(f'"{c}"' for c in columns))
    return columns, sorted(ordered.fetchall(), key=repr), list(ordered.types)


SAME_TYPE = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    columns, got = spark_rows(df)
    want_columns, want, want_types = sql_rows(con, sql)
    if columns != want_columns:
        return f"columns {columns} != {want_columns}"
    got_types = [SAME_TYPE[df.schema[c].dataType.simpleString()] for c in columns]
    if got_types != [str(t) for t in want_types]:
        pairs = zip(columns, got_types, want_types)
        return f"types {[(c, a, str(b)) for c, a, b in pairs if a != str(b)]}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    bad = [(a, b) for a, b in zip(got, want) if a != b]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None
