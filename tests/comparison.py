"""Runs a query in Spark and its SQL in DuckDB and compares columns, types and rows."""

from __future__ import annotations

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

SAME_TYPE = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _sorted_rows(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    ordered = [tuple(row[i] for i in order) for row in rows]
    return [columns[i] for i in order], sorted(ordered, key=repr)


def differences(spark_df, con, sql: str) -> list[str]:
    """What differs, as texts; nothing if the results are equal."""
    con.execute(sql)
    duck_types = {d[0]: str(d[1]) for d in con.description}
    duck_columns, duck_rows = _sorted_rows([d[0] for d in con.description], con.fetchall())
    columns, rows = _sorted_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    found = []
    if columns != duck_columns:
        return [f"columns {columns} against {duck_columns}"]
    for name, dtype in spark_df.dtypes:
        if SAME_TYPE.get(dtype) != duck_types[name]:
            found.append(f"type of {name}: {dtype} against {duck_types[name]}")
    if len(rows) != len(duck_rows):
        found.append(f"{len(rows)} rows against {len(duck_rows)}")
    if rows != duck_rows:
        pairs = [(a, b) for a, b in zip(rows, duck_rows) if a != b]
        found.append(f"{len(pairs)} rows differ, first {str(pairs[:1])[:600]}")
    return found
