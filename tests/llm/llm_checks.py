"""Comparing a frame with SQL over the same tables."""

import os

import duckdb

TESTDATA = "/root/testdata"
TYPES = {
    "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN", "int": "INTEGER",
    "timestamp_ntz": "TIMESTAMP",
}


def rows_of(columns, rows):
    """Rows by sorted column names, doubles to nine digits, in a fixed order."""
    order = sorted(columns)
    picked = [
        tuple(float(f"{v:.9g}") if isinstance(v, float) else v for v in (row[columns.index(name)] for name in order))
        for row in rows
    ]
    return sorted(picked, key=lambda row: tuple((v is None, str(v)) for v in row))


def check_against_sql(df, sql, tables):
    """``df`` has the columns, types and rows of ``sql`` over ``tables``: name to parquet path or Arrow table."""
    connection = duckdb.connect()
    for name, table in tables.items():
        if isinstance(table, str):
            path = f"{table}/*.parquet" if os.path.isdir(table) else table
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
        else:
            connection.register(name, table)
    cursor = connection.execute(sql)
    columns = [column[0] for column in cursor.description]
    types = {column[0]: str(column[1]) for column in cursor.description}
    expected = cursor.fetchall()
    assert sorted(df.columns) == sorted(columns)
    assert {name: TYPES[kind] for name, kind in df.dtypes} == types
    assert rows_of(df.columns, df.collect()) == rows_of(columns, expected)
