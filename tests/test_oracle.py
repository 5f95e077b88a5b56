"""Every query against its SQL oracle on the given tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from couriermart.plans.oracle import ORACLES
from couriermart.plans.queries import QUERIES
from support import TESTDATA

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN", "int": "INTEGER", "smallint": "SMALLINT",
}


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{TESTDATA}/sf0.01/{name}.parquet'")
    return connection


def _sorted(rows, columns):
    order = sorted(columns)
    picked = [tuple(row[columns.index(name)] for name in order) for row in rows]
    return sorted(picked, key=lambda row: tuple((value is None, str(value)) for value in row))


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= contract.queries().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, oracle, name):
    got = contract.queries()[name](spark, f"{TESTDATA}/sf0.01")
    rows = got.collect()
    cursor = oracle.execute(contract.oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    types = {column[0]: str(column[1]) for column in cursor.description}
    expected = cursor.fetchall()
    assert sorted(got.columns) == sorted(columns)
    assert {column: TYPES[kind] for column, kind in got.dtypes} == types
    assert _sorted(rows, got.columns) == _sorted(expected, columns)


def test_entry(spark):
    (row,) = contract.entry(spark).collect()
    assert row.count_messages > 0
