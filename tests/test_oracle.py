"""Every registered query equals its SQL on whole tables."""

import math

import duckdb
import pytest

import __spark_entry__ as contract
from checks.oracle import ORACLE, TABLES
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def db(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    cleaned = [
        tuple(None if isinstance(v, float) and math.isnan(v) else v for v in (row[i] for i in order))
        for row in rows
    ]
    return sorted(columns), sorted(cleaned, key=repr)


SQL_TYPES = {
    "string": "VARCHAR", "double": "DOUBLE", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN",
}


def test_same_keys():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, db, name):
    result = QUERIES[name](spark, sf_dir)
    spark_columns, spark_rows = _bag(result.columns, [tuple(r) for r in result.collect()])
    cursor = db.execute(ORACLE[name])
    sql_types = {c[0]: str(c[1]) for c in cursor.description}
    sql_columns, sql_rows = _bag(list(sql_types), cursor.fetchall())
    assert {column: SQL_TYPES[kind] for column, kind in result.dtypes} == sql_types
    assert spark_columns == sql_columns
    assert len(spark_rows) == len(sql_rows) > 0
    assert spark_rows == sql_rows
