"""Queries that SQL can express equal their SQL on whole tables."""

import duckdb
import pytest

from tripgrid.llm.oracle import ORACLE
from tripgrid.llm.queries import QUERIES

TABLES = ["documents", "pages", "benchmark", "labels", "conversations"]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    result = QUERIES[name](spark, sf_dir)
    columns = sorted(result.columns)
    got = sorted(map(tuple, result.select(*columns).collect()), key=repr)
    cursor = db.execute(f"select {', '.join(columns)} from ({ORACLE[name]})")
    names = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "boolean": "BOOLEAN"}
    assert [(c[0], str(c[1])) for c in cursor.description] == [(c, names[dict(result.dtypes)[c]]) for c in columns]
    want = sorted(cursor.fetchall(), key=repr)
    assert len(got) > 0
    assert got == want
