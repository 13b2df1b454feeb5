"""Every registered query against its DuckDB text on the test tables."""

import os
from decimal import Decimal

import duckdb
import pytest

from basketry.oracle import ORACLE
from basketry.registry import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are missing")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("orders", "lineitem", "part"):
        connection.sql(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    yield connection
    connection.close()


def ordered(records):
    plain = [tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in records]
    return sorted(plain, key=repr)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    relation = duck.sql(ORACLE[name])
    assert sorted(relation.columns) == columns
    places = [relation.columns.index(column) for column in columns]
    expected = [tuple(record[i] for i in places) for record in relation.fetchall()]
    assert ordered(df.select(*columns).collect()) == ordered(expected)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_without_sql_gives_rows(spark, name):
    assert QUERIES[name](spark, FOLDER).limit(1).count() == 1
