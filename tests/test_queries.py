"""Every registered query against the same in SQL, over the given tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from workload import oracle
from workload.queries import all_queries

QUERIES, SQL = all_queries(), oracle.oracle_sql()
TABLES = "region nation customer supplier part orders lineitem events".split()


@pytest.fixture(scope="module")
def database(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    yield con
    con.close()


def test_all_sql_belongs_to_a_query():
    assert set(SQL) == set(QUERIES)
    assert set(entry.oracle_sql()) <= set(entry.queries()) and set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(spark, sf_dir, database, name):
    got = QUERIES[name](spark, sf_dir)
    columns = sorted(got.columns)
    expected = database.sql(SQL[name])
    assert sorted(expected.columns) == columns
    place = [expected.columns.index(c) for c in columns]
    left = sorted((tuple(r[c] for c in columns) for r in got.collect()), key=repr)
    right = sorted((tuple(r[i] for i in place) for r in expected.fetchall()), key=repr)
    assert left == right
