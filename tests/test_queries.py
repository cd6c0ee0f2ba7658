"""Every registered query against its SQL, whole tables, smallest scale."""

import duckdb
import pytest

import __spark_entry__ as contract

from conftest import SMALL

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
SQL_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    yield connection
    connection.close()


def _sorted(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    cursor = duck.execute(ORACLES[name])
    names = [c[0] for c in cursor.description]
    types = {c[0]: str(c[1]) for c in cursor.description}
    assert sorted(df.columns) == sorted(names)
    assert {c: SQL_TYPES[t] for c, t in df.dtypes} == types
    assert _sorted(df.collect(), df.columns) == _sorted(cursor.fetchall(), names)


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).columns == ["doc_id", "tfidf_summary"]
