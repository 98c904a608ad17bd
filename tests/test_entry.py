"""Every registered query against its SQL, on the smallest given tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as registered

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages \
benchmark labels conversations".split()
SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


OWN = [query.__name__ for query in registered._QUERIES if query.__name__ not in registered._NO_SQL]


def test_every_query_has_sql():
    assert set(OWN) == set(registered._own_oracles()) and set(OWN) <= set(registered.queries())


@pytest.mark.parametrize("name", OWN)
def test_query_equals_sql(spark, database, name):
    df = registered.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    result = database.execute(registered.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    expected = [tuple(plain(row[names.index(c)]) for c in columns) for row in result.fetchall()]
    got = [tuple(plain(row[c]) for c in columns) for row in df.collect()]
    assert got
    assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_entry(spark):
    assert registered.entry(spark).columns == ["rating", "count"]
