"""Every registered query against its SQL."""

import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as driver

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    return value


@pytest.mark.parametrize("name", sorted(driver.queries()))
def test_query_equals_sql(name, spark, duck):
    frame = driver.queries()[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    found = Counter(tuple(plain(v) for v in row) for row in frame.select(*[f"`{c}`" for c in columns]).collect())
    if name not in driver.oracle_sql():
        assert sum(found.values()) > 0
        return
    result = duck.execute(driver.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    expected = Counter(tuple(plain(row[i]) for i in order) for row in result.fetchall())
    assert sum(expected.values()) > 0
    assert found == expected


def test_every_sql_has_its_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())
