"""Every query against its SQL twin on the smallest data, and the driver's contract."""

import os
from collections import Counter

import pytest

from quillmesh.plans import every  # noqa: F401 - fills the registry
from quillmesh.plans.registry import ORACLE_SQL, QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables aren't here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    connection = duckdb.connect()
    for file in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    return connection


def plain(value):
    return f"{value:.6g}" if isinstance(value, float) else str(value)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    ours = Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())
    if name in ORACLE_SQL:
        found = duck.execute(ORACLE_SQL[name])
        names = [c[0] for c in found.description]
        assert sorted(names) == columns
        assert ours == Counter(tuple(plain(r[names.index(c)]) for c in columns) for r in found.fetchall())


def test_contract(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() > 0
    assert set(driver.oracle_sql()) <= set(driver.queries())
    assert set(QUERIES) <= set(driver.queries())
