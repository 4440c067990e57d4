"""Every query against the same query in another engine, over whole test tables."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from bizregistry.bindings.oracle import ORACLE
from bizregistry.bindings.queries import QUERIES

ROOT = "/root/testdata"
SF = os.environ.get("PARITY_SF", "sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.isdir(ROOT), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM '{ROOT}/{SF}/{table}.parquet'"
        )
    return connection


def _sorted(rows):
    return sorted(rows, key=lambda row: [(v is None, str(v)) for v in row])


def _kind(name):
    name = name.lower()
    return {"integer": "int", "varchar": "string"}.get(name, name)


def test_all_queries_have_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()
    assert oracle_sql().keys() <= queries().keys()


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_parity(spark, duck, key):
    got = queries()[key](spark, f"{ROOT}/{SF}")
    want = duck.execute(oracle_sql()[key])
    columns = {d[0]: _kind(str(d[1])) for d in want.description}
    assert dict(got.dtypes) == columns
    order = sorted(columns)
    rows = _sorted(tuple(r) for r in got.select(*order).collect())
    names = list(columns)
    expected = _sorted(
        tuple(row[names.index(c)] for c in order) for row in want.fetchall()
    )
    assert len(rows) == len(expected) > 0
    for mine, theirs in zip(rows, expected):
        for a, b in zip(mine, theirs):
            same = math.isclose(a, b) if isinstance(a, float) and b is not None else a == b
            assert same, (mine, theirs)


def test_entry(spark):
    assert entry(spark).count() > 0
