"""Every registered query against its SQL on the generated tables."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from chronofold.plans.oracle import ORACLE
from chronofold.plans.queries import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, duck):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    ours = Counter(tuple(r) for r in df.select(*columns).collect())
    result = duck.execute(ORACLE[name])
    described = {d[0]: str(d[1]) for d in result.description}
    assert sorted(described) == columns
    assert {c: TYPES[df.schema[c].dataType.simpleString()] for c in columns} == described
    order = [list(described).index(c) for c in columns]
    theirs = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    assert ours == theirs
