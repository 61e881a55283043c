"""Registered queries against their SQL, and the registration itself."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from chronofold.llm.oracle import ORACLE
from chronofold.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels"):
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


def test_all_operators_and_the_pipeline_are_registered():
    names = set(contract.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= names
    assert set(ORACLE) <= set(contract.oracle_sql())
    assert contract.oracle_sql().get("pipeline") == corpus_pipeline.ORACLE_SQL


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(name, spark, duck):
    df = QUERIES[name](spark, FOLDER)
    columns = sorted(df.columns)
    ours = Counter(tuple(r) for r in df.select(*columns).collect())
    result = duck.execute(ORACLE[name])
    described = {d[0]: str(d[1]) for d in result.description}
    assert {c: TYPES[df.schema[c].dataType.simpleString()] for c in columns} == described
    order = [list(described).index(c) for c in columns]
    assert ours == Counter(tuple(row[i] for i in order) for row in result.fetchall())
