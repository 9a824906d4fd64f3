"""Every registered query against its DuckDB oracle on the smallest test set."""

import os
import re

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SPARK_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _canonical(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    value = lambda v: repr(round(v, 9) + 0.0) if isinstance(v, float) else repr(v)
    return sorted(tuple(value(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    frame = entry.queries()[name](spark, SF_DIR)
    expected = duck.sql(entry.oracle_sql()[name])
    assert sorted(frame.columns) == sorted(expected.columns)
    kinds = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: SPARK_TYPES[t] for c, t in frame.dtypes if kinds[c] != "HUGEINT"} == {
        c: k for c, k in kinds.items() if k != "HUGEINT"
    }
    ours = _canonical([tuple(r) for r in frame.collect()], frame.columns)
    assert ours == _canonical(expected.fetchall(), expected.columns)


def test_every_query_has_an_oracle():
    own = {n for n in entry.queries() if n != "pipeline" and not re.match(r"op\d+_", n)}
    assert own <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0
