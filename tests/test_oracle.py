"""Every registered query against DuckDB over the given tables."""

import os

import pytest

import __spark_entry__ as entry_points
from compare import duck, duck_rows, spark_rows
from wattlake.queries import ORACLE, QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "smallint": "SMALLINT",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    names, rows = spark_rows(df)
    expected_names, expected, types = duck_rows(con, ORACLE[name])
    assert names == expected_names
    for f in df.schema.fields:
        kind = f.dataType.simpleString()
        assert TYPES.get(kind, kind.upper()) == types[f.name], f.name
    assert rows == expected


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() > 0
