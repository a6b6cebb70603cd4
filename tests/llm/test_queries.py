"""The registered queries over the smallest given tables, against SQL where there is some."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_points
from wattlake.llm.oracle import ORACLE
from wattlake.llm.queries import QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")
OF = {"op3": "embeddings", "op6": "conversations"}


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{FOLDER}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return tuple(map(plain, value)) if isinstance(value, list) else value


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(entry_points.queries())
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, con, name):
    df = QUERIES[name](spark, FOLDER)
    found = con.execute(f"SELECT {', '.join(df.columns)} FROM ({ORACLE[name]})")
    want = sorted((tuple(map(plain, r)) for r in found.fetchall()), key=repr)
    assert sorted((tuple(map(plain, r)) for r in df.collect()), key=repr) == want


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_query_runs_over_its_whole_table(spark, con, name):
    rows = QUERIES[name](spark, FOLDER).collect()
    whole = con.execute(f"SELECT count(*) FROM {OF.get(name.split('_')[0], 'documents')}").fetchall()[0][0]
    assert len(rows) == whole or name.split("_")[0] in ("op2", "op3", "op5")
    assert rows
