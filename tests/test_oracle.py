"""Every registered query against the same question asked in SQL of DuckDB."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from lakemart.workload.oracle import oracle_sql
from lakemart.workload.queries import REGISTRY as QUERIES

ORACLES = oracle_sql()

TYPES = {
    "string": "VARCHAR",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    expected = duck.sql(ORACLES[name])
    assert sorted(expected.columns) == columns
    kinds = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == kinds
    got = sorted(repr(tuple(r)) for r in df.select(columns).collect())
    quoted = ", ".join(f'"{c}"' for c in columns)
    want = sorted(repr(r) for r in duck.sql(f"select {quoted} from ({ORACLES[name]})").fetchall())
    assert got == want
    assert got, "the query returned nothing"


def test_entry_has_rows(spark):
    assert contract.entry(spark).limit(1).count() == 1
