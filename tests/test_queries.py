"""Every registered query against its check SQL, on the smallest scale."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from workloads.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def checker():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return None if value is None else str(value)


def test_every_check_has_a_query():
    assert set(ORACLE) <= set(QUERIES) <= set(entry.queries())
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, checker, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    rows = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    result = checker.execute(entry.oracle_sql()[name])
    names = [d[0] for d in result.description]
    assert columns == sorted(names)
    at = [names.index(c) for c in columns]
    assert rows == sorted((tuple(plain(r[i]) for i in at) for r in result.fetchall()), key=str)
