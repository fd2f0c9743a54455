"""Every registered query against its SQL, on the smallest tables."""

import math
import re
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as registry
from harness.fixtures import TABLES

DATA = Path("/root/testdata/sf0.001")
QUERIES, ORACLE = registry.queries(), registry.oracle_sql()
# the queries of the optional subpackage have tests of their own
OWN = sorted(name for name in QUERIES if not re.match(r"op\d+_|pipeline$", name))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6) + 0.0)
    return str(v)


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(ORACLE) <= set(QUERIES)


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
@pytest.mark.parametrize("name", OWN)
def test_query(spark, duck, name):
    df = QUERIES[name](spark, str(DATA))
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert as_rows(df.columns, df.collect()) == as_rows(columns, cursor.fetchall())


def test_entry(spark):
    assert registry.entry(spark).count() > 0
