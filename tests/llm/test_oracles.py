"""Queries with SQL, against it, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from rowloom.llm.queries import ORACLE, QUERIES

DATA = Path("/root/testdata/sf0.001")


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(str(r[i]) for i in order) for r in rows)


@pytest.mark.skipif(not DATA.exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{DATA}/{table}.parquet')")
    df = QUERIES[name](spark, str(DATA))
    cursor = con.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert as_rows(df.columns, df.collect()) == as_rows(columns, cursor.fetchall())
