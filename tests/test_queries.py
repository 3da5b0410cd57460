"""Every query with SQL gives the same rows in DuckDB."""

import os

import duckdb
import pytest

from rollcall import file_queries  # noqa: F401  (registers its queries)
from rollcall.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.skipif(not os.path.isdir(DATA), reason="tables are not there")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    got = QUERIES[name](spark, DATA)
    columns = sorted(got.columns)
    rows = sorted(repr(tuple(r)) for r in got.select(*columns).collect())
    cursor = sql.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE_SQL[name]})")
    want = sorted(repr(tuple(r)) for r in cursor.fetchall())
    assert rows == want
