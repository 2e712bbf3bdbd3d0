"""Every registered query against its DuckDB twin on the smallest data set."""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = os.environ.get("FLEETCAST_TEST_SF", "/root/testdata/sf0.001")
TABLES = ["events", "documents", "embeddings", "conversations"]


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, float):
        return repr(v + 0.0)
    return str(v)


def _digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha1("\n".join(lines).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_duckdb(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    drows = cur.fetchall()
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(srows, df.columns) == _digest(drows, dcols)
