"""Driver contract: entry() runs, and every registered query equals its
DuckDB twin on the sf0.001 tables (row count, columns, values)."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF
from tools.oracle_check import TABLES, canon

QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["key", "pickup_datetime_hour", "num_pickup", "pickup_location_id"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    spd = QUERIES[name](spark, SF).toPandas()
    if name not in ORACLE:
        assert len(spd.columns) > 0
        return
    dpd = con.sql(ORACLE[name]).df()
    sc, sr = canon(spd)
    dc, dr = canon(dpd)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr
