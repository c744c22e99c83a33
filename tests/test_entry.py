"""The driver contract: entry() runs; every query with a SQL twin matches
DuckDB on sf0.001 (row count, columns, values)."""

import duckdb
import pytest

import __spark_entry__ as E
from aerofeat.plans import catalog
from conftest import SF001
from tools.check_oracle import TABLES, digest


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["window_start", "window_end", "origin_airport_id", "average_departure_delay"]


def test_every_query_of_the_catalog_has_sql():
    assert set(catalog.queries()) <= set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, con, name):
    s = E.queries()[name](spark, SF001).toPandas()
    o = con.execute(E.oracle_sql()[name]).fetchdf()
    n1, c1, h1, _ = digest(s)
    n2, c2, h2, _ = digest(o)
    assert (n1, c1) == (n2, c2)
    assert h1 == h2
