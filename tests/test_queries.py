"""Every query against its SQL in DuckDB over the smallest tables."""

import glob
import numbers
import os
from collections import Counter

import pytest
from matchloom import catalog

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    if not glob.glob(f"{FOLDER}/*.parquet"):
        pytest.skip("no tables")
    con = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def cell(v):
    if v is None or str(v) in ("NaT", "<NA>", "nan"):
        return None
    return round(float(v), 6) if isinstance(v, numbers.Number) and not isinstance(v, bool) else str(v)


def bag(df):
    return Counter(tuple(cell(v) for v in row) for row in df[sorted(df.columns)].values.tolist())


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_rows_equal_those_of_sql(spark, duck, name):
    got, want = catalog.QUERIES[name](spark, FOLDER).toPandas(), duck.sql(catalog.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert bag(got) == bag(want)


def test_entry_needs_no_optional_part(spark):
    import __spark_entry__ as e

    assert set(catalog.QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
    if glob.glob("/root/testdata/sf0.001/*.parquet"):
        assert e.entry(spark).count() > 0
