"""Queries of the training-data operators against their SQL over the smallest tables, and what they take of odd sizes."""

import glob
import numbers
import os
from collections import Counter

import pytest
from matchloom.llm import common, mixing, near_duplicates, queries, sharding

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_rows_equal_those_of_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    if not glob.glob(f"{FOLDER}/*.parquet"):
        pytest.skip("no tables")
    con = duckdb.connect()
    for f in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    got, want = queries.QUERIES[name](spark, FOLDER).toPandas(), con.sql(queries.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    cell = lambda v: None if v is None or str(v) in ("nan", "<NA>") else round(float(v), 6) if isinstance(v, numbers.Number) else str(v)
    bag = lambda df: Counter(tuple(map(cell, v)) for v in df[sorted(df.columns)].values.tolist())
    assert bag(got) == bag(want)


def test_many_equal_rows(spark):
    """A row that comes 100,000 times is counted before it meets itself anywhere."""
    many = spark.range(100_000).selectExpr("7L AS doc_id", "'the same few words again and again' AS text", "'en' AS lang", "'src' AS source", "34L AS n_chars")
    d = many.unionByName(spark.range(500).selectExpr("id + 100 AS doc_id", "concat('another text number ', id, repeat(' w', cast(id % 9 AS int))) AS text", "'en' AS lang", "'src' AS source", "9L AS n_chars"))
    m = mixing.mix(d).groupBy("doc_id", "copies").count().filter("doc_id = 7").collect()
    total = sum(r["count"] for r in m)
    assert total == 100_000 and abs(sum(r["count"] * r.copies for r in m) - 150_000) <= 1000
    assert abs(mixing.apply_mix(d).filter("doc_id = 7").count() - 150_000) <= 1000
    s = sharding.shard_documents(d).groupBy("shard").agg({"slot": "max", "*": "count"}).collect()
    assert all(r["max(slot)"] + 1 == r["count(1)"] for r in s) and len(s) == 16
    assert near_duplicates.deduplicate(d).filter("doc_id = 7").count() == 1


def test_a_folder_is_asked_for_where_machines_share_none(spark, monkeypatch):
    class Elsewhere:
        master, applicationId = "spark://host:7077", "x"

    class Session:
        conf, sparkContext = spark.conf, Elsewhere

    if spark.conf.get("spark.checkpoint.dir", None):
        pytest.skip("set")
    with pytest.raises(RuntimeError):
        common.shared_dir(Session)
    Elsewhere.master = "local[2]"
    assert common.shared_dir(Session).startswith("file:")
