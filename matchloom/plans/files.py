"""Files that people read: written out of tables, and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import writers
from ..sources.office import register
from ..sources.readers import sheet, table
from ..sources.scratch import new_folder
from .registry import query


@query("SELECT 'nation ' || (s_nationkey % 7) AS sheet, s_suppkey, s_name, s_acctbal, s_acctbal > 0 AS solvent FROM supplier")
def workbook_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A workbook with a sheet for each group of suppliers, as it comes back: names, numbers and flags."""
    register(spark)
    path = f"{new_folder(spark, 'book')}.xlsx"
    s = table(spark, sf, "supplier").select(F.concat(F.lit("nation "), (F.col("s_nationkey") % 7).cast("string")).alias("group"), "s_suppkey", "s_name", "s_acctbal", (F.col("s_acctbal") > 0).alias("solvent"))
    writers.workbook(s.repartition(3), path, "group")
    schema = "sheet string, s_suppkey long, s_name string, s_acctbal double, solvent boolean"
    return spark.read.format("workbook").schema(schema).load(path)


@query("SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority, o_orderstatus FROM orders")
def one_csv_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in one CSV file, added to it in two parts; cells are text."""
    path = f"{new_folder(spark, 'orders')}.csv"
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    for part in (0, 1):
        writers.single_csv(o.filter(F.col("o_orderkey") % 2 == part), path)
    return sheet(spark, path).toDF("o_orderkey", "o_orderpriority", "o_orderstatus")
