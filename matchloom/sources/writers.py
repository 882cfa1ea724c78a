"""Writers: keyed checkpoints, one folder a sheet, versioned results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.selection import sheet_names
from .keyed_store import KeyedStore
from .office import OneCsvSink, WorkbookSource


def append_csv(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", True).csv(path)


def single_csv(df: DataFrame, path: str) -> None:
    """One CSV file for a spreadsheet (see OneCsvSink): a byte order mark, one header line, then the rows; later calls add
    rows at its end, without copying what is there."""
    df.sparkSession.dataSource.register(OneCsvSink)
    df.write.format("one_csv").mode("append").save(path)


def workbook(df: DataFrame, path: str, sheet: str | None = None) -> None:
    """One workbook with a sheet for each value of a column (see WorkbookSource)."""
    df.sparkSession.dataSource.register(WorkbookSource)
    writer = df.write.format("workbook").mode("overwrite")
    (writer.option("sheet", sheet) if sheet else writer).save(path)


def write_new(df: DataFrame, path: str, write: bool = False) -> bool:
    """Write only if asked to, never over an earlier result; a dry run plans and writes nothing."""
    if write:
        df.write.mode("errorifexists").parquet(path)
    return write


def replace_with_backup(df: DataFrame, path: str, write: bool = False) -> str | None:
    """Put a result in an earlier one's place and keep that as `<path>.bak-vN`; returns where, or None. Nothing without write."""
    spark = df.sparkSession
    if not write:
        return None
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    target = hadoop.Path(path)
    store = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    df.write.mode("overwrite").parquet(f"{path}.new")  # whole before anything is moved; it may read the old one
    backup = None
    if store.exists(target):
        n = 1
        while store.exists(hadoop.Path(f"{path}.bak-v{n}")):
            n += 1
        backup = f"{path}.bak-v{n}"
        store.rename(target, hadoop.Path(backup))
    store.rename(hadoop.Path(f"{path}.new"), target)
    return backup


def write_by_sheet(df: DataFrame, name: str, position: str, path: str) -> DataFrame:
    """One folder a sheet; returns the names given. Rows are spread over the writers by a salt as well as the sheet,
    so a sheet with most of the rows is not one task's work."""
    names = sheet_names(df, name, position).select(F.col(name).alias("_n"), "sheet")
    out = df.join(names, F.col(name).eqNullSafe(F.col("_n"))).drop("_n")
    out.repartition("sheet", F.pmod(F.xxhash64(position), F.lit(16))).write.mode("overwrite").partitionBy("sheet").parquet(path)
    return names.withColumnRenamed("_n", name)


def append_missing(items: DataFrame, keys: list[str], path: str) -> DataFrame:
    """Add the items whose key the keyed store lacks; a second run adds nothing. Returns the store's rows."""
    store = KeyedStore(items.sparkSession, path, keys)
    store.insert_missing(items)
    return store.read()


class Ledger:
    """Checks of a result that are counted in the pass that writes it: name to a condition that each row must hold.

    Give observed(df) to the writer, then rows() has a row for each check. Nothing is read twice.
    """

    def __init__(self, checks: dict[str, Column]):
        self.checks, self.seen = checks, Observation()

    def observed(self, df: DataFrame) -> DataFrame:
        bad = [F.count_if(~F.coalesce(ok, F.lit(False))).alias(name) for name, ok in self.checks.items()]
        return df.observe(self.seen, F.count(F.lit(1)).alias("_rows"), *bad)

    def rows(self, spark: SparkSession) -> DataFrame:
        """(check, n_bad, passed), once the result is written."""
        found = self.seen.get
        return spark.createDataFrame([(name, found[name], found[name] == 0) for name in self.checks], "check string, n_bad long, passed boolean")


def write_checked(df: DataFrame, path: str, checks: dict[str, Column]) -> DataFrame:
    """Write a result once and return the ledger of its checks, counted on the way."""
    ledger = Ledger(checks)
    ledger.observed(df).write.mode("errorifexists").parquet(path)
    return ledger.rows(df.sparkSession)
