"""Readers: tables, sheets exported with title rows, keyed JSON, slim look-ups, and sets of versioned files."""

from __future__ import annotations

import csv

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (or pattern) has files, in whatever store Spark reads it from."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def sheet(spark: SparkSession, path: str, header_row: int = 0, schema: StructType | str | None = None, separator: str = ",") -> DataFrame:
    """A sheet saved as CSV whose column names stand in row `header_row` (from 0), below title rows.

    Each file of the path has its own title rows. Their ends are found by file and byte offset, so bodies are read in
    parallel and nothing is sorted but the heads. All files must have the header of the first.
    """
    if header_row == 0:
        reader = spark.read.option("header", True).option("sep", separator).option("multiLine", False)
        return (reader.schema(schema) if schema else reader).csv(path)
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"))
    nth = F.row_number().over(Window.partitionBy("file").orderBy("start", "line"))
    heads = lines.withColumn("nth", nth).filter(F.col("nth") <= header_row + 1)
    ends = heads.filter(F.col("nth") == header_row + 1).select("file", F.col("line").alias("end"), "value")
    header = ends.orderBy("file").first()["value"].removeprefix("\ufeff")
    body = lines.join(F.broadcast(ends.select("file", "end")), "file").filter(F.col("line") > F.col("end")).select("value")  # a row for each file
    names = next(csv.reader([header], delimiter=separator))
    fields = ", ".join(f"`{n or f'column_{i}'}` string" for i, n in enumerate(names))
    return body.select(F.from_csv("value", F.lit(fields), {"sep": separator}).alias("r")).select("r.*")


def partition_path(root: str, **keys: str) -> str:
    """The folder of one partition of a table."""
    return "/".join([root.rstrip("/"), *[f"{k}={v}" for k, v in keys.items()]])


def keyed_json(spark: SparkSession, path: str, value_schema: str, key: str = "key") -> DataFrame:
    """A JSON object `{key: {...}}` as rows (key, fields ...)."""
    text = spark.read.text(path, wholetext=True)
    return text.select(F.explode(F.from_json("value", f"map<string,struct<{value_schema}>>")).alias(key, "v")).select(key, "v.*")


def slim_or_wide(spark: SparkSession, slim: str, wide: str, columns: dict[str, str]) -> DataFrame:
    """A pre-projected table if there is one, else those columns of the wide table, else no rows. columns: name to type."""
    for path in (slim, wide):
        if exists(spark, path):
            found = spark.read.parquet(path)
            return found.select(*[(F.col(c) if c in found.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()])
    return spark.createDataFrame([], ", ".join(f"`{c}` {t}" for c, t in columns.items()))


def named_parts(spark: SparkSession, pattern: str, name: str, part: str, exclude: str | None = None) -> DataFrame:
    """All files of a pattern with a column `part` taken from the file name by the regular expression `name` (group 1)."""
    d = spark.read.parquet(pattern)
    file = F.col("_metadata.file_path")
    folder_or_file = F.regexp_extract(F.url_decode(file), name, 1)
    d = d.select("*", folder_or_file.alias(part))
    return d if exclude is None else d.filter(~F.contains(F.col(part), F.lit(exclude)))


def version_of(path: Column) -> Column:
    """The number n of `..._vn...`, null without one."""
    return F.nullif(F.regexp_extract(path, r"_v(\d+)", 1), F.lit("")).try_cast("int")


def next_version(paths: DataFrame, path: str = "path") -> DataFrame:
    """(latest, next): the newest version among the paths and the one to write."""
    latest = F.coalesce(F.max(version_of(F.col(path))), F.lit(0))
    return paths.agg(latest.alias("latest"), (latest + 1).alias("next"))


def fenced_block(spark: SparkSession, path: str, header: str) -> str:
    """The first fenced block after a header line of a small Markdown file: configuration that is kept in a document."""
    lines = spark.read.text(path, wholetext=True).first()["value"].split("\n")
    at = next((i for i, line in enumerate(lines) if line.startswith(header)), None)
    if at is None:
        raise ValueError(f"no header {header!r} in {path}")
    fences = [i for i in range(at + 1, len(lines)) if lines[i].startswith("```")][:2]
    if len(fences) < 2:
        raise ValueError(f"no fenced block after {header!r} in {path}")
    return "\n".join(lines[fences[0] + 1 : fences[1]])


def word_set(block: str) -> list[str]:
    """The distinct words of comma-separated lines, in order."""
    return list(dict.fromkeys(w.strip() for line in block.splitlines() for w in line.split(",") if w.strip()))
