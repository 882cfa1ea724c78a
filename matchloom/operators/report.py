"""Report data: nested groups, chapters, coverage, attribute pairs, and the quality ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def nest(df: DataFrame, keys: list[str], rank: str, columns: list[str], name: str = "items") -> DataFrame:
    """One row a key with an array of its rows by rank. For groups of bounded size (a final top n)."""
    return df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(rank, *columns))).alias(name))


def chapters(df: DataFrame, field: str, number: str, order: list[str]) -> DataFrame:
    """(field, chapter, n, first_no, last_no): groups in a given order; unknown values are not reported."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col(field))
    return df.withColumn("chapter", place.cast("int")).filter("chapter > 0").groupBy(field, "chapter").agg(F.count(F.lit(1)).alias("n"), F.min(number).alias("first_no"), F.max(number).alias("last_no"))


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """(name, filled, total): how many rows have a value in each column, in one pass."""
    filled = [F.sum(F.when(F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) != "", 1).otherwise(0)).cast("long").alias(c) for c in columns]
    one = df.agg(F.count(F.lit(1)).alias("_total"), *filled)
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return one.select(F.expr(f"stack({len(columns)}, {pairs}) as (name, filled)"), F.col("_total").alias("total"))


def attribute_pairs(df: DataFrame, key: str, attributes: list[tuple[str, Column]]) -> DataFrame:
    """(key, line, label_1, value_1, label_2, value_2): attributes in a fixed order, two to a line."""
    lines = []
    for i in range(0, len(attributes), 2):
        pair = attributes[i : i + 2] + [("", F.lit(""))] * (2 - len(attributes[i : i + 2]))
        lines.append(F.struct(F.lit(i // 2 + 1).alias("line"), *[x for n, (label, value) in enumerate(pair, 1) for x in (F.lit(label).alias(f"label_{n}"), value.alias(f"value_{n}"))]))
    return df.select(key, F.inline(F.array(*lines)))


def ledger(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check, n_bad, passed): rows that break each check, all counted in one pass."""
    bad = [F.sum(F.when(F.coalesce(ok, F.lit(False)), 0).otherwise(1)).cast("long").alias(name) for name, ok in checks.items()]
    one = df.agg(*bad)
    pairs = ", ".join(f"'{c}', coalesce(`{c}`, 0L)" for c in checks)
    return one.select(F.expr(f"stack({len(checks)}, {pairs}) as (check, n_bad)")).withColumn("passed", F.col("n_bad") == 0)


def rows_or_none(keys: DataFrame, rows: DataFrame, key: str, none: dict[str, str]) -> DataFrame:
    """The rows of each key, and for a key without any one row of the given texts."""
    return keys.join(rows, key, "left").select(key, *[F.coalesce(F.col(c), F.lit(text)).alias(c) for c, text in none.items()])


def reconcile(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """(side, columns ..., n): rows that one side has more often than the other, by bag comparison."""
    both = left.select(*columns, F.lit(1).alias("d")).unionByName(right.select(*columns, F.lit(-1).alias("d")))
    diff = both.groupBy(*columns).agg(F.sum("d").alias("d")).filter("d != 0")
    return diff.select(F.when(F.col("d") > 0, "left").otherwise("right").alias("side"), *columns, F.abs("d").cast("long").alias("n"))
