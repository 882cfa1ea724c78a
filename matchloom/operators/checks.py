"""Validators: what a finished result must hold, as rows that break it or as counts of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def missing_sections(detail: Column, names: tuple[str, ...]) -> Column:
    """The sections of these names that a text lacks."""
    return F.filter(F.array(*map(F.lit, names)), lambda n: ~F.contains(F.coalesce(detail, F.lit("")), F.concat(F.lit("["), n, F.lit("]"))))


def complies(items: DataFrame, key: str, source: DataFrame, source_key: str, rules: dict[str, Column]) -> DataFrame:
    """items with `broken`: the names of the rules on their source row that they break; a missing source row breaks all.

    The source is pruned to its key and the rules' outcomes before the join.
    """
    kept = source.select(F.col(source_key).alias("_key"), *[F.coalesce(ok, F.lit(False)).alias(f"_{name}") for name, ok in rules.items()]).dropDuplicates(["_key"])
    bad = F.array_compact(F.array(*[F.when(~F.coalesce(F.col(f"_{name}"), F.lit(False)), F.lit(name)) for name in rules]))
    return items.join(kept, F.col(key) == F.col("_key"), "left").select(*items.columns, bad.alias("broken"))


def required_if(condition: Column, *values: Column) -> Column:
    """Whether a row has all values that the condition asks for."""
    filled = F.lit(True)
    for v in values:
        filled = filled & (T.cell(v) != "")
    return ~F.coalesce(condition, F.lit(False)) | filled


def order_differences(left: DataFrame, right: DataFrame, keys: list[str], position: str, value: str) -> DataFrame:
    """(keys, position, left, right): places where two ordered lists differ, a place that only one has among them."""
    a = left.select(*keys, position, T.squeeze(F.col(value)).alias("left"))
    b = right.select(*keys, position, T.squeeze(F.col(value)).alias("right"))
    return a.join(b, [*keys, position], "full").filter(~F.col("left").eqNullSafe(F.col("right")))
