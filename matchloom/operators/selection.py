"""Selection: final ranks, one row a title, first rows of keys, targets and slices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def first_by(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_nth", F.row_number().over(w)).filter("_nth = 1").drop("_nth")


def title_dedup_top_n(df: DataFrame, key: str, title: str, n: int, *order: Column) -> DataFrame:
    """Of each key the n best rows with different titles (trimmed, any case, see text.folded), ranked from 1."""
    keyed = df.withColumn("_title", T.folded(F.trim(title)))
    best = first_by(keyed, [key, "_title"], *order).drop("_title")
    w = Window.partitionBy(key).orderBy(*order)
    return best.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def spellings(df: DataFrame, column: str) -> DataFrame:
    """(word, n, n_spellings): the words of a column that differ in case alone as one, by their first spelling in lower case."""
    words = df.groupBy(F.col(column)).agg(F.count(F.lit(1)).alias("n"))  # as written, so that little is folded
    return words.groupBy(T.folded(F.col(column)).alias("_key")).agg(F.min(F.lower(column)).alias("word"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("n_spellings")).drop("_key")


def longest_per_key(df: DataFrame, key: str, value: str, position: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, value, carry ...): the longest value of each key, the first of equally long ones, with its row's other columns."""
    best = F.max_by(F.struct(value, *carry), F.struct(F.length(value), -F.col(position)))
    return df.groupBy(key).agg(best.alias("_best")).select(key, "_best.*")


def resolve_targets(df: DataFrame, value: str, position: str, include: list[str] | None = None, exclude: tuple[str, ...] = ()) -> DataFrame:
    """(value, pos): distinct values by first appearance; all or those included, less those excluded."""
    found = df.groupBy(value).agg(F.min(position).alias("pos"))
    if include is not None:
        found = found.filter(F.col(value).isin(include))
    return found.filter(~F.col(value).isin(*exclude)) if exclude else found


def row_slice(df: DataFrame, offset: int, limit: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).offset(offset).limit(limit)


def resolve_sources(keys: DataFrame, sources: list[tuple[str, DataFrame]], key: str, value: str) -> DataFrame:
    """Each key with the value of the first source that has one, and that source's name (missing: null, 'miss')."""
    out, found, name = keys, [], F.lit("miss")
    for i, (label, df) in enumerate(sources):
        out = out.join(df.select(key, F.col(value).alias(f"_v{i}")), key, "left")
        found.append(F.col(f"_v{i}"))
    for (label, _), v in reversed(list(zip(sources, found, strict=True))):
        name = F.when(v.isNotNull(), F.lit(label)).otherwise(name)
    return out.select(*keys.columns, F.coalesce(*found).alias(value), name.alias("src"))


def todo(items: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Items whose key is not done yet."""
    return items.join(done.select(*keys), keys, "left_anti")


def conform(df: DataFrame, order: list[str], promote: dict[str, str] | None = None) -> DataFrame:
    """The columns of `order` that exist, in that order; promote: columns that take another's place."""
    for old, new in (promote or {}).items():
        if new in df.columns:
            df = df.drop(old).withColumnRenamed(new, old)
    return df.select(*[c for c in order if c in df.columns])


def ensure_column(df: DataFrame, name: str, source: str) -> DataFrame:
    """df with a column, taken from another one where it lacks it; as it is where it has it or the other is missing too."""
    return df if name in df.columns or source not in df.columns else df.withColumn(name, F.col(source))


def forward_fill(df: DataFrame, position: str, value: str, keys: list[str] = ()) -> Column:
    """The last value up to a row."""
    w = Window.partitionBy(*keys).orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    return F.last(value, ignorenulls=True).over(w)


def sheet_names(df: DataFrame, name: str, position: str, longest: int = 31) -> DataFrame:
    """(name, pos, sheet): a sheet name for each distinct name by first appearance.

    Forbidden characters are spaces, blank names are 무명, names are cut; of names that are equal in any case, the second and
    later take _1, _2 ... at their end.
    """
    firsts = df.groupBy(name).agg(F.min(position).alias("pos"))
    clean = F.trim(F.regexp_replace(F.coalesce(F.col(name), F.lit("")), r"[\[\]:*?/\\]", " "))
    firsts = firsts.withColumn("base", F.left(F.coalesce(F.nullif(clean, F.lit("")), F.lit("무명")), F.lit(longest)))
    nth = F.row_number().over(Window.partitionBy(F.lower("base")).orderBy("pos")) - 1
    cut = F.expr(f"left(base, {longest} - length(concat('_', cast(nth as string))))")
    return firsts.withColumn("nth", nth).select(name, "pos", F.when(F.col("nth") == 0, F.col("base")).otherwise(F.concat(cut, F.concat(F.lit("_"), F.col("nth").cast("string")))).alias("sheet"))


def select_by_name(df: DataFrame, name: str, wanted: str, position: str, n: int) -> DataFrame:
    """The first n rows whose normalised name is the wanted one; an error if there are none."""
    from ..functions.text import norm_name

    found = df.filter(norm_name(F.col(name)) == norm_name(F.lit(wanted))).orderBy(position).limit(n)
    if found.isEmpty():
        raise ValueError(f"no rows for {wanted!r}")
    return found
