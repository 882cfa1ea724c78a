"""Vectors as arrays of float, summed in double."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def l2_normalize(a: Column) -> Column:
    n = norm(a)
    return F.when(n == 0, F.transform(a, lambda x: x.cast("double"))).otherwise(F.transform(a, lambda x: x.cast("double") / n))


def cosine(a: Column, b: Column) -> Column:
    """0 where a vector is zero or null; within [-1, 1]."""
    c = F.try_divide(dot(a, b), norm(a) * norm(b))
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.coalesce(c, F.lit(0.0))))


def cosine_distance(similarity: Column) -> Column:
    return F.greatest(F.lit(0.0), 1 - similarity)


def mean_pool(token_vectors: Column, mask: Column) -> Column:
    """Mean of the vectors whose mask is 1, scaled to length 1."""
    used = F.filter(F.arrays_zip(token_vectors.alias("v"), mask.alias("m")), lambda t: t["m"] == 1)
    n = F.greatest(F.size(used), F.lit(1))
    zero = F.transform(F.element_at(token_vectors, 1), lambda x: F.lit(0.0))
    total = F.aggregate(F.transform(used, lambda t: t["v"]), zero, lambda s, v: F.zip_with(s, v, lambda x, y: x + y))
    return l2_normalize(F.transform(total, lambda x: x / n))
