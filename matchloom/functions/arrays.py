"""Arrays: ordered distinct values, caps, positional zips and lenient parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def distinct_nocase(a: Column) -> Column:
    """The first of values that are equal in lower case, in order.

    Equal values go first, in one pass; the lists of the rest are bound once, not made anew for each value.
    """
    one = F.array_distinct(a)
    lists = F.array(F.struct(one.alias("a"), F.transform(one, F.lower).alias("low")))
    firsts = lambda p: F.filter(p["a"], lambda x, i: F.array_position(p["low"], F.lower(x)) == i + 1)
    return F.get(F.transform(lists, firsts), F.lit(0))


def cap(a: Column, n: int) -> Column:
    return F.slice(a, 1, n)


def zip_shorter(a: Column, b: Column) -> Column:
    """Pairs by position as long as both have one (arrays_zip pads with nulls)."""
    n = F.least(F.size(a), F.size(b))
    return F.arrays_zip(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n))


def str_list(a: Column) -> Column:
    """Trimmed values without blanks and nulls."""
    return F.filter(F.transform(a, lambda x: F.trim(x)), lambda x: x.isNotNull() & (x != ""))


def split_list(c: Column, separator: str = ";") -> Column:
    return str_list(F.split(c, separator))


def parse_list(c: Column, whole_if_bad: bool = False) -> Column:
    """A JSON array of strings; otherwise null text gives [], bad text [] or [text]."""
    a = F.from_json(c, "array<string>")
    bad = F.array(c) if whole_if_bad else F.array().cast("array<string>")
    return F.when(c.isNull() | (F.trim(c) == ""), F.array().cast("array<string>")).otherwise(F.coalesce(str_list(a), bad))


def merge_keywords(existing: Column, *texts: Column, fallback: Column | None = None, few: int = 3) -> Column:
    """Existing keywords, those of each text, and of the fallback where there are few existing ones; ordered, no case doubles."""
    parts = [F.coalesce(existing, F.array().cast("array<string>")), *texts]
    if fallback is not None:
        parts.append(F.when(F.size(parts[0]) <= few, fallback).otherwise(F.array().cast("array<string>")))
    return distinct_nocase(F.concat(*parts))


def in_turn(key: Column, values: list[str]) -> Column:
    """One of the values, in turn by a whole number."""
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(key, F.lit(len(values))) + 1).cast("int"))


def bound(value: Column, body) -> Column:
    """body of a value that is computed once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def counted(a: Column) -> Column:
    """array<struct<term, n>> of the distinct values of an array and how often each comes, in their order: by one sort and one
    pass over neighbours, so an array of any length takes n log n."""

    def runs(s: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return bound(starts, lambda at: F.transform(at, lambda i, k: F.struct(F.get(s, i).alias("term"), (F.coalesce(F.get(at, k + 1), F.size(s)) - i).alias("n"))))

    none = F.array().cast("array<struct<term:string,n:int>>")
    return F.when(F.size(a) > 0, bound(F.sort_array(a), runs)).otherwise(none)
