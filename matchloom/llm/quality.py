"""Quality rules whose thresholds come from mergeable quantile sketches, in DataFrame operations only."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_BREAK, materialize
from .mixing import join_sums

#: Words in a window that may repeat, and the fixed rules of the base filter.
WINDOW, LEAST_WORDS, MOST_REPEATED_PERCENT = 5, 10, 20
#: A fence is so many interquartile ranges beyond the quartiles. Where the quartiles are equal (most texts have no symbol
#: and no line twice), it is the quantile that leaves this share of the group beyond it.
FENCE, TAIL = 3.0, 0.01
#: Relative accuracy of a sketch: its buckets end at the powers of GAMMA.
ACCURACY = 0.002
GAMMA = (1 + ACCURACY) / (1 - ACCURACY)
#: The fences of a group are drawn to those of the level above as if that had so many documents in the group.
SHRINK = 100
#: Measures, and those with a lower fence too.
MEASURES = {"symbol_ratio": ("n_symbols", "word_chars"), "mean_word": ("word_chars", "n_words"), "dup_line_ratio": ("n_dup_lines", "n_lines"), "repeat_ratio": ("n_repeat_words", "n_words")}
TWO_SIDED = ("mean_word",)
#: Bucket of the value 0, below all others.
ZERO = -(1 << 20)
#: Values so near to a fence, relatively, are on it.
NEAR = 1e-9


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words of each whole text.

    Repeated words: the hashes of all windows are sorted within the row (only in rows where some hash comes twice), equal
    neighbours give the positions of repeated windows, and a fold over those counts the words they cover. Linear-log time,
    memory of one text. Null text has no words.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    has_word = r"[^\x20\x09-\x0D]"
    d = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(lang_col).alias("lang"),
        F.col(source_col).alias("source"),
        F.array_remove(F.split(text, WORD_BREAK), "").alias("words"),
        F.filter(F.split(text, "\n", -1), lambda line: line.rlike(has_word)).alias("lines"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
    )
    ids = ["doc_id", "lang", "source"]
    d = d.select(
        *ids,
        "n_symbols",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("h"),
    )
    counts = ["n_symbols", "n_words", "word_chars", "n_lines", "n_dup_lines"]
    parts = ", ".join(f"h[i + {k}]" for k in range(WINDOW))
    d = d.select(*ids, *counts, F.expr(f"if(n_words >= {WINDOW}, transform(sequence(0, cast(n_words as int) - {WINDOW}), i -> xxhash64({parts})), cast(array() as array<bigint>))").alias("s"))
    d = d.select(*ids, *counts, F.expr("if(size(array_distinct(s)) < size(s), sort_array(transform(s, (x, i) -> struct(x as x, i as i))), cast(array() as array<struct<x:bigint,i:int>>))").alias("e"))
    again = "transform(e, (v, j) -> if((j > 0 and e[j - 1].x = v.x) or (j + 1 < size(e) and e[j + 1].x = v.x), v.i, -1))"
    d = d.select(*ids, *counts, F.expr(f"if(size(e) = 0, cast(array() as array<int>), sort_array(filter({again}, p -> p >= 0)))").alias("p"))
    covered = f"aggregate(p, named_struct('n', 0L, 'end', 0), (a, q) -> named_struct('n', a.n + (q + {WINDOW} - greatest(q, a.end)), 'end', q + {WINDOW}), a -> a.n)"
    return d.select(*ids, *counts, F.expr(covered).alias("n_repeat_words"))


def sketch(measured: DataFrame, names: list[str], keys: list[str]) -> DataFrame:
    """(keys, name, bucket, n): how many values of each measure fall between two powers of GAMMA, for each group.

    A sketch is a table of counts: it has some thousand buckets at most, whatever the group's size, sketches merge by
    adding, and the same rows give the same sketch however they are dealt out.
    """
    bucket = lambda c: F.when(F.col(c) > 0, F.ceil(F.log(c) / F.lit(math.log(GAMMA))).cast("int")).otherwise(ZERO)
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), bucket(c).alias("bucket")) for c in names])).alias("b")
    return measured.select(*keys, each).groupBy(*keys, "b.name", "b.bucket").agg(F.count(F.lit(1)).alias("n"))


#: The quantiles that fences are made of.
QUANTILES = {"low": TAIL, "q1": 0.25, "q3": 0.75, "high": 1 - TAIL}


def _quantiles(sketches: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """(keys, n, low_ and high_ of each name): fences from sketches; a quantile is the end of the bucket that holds it."""
    group = Window.partitionBy(*keys, "name")
    d = sketches.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))).withColumn("total", F.sum("n").over(group))
    end = lambda b: F.when(b == ZERO, 0.0).otherwise(F.pow(F.lit(GAMMA), b))
    q = [end(F.min(F.when(F.col("upto") >= share * F.col("total"), F.col("bucket")))).alias(k) for k, share in QUANTILES.items()]
    found = d.groupBy(*keys, "name").agg(F.max("total").alias("n"), *q)
    width = FENCE * (F.col("q3") - F.col("q1"))
    low = F.when(~F.col("name").isin(*TWO_SIDED), -1e300).when(width > 0, F.col("q1") - width).otherwise(F.col("low") / GAMMA)
    high = F.when(width > 0, F.col("q3") + width).otherwise(F.col("high"))
    found = found.select(*keys, "name", "n", low.alias("low"), high.alias("high"))
    pick = lambda c, name: F.max(F.when(F.col("name") == name, F.col(c))).alias(f"{c}_{name}")
    return found.groupBy(*keys).agg(F.max("n").alias("n"), *[pick(c, name) for name in names for c in ("low", "high")])


def fences(measured: DataFrame, names: list[str]) -> DataFrame:
    """(lang, source, n, and low and high of each name): fences of each language and source, from mergeable sketches.

    A fence comes from the quantiles of the group's sketch (see FENCE), and is drawn towards that of its language by SHRINK
    documents, and that of the language likewise towards that of all: a small group has in the main its language's.
    Sketches are built where the rows are and merged; those of groups are merged again to those of languages and of all,
    so no row is read twice, and no group meets in one task, however large.
    """
    groups = materialize(sketch(measured, names, ["lang", "source"]), "quality-sketches")
    by_lang = groups.groupBy("lang", "name", "bucket").agg(F.sum("n").alias("n"))
    total = by_lang.groupBy("name", "bucket").agg(F.sum("n").alias("n"))
    cols = [f"{c}_{name}" for name in names for c in ("low", "high")]
    up = lambda d, prefix: d.withColumnsRenamed({c: f"{prefix}{c}" for c in ["n", *cols]})
    draw = lambda own, n, above: (F.col(n) * F.col(own) + SHRINK * F.col(above)) / (F.col(n) + SHRINK)
    langs = _quantiles(by_lang, ["lang"], names).join(F.broadcast(up(_quantiles(total, [], names), "all_")))  # one row
    langs = langs.select("lang", *[draw(c, "n", f"all_{c}").alias(f"up_{c}") for c in cols])
    both = join_sums(_quantiles(groups, ["lang", "source"], names), langs, ["lang"])
    return both.select("lang", "source", "n", *[draw(c, "n", f"up_{c}").alias(c) for c in cols])


def judge(docs: DataFrame, **columns: str) -> DataFrame:
    """Measures of every row with base_failed and kept; also the names of the measures outside their fences (`faults`).

    A row fails the base rules with under LEAST_WORDS words, or over MOST_REPEATED_PERCENT % of its words in repeated
    windows. The others make the sketches, and are kept if each measure lies within the fences of their language and source (on a fence is within;
    so groups whose values are all equal lose none). Null text has no words and fails; null languages and sources are
    groups like others, null ids are rows like others. Repeated rows are judged alike, and count each. A text of any
    length is one row's work. An empty table gives none. Other columns are ignored, whatever their names.
    """
    m = materialize(measures(docs, **columns), "quality-measures")
    ratio = lambda x, y: F.coalesce(F.try_divide(F.col(x).cast("double"), F.col(y).cast("double")), F.lit(0.0))
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    m = m.select("*", failed.alias("base_failed"), *[ratio(*v).alias(k) for k, v in MEASURES.items()])
    limits = fences(m.filter("not base_failed"), list(MEASURES))
    bounds = F.struct(*[c for c in limits.columns if c not in ("lang", "source", "n")])
    judged = join_sums(m.filter("not base_failed"), limits.select("lang", "source", bounds.alias("fence")), ["lang", "source"])
    outside = [F.when((F.col(k) < F.col(f"fence.low_{k}") * (1 - NEAR)) | (F.col(k) > F.col(f"fence.high_{k}") * (1 + NEAR)), F.lit(k)) for k in MEASURES]
    judged = judged.withColumn("faults", F.array_compact(F.array(*outside))).drop("fence")
    out = judged.unionByName(m.filter("base_failed").withColumn("faults", F.array().cast("array<string>")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("faults") == 0))


def _sql() -> str:
    """The same by arithmetic on whole lists, for a database that has lists and windows."""
    word, ratios = r"[^\x20\x09-\x0D]+", ", ".join(f"coalesce({x} / nullif({y}, 0)::DOUBLE, 0) AS {k}" for k, (x, y) in MEASURES.items())
    names = list(MEASURES)
    cols = [f"{c}_{name}" for name in names for c in ("low", "high")]
    end = lambda b: f"CASE WHEN {b} = {ZERO} THEN 0 ELSE pow({GAMMA!r}::DOUBLE, {b}) END"
    pick = ", ".join(f"max({c}) FILTER (name = '{name}') AS {c}_{name}" for name in names for c in ("low", "high"))
    shares = ", ".join(f"min(CASE WHEN upto >= {share!r}::DOUBLE * total THEN bucket END) AS b_{k}" for k, share in QUANTILES.items())
    ends = ", ".join(f"{end(f'b_{k}')} AS e_{k}" for k in QUANTILES)
    two = ", ".join(map(repr, TWO_SIDED))
    low = f"CASE WHEN name NOT IN ({two}) THEN -1e300 WHEN e_q3 > e_q1 THEN e_q1 - {FENCE!r} * (e_q3 - e_q1) ELSE e_low / {GAMMA!r}::DOUBLE END"
    high = f"CASE WHEN e_q3 > e_q1 THEN e_q3 + {FENCE!r} * (e_q3 - e_q1) ELSE e_high END"

    def quantiles(source: str, keys: str) -> str:
        group = f"{keys}, name" if keys else "name"
        return f"""(SELECT {keys + ', ' if keys else ''}max(total) AS n, {pick} FROM (SELECT *, {low} AS low, {high} AS high FROM (SELECT *, {ends} FROM (
    SELECT {group}, max(total) AS total, {shares}
    FROM (SELECT *, sum(n) OVER (PARTITION BY {group} ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY {group}) AS total FROM {source}) GROUP BY {group}))) {'GROUP BY ' + keys if keys else ''})"""

    draw = lambda t, up: ", ".join(f"({t}.n * {t}.{c} + {SHRINK} * {up}.{c}) / ({t}.n + {SHRINK}) AS {c}" for c in cols)
    faults = ", ".join(f"CASE WHEN {k} < low_{k} * {1 - NEAR!r} OR {k} > high_{k} * {1 + NEAR!r} THEN '{k}' END" for k in names)
    buckets = " UNION ALL ".join(f"SELECT lang, source, '{k}' AS name, CASE WHEN {k} > 0 THEN ceil(ln({k}) / {math.log(GAMMA)!r}::DOUBLE)::INTEGER ELSE {ZERO} END AS bucket FROM m WHERE NOT base_failed" for k in names)
    return f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
l AS (SELECT *, regexp_extract_all(text, '{word}') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{word}')) AS lines FROM t),
w AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM l),
g AS (SELECT r, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS gram FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g WHERE gram IS NOT NULL) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM again, range({WINDOW}) AS x(k) GROUP BY r),
b AS (SELECT l.r, doc_id, lang, source, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars, len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
  len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words FROM l LEFT JOIN covered ON l.r = covered.r),
m AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed, {ratios} FROM b),
s AS (SELECT lang, source, name, bucket, count(*) AS n FROM ({buckets}) GROUP BY ALL),
sl AS (SELECT lang, name, bucket, sum(n) AS n FROM s GROUP BY ALL),
sa AS (SELECT name, bucket, sum(n) AS n FROM sl GROUP BY ALL),
qa AS {quantiles('sa', '')},
ql AS {quantiles('sl', 'lang')},
qg AS {quantiles('s', 'lang, source')},
fl AS (SELECT ql.lang, {draw('ql', 'qa')} FROM ql, qa),
f AS (SELECT qg.lang, qg.source, {draw('qg', 'fl')} FROM qg JOIN fl ON qg.lang IS NOT DISTINCT FROM fl.lang),
j AS (SELECT m.*, f.* EXCLUDE (lang, source)
  FROM m LEFT JOIN f ON NOT base_failed AND m.lang IS NOT DISTINCT FROM f.lang AND m.source IS NOT DISTINCT FROM f.source),
v AS (SELECT *, array_to_string(list_filter([{faults}], lambda x: x IS NOT NULL), ',') AS faults FROM j)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, NOT base_failed AND faults = '' AS kept, faults FROM v
"""


SQL = _sql()
