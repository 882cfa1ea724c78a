"""Selection queries: titles, first rows, targets, slices, sheets, sets and checkpoints."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import report as G
from ..operators import selection as S
from ..sources import readers
from ..sources.readers import table
from .registry import query


@query("""WITH d AS (SELECT source, doc_id, split_part(text, chr(10), 1) AS title, n_chars FROM documents),
f AS (SELECT *, row_number() OVER (PARTITION BY source, replace(lower(trim(title)), 'ß', 'ss') ORDER BY n_chars DESC, doc_id) AS nth FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id) AS rank FROM f WHERE nth = 1)
SELECT source, doc_id, title, n_chars, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5""")
def title_dedup_topn(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("source", "doc_id", F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"), "n_chars")
    return S.title_dedup_top_n(d, "source", "title", 5, F.desc("n_chars"), F.col("doc_id"))


@query(r"""WITH w AS (SELECT unnest(regexp_extract_all(text, '[A-Za-zÀ-ÖØ-öø-ÿ]+')) AS w FROM documents),
s AS (SELECT w, replace(lower(w), 'ß', 'ss') AS key, count(*) AS n FROM w GROUP BY 1, 2)
SELECT min(lower(w)) AS word, sum(n)::BIGINT AS n, count(*) AS n_spellings FROM s GROUP BY key""")
def nocase_words(spark: SparkSession, sf: str) -> DataFrame:
    """All words of the documents, blind to case: ß is ss."""
    words = table(spark, sf, "documents").select(F.explode(F.regexp_extract_all("text", F.lit("[A-Za-zÀ-ÖØ-öø-ÿ]+"), F.lit(0))).alias("w"))
    return S.spellings(words, "w")


@query("""SELECT md5(text) AS text_md5, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY text""")
def first_wins_dedup(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies"))
    return d.select(F.md5("text").alias("text_md5"), "doc_id", "copies")


@query("""WITH f AS (SELECT user_id, event_type, event_id, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS nth FROM events)
SELECT user_id, event_type, event_id, value FROM f WHERE nth = 1""")
def setdefault_first(spark: SparkSession, sf: str) -> DataFrame:
    return S.first_by(table(spark, sf, "events"), ["user_id", "event_type"], F.col("ts"), F.col("event_id")).select("user_id", "event_type", "event_id", "value")


@query("""SELECT c_mktsegment, min(c_custkey) AS pos FROM customer WHERE c_mktsegment <> 'MACHINERY' GROUP BY 1""")
def target_resolve(spark: SparkSession, sf: str) -> DataFrame:
    return S.resolve_targets(table(spark, sf, "customer"), "c_mktsegment", "c_custkey", exclude=("MACHINERY",))


@query("""SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100 OFFSET 50""")
def row_slice(spark: SparkSession, sf: str) -> DataFrame:
    """Offset and limit are the feature here (a numbered excerpt)."""
    return S.row_slice(table(spark, sf, "orders"), 50, 100, F.col("o_orderdate"), F.col("o_orderkey")).select("o_orderkey", "o_custkey", "o_totalprice")


@query("""SELECT p_name AS name, p_partkey AS id, p_brand AS brand FROM part WHERE trim(p_brand) = trim((SELECT min(p_brand) FROM part))""")
def conform_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Reorder to a fixed column list, drop the rest, let a corrected column take its original's place; trimmed equality."""
    p = table(spark, sf, "part").select(F.lit("old").alias("name"), F.col("p_name").alias("name_fixed"), F.col("p_partkey").alias("id"), F.col("p_brand").alias("brand"), "p_size")
    least = table(spark, sf, "part").agg(F.min("p_brand").alias("least"))
    p = p.join(F.broadcast(least), F.trim("brand") == F.trim("least"), "left_semi")
    return S.conform(p, ["name", "id", "brand", "absent"], {"name": "name_fixed"})


@query(r"""WITH n AS (SELECT regexp_replace(c_name, '[0-9]', '', 'g') || ':' || c_mktsegment || (CASE WHEN c_custkey % 2 = 0 THEN 'a' ELSE 'A' END) || repeat('x', CAST(c_custkey % 3 AS INTEGER) * 12) AS name, c_custkey FROM customer),
f AS (SELECT name, min(c_custkey) AS pos FROM n GROUP BY 1),
b AS (SELECT *, left(coalesce(nullif(trim(regexp_replace(name, '[\[\]:*?/\\]', ' ', 'g')), ''), '무명'), 31) AS base FROM f),
r AS (SELECT *, row_number() OVER (PARTITION BY lower(base) ORDER BY pos) - 1 AS nth FROM b)
SELECT name, pos, CASE WHEN nth = 0 THEN base ELSE left(base, CAST(31 - length('_' || nth) AS BIGINT)) || '_' || nth END AS sheet FROM r""")
def sheet_names(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    name = F.concat(F.regexp_replace("c_name", "[0-9]", ""), F.lit(":"), "c_mktsegment", F.when(F.col("c_custkey") % 2 == 0, "a").otherwise("A"), F.repeat(F.lit("x"), (F.col("c_custkey") % 3 * 12).cast("int")))
    return S.sheet_names(c.select(name.alias("name"), "c_custkey"), "name", "c_custkey")


@query("""SELECT d.doc_id, d.source FROM documents d SEMI JOIN labels l ON l.doc_id = d.doc_id AND l.quality = 1""")
def semi_reduce(spark: SparkSession, sf: str) -> DataFrame:
    keys = table(spark, sf, "labels").filter("quality = 1").select("doc_id")
    return table(spark, sf, "documents").select("doc_id", "source").join(keys, "doc_id", "left_semi")


@query("""SELECT d.doc_id, d.source FROM documents d ANTI JOIN labels l ON l.doc_id = d.doc_id""")
def anti_todo(spark: SparkSession, sf: str) -> DataFrame:
    return S.todo(table(spark, sf, "documents").select("doc_id", "source"), table(spark, sf, "labels"), ["doc_id"])


@query("""WITH t AS (SELECT DISTINCT lower(trim(split_part(text, chr(10), 1))) AS title FROM documents d JOIN labels l USING (doc_id))
SELECT d.doc_id, CASE WHEN lower(trim(split_part(d.text, chr(10), 1))) IN (SELECT title FROM t) THEN 'recover' ELSE 'regenerate' END AS action
FROM documents d ANTI JOIN labels l ON l.doc_id = d.doc_id""")
def recover_vs_regen(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without details: those of a known title are recovered, the rest made again."""
    title = F.lower(F.trim(F.split_part("text", F.lit("\n"), F.lit(1))))
    d = table(spark, sf, "documents").select("doc_id", title.alias("title"))
    labels = table(spark, sf, "labels").select("doc_id")
    known = d.join(labels, "doc_id", "left_semi").select("title").distinct().withColumn("known", F.lit(True))
    return S.todo(d, labels, ["doc_id"]).join(known, "title", "left").select("doc_id", F.when(F.col("known"), "recover").otherwise("regenerate").alias("action"))


@query("""WITH a AS (SELECT doc_id, 'q' || quality AS v FROM labels WHERE quality = 1), b AS (SELECT doc_id, 't' || toxic AS v FROM labels),
c AS (SELECT doc_id, 'lang ' || lang AS v FROM documents WHERE lang <> 'en')
SELECT d.doc_id, coalesce(a.v, b.v, c.v) AS v, CASE WHEN a.v IS NOT NULL THEN 'pkl' WHEN b.v IS NOT NULL THEN 'json' WHEN c.v IS NOT NULL THEN 'regen' ELSE 'miss' END AS src
FROM documents d LEFT JOIN a USING (doc_id) LEFT JOIN b USING (doc_id) LEFT JOIN c USING (doc_id)""")
def source_priority_resolve(spark: SparkSession, sf: str) -> DataFrame:
    d, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    a = labels.filter("quality = 1").select("doc_id", F.concat(F.lit("q"), F.col("quality")).alias("v"))
    b = labels.select("doc_id", F.concat(F.lit("t"), F.col("toxic")).alias("v"))
    c = d.filter("lang <> 'en'").select("doc_id", F.concat(F.lit("lang "), F.col("lang")).alias("v"))
    return S.resolve_sources(d.select("doc_id"), [("pkl", a), ("json", b), ("regen", c)], "doc_id", "v")


@query("""WITH s AS (SELECT CASE WHEN nullif(trim(v), '') IS NULL THEN NULL ELSE v END AS v, src FROM (SELECT coalesce(q, t) AS v, CASE WHEN q IS NOT NULL THEN 'a' WHEN t IS NOT NULL THEN 'b' ELSE 'none' END AS src FROM (
  SELECT CASE WHEN quality = 1 THEN 'q' END AS q, CASE WHEN toxic = 1 THEN 't' END AS t FROM labels)))
SELECT src, count(*) AS n FROM s GROUP BY 1 HAVING count(*) <> 5""")
def count_by_source(spark: SparkSession, sf: str) -> DataFrame:
    """Rows by the source that answered, groups of other than the wanted size."""
    q, t = F.when(F.col("quality") == 1, "q"), F.when(F.col("toxic") == 1, "t")
    src = F.when(q.isNotNull(), "a").when(t.isNotNull(), "b").otherwise("none")
    return table(spark, sf, "labels").groupBy(src.alias("src")).agg(F.count(F.lit(1)).alias("n")).filter("n <> 5")


@query("""WITH s AS (SELECT conv_id, turn, CASE WHEN role = 'user' THEN text END AS head FROM conversations)
SELECT conv_id, turn, last_value(head IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS heading FROM s""")
def forward_fill_headings(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.when(F.col("role") == "user", F.col("text")).alias("head"))
    return c.select("conv_id", "turn", S.forward_fill(c, "turn", "head", ["conv_id"]).alias("heading"))


@query("""WITH l AS (SELECT l_returnflag AS k, l_linestatus AS v FROM lineitem WHERE l_linenumber <= 4), r AS (SELECT l_returnflag AS k, l_linestatus AS v FROM lineitem WHERE l_linenumber <> 3),
b AS (SELECT k, v, sum(d) AS d FROM (SELECT *, 1 AS d FROM l UNION ALL SELECT *, -1 FROM r) GROUP BY 1, 2)
SELECT CASE WHEN d > 0 THEN 'left' ELSE 'right' END AS side, k, v, CAST(abs(d) AS BIGINT) AS n FROM b WHERE d <> 0""")
def reconcile_sets(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("k"), F.col("l_linestatus").alias("v"), "l_linenumber")
    return G.reconcile(li.filter("l_linenumber <= 4"), li.filter("l_linenumber <> 3"), ["k", "v"])


@query("""WITH a AS (SELECT c_nationkey AS k FROM customer), b AS (SELECT s_nationkey AS k FROM supplier), c AS (SELECT n_nationkey AS k FROM nation)
SELECT k, CAST(bool_or(src = 'a') AS INTEGER) + CAST(bool_or(src = 'b') AS INTEGER) + CAST(bool_or(src = 'c') AS INTEGER) AS sources FROM (SELECT k, 'a' AS src FROM a UNION SELECT k, 'b' FROM b UNION SELECT k, 'c' FROM c) GROUP BY 1""")
def key_set_union(spark: SparkSession, sf: str) -> DataFrame:
    parts = [table(spark, sf, t).select(F.col(c).alias("k"), F.lit(s).alias("src")) for t, c, s in (("customer", "c_nationkey", "a"), ("supplier", "s_nationkey", "b"), ("nation", "n_nationkey", "c"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("k").agg(F.countDistinct("src").cast("int").alias("sources"))


@query(r"""SELECT doc_id, regexp_matches(text, '(?i)license|copyright') AS licence, regexp_matches(text, '[0-9]{3}-[0-9]{4}') AS phone, regexp_matches(text, '[*#$%&]{3}') AS junk FROM documents""")
def regex_flags(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("text")
    return table(spark, sf, "documents").select("doc_id", t.rlike("(?i)license|copyright").alias("licence"), t.rlike("[0-9]{3}-[0-9]{4}").alias("phone"), t.rlike("[*#$%&]{3}").alias("junk"))


@query("""WITH p AS (SELECT '/out/report_' || p_brand || '_v' || p_size || '.docx' AS path FROM part)
SELECT max(CAST(regexp_extract(path, '_v(\\d+)', 1) AS INTEGER)) AS latest, max(CAST(regexp_extract(path, '_v(\\d+)', 1) AS INTEGER)) + 1 AS next FROM p""".replace("\\\\", "\\"))
def newest_version(spark: SparkSession, sf: str) -> DataFrame:
    paths = table(spark, sf, "part").select(F.concat(F.lit("/out/report_"), "p_brand", F.lit("_v"), F.col("p_size"), F.lit(".docx")).alias("path"))
    return readers.next_version(paths)


@query(r"""WITH k AS (SELECT regexp_replace(p_brand, '\s+', '', 'g') AS a, regexp_replace(p_type, '\s+', '', 'g') AS b, regexp_replace(p_name, '\s+', '', 'g') AS c, p_partkey FROM part),
f AS (SELECT a, b, c, min(p_partkey) AS first_key FROM k GROUP BY 1, 2, 3)
SELECT p_partkey, first_key FROM k JOIN f USING (a, b, c)""")
def three_key_join(spark: SparkSession, sf: str) -> DataFrame:
    """Rows find their details by three names without white space; the first wins."""
    k = table(spark, sf, "part").select(T.squeeze(F.col("p_brand")).alias("a"), T.squeeze(F.col("p_type")).alias("b"), T.squeeze(F.col("p_name")).alias("c"), "p_partkey")
    firsts = k.groupBy("a", "b", "c").agg(F.min("p_partkey").alias("first_key"))
    return k.join(firsts, ["a", "b", "c"]).select("p_partkey", "first_key")


@query("""WITH k AS (SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY 1, 2) SELECT p_brand, p_type, n FROM k WHERE n > 1""")
def two_key_collisions(spark: SparkSession, sf: str) -> DataFrame:
    """Keys of two names that are not unique: a join on them would mix rows."""
    return table(spark, sf, "part").groupBy("p_brand", "p_type").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
