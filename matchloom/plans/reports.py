"""Report queries: nested groups, chapters, metrics, coverage, attribute lines and the quality ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import words as W
from ..operators import checks as C
from ..operators import models as M
from ..operators import report as G
from ..operators.retrieval import top_k
from ..sources.readers import table
from ..sources.scratch import new_folder
from ..sources.writers import write_checked
from .registry import query

_FIELDS = ("BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD")


@query("""WITH u AS (SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT o_custkey, o_orderkey, o_totalprice FROM orders WHERE o_orderstatus <> 'F'),
r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM u)
SELECT o_custkey, string_agg(rank || ':' || o_orderkey, ',' ORDER BY rank) AS top5 FROM r WHERE rank <= 5 GROUP BY 1""")
def batch_union_nest(spark: SparkSession, sf: str) -> DataFrame:
    """Result batches put together, then the five best of each key as one nested list."""
    o = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_totalprice", "o_orderstatus")
    u = o.filter("o_orderstatus = 'F'").unionByName(o.filter("o_orderstatus <> 'F'"))
    best = top_k(u, "o_custkey", 5, F.desc("o_totalprice"), F.col("o_orderkey"))
    nested = G.nest(best, ["o_custkey"], "rank", ["o_orderkey"])
    return nested.select("o_custkey", F.array_join(F.transform("items", lambda x: F.concat_ws(":", x["rank"].cast("string"), x["o_orderkey"].cast("string"))), ",").alias("top5"))


@query(f"""SELECT c_mktsegment, CAST(list_position({list(_FIELDS)}, c_mktsegment) AS INTEGER) AS chapter, count(*) AS n, min(c_custkey) AS first_no, max(c_custkey) AS last_no FROM customer WHERE c_mktsegment IN {_FIELDS} GROUP BY 1, 2""")
def field_chapters(spark: SparkSession, sf: str) -> DataFrame:
    """Groups in their fixed order; unknown fields are not reported."""
    return G.chapters(table(spark, sf, "customer"), "c_mktsegment", "c_custkey", list(_FIELDS))


@query("""SELECT count(DISTINCT o_custkey) AS demands, count(*) AS recommendations, count(DISTINCT o_orderpriority) AS fields, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS finished FROM orders""")
def overview_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").agg(F.countDistinct("o_custkey").alias("demands"), F.count(F.lit(1)).alias("recommendations"), F.countDistinct("o_orderpriority").alias("fields"), F.count_if(F.col("o_orderstatus") == "F").alias("finished"))


@query("""WITH d AS (SELECT d.*, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id))
SELECT name, filled, total FROM (SELECT 'lang' AS name, count(nullif(trim(lang), '')) AS filled, count(*) AS total FROM d UNION ALL SELECT 'quality', count(quality), count(*) FROM d UNION ALL SELECT 'text', count(nullif(trim(text), '')), count(*) FROM d)""")
def coverage_counts(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "lang", "text").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return G.coverage(d, ["lang", "quality", "text"])


@query("""SELECT c_custkey, line, CASE line WHEN 1 THEN 'number' WHEN 2 THEN 'segment' ELSE 'nation' END AS label_1, CASE line WHEN 1 THEN CAST(c_custkey AS VARCHAR) WHEN 2 THEN coalesce(nullif(trim(c_mktsegment), ''), '-') ELSE coalesce(n_name, '-') END AS value_1,
CASE line WHEN 1 THEN 'name' WHEN 2 THEN 'rich' ELSE '' END AS label_2, CASE line WHEN 1 THEN c_name WHEN 2 THEN CASE WHEN c_acctbal > 5000 THEN 'Y' ELSE '-' END ELSE '' END AS value_2
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey, (SELECT unnest([1, 2, 3]) AS line)""")
def info_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Attributes in a fixed order, two to a line, '-' where one is missing."""
    c = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    values = [("number", T.dash(F.col("c_custkey"))), ("name", T.dash(F.col("c_name"))), ("segment", T.dash(F.col("c_mktsegment"))), ("rich", T.dash(F.when(F.col("c_acctbal") > 5000, "Y"))), ("nation", T.dash(F.col("n_name")))]
    return G.attribute_pairs(c, "c_custkey", values)


_LEDGER = r"""WITH d AS (SELECT count(*) FILTER (text IS NULL OR trim(text) = '') AS a, count(*) FILTER (lang IS NULL OR lang NOT IN ('en', 'fr', 'de', 'es')) AS b, count(*) FILTER (regexp_matches(text, '[*#$%&]{3}')) AS c, count(*) FILTER (n_chars <> length(text)) AS e,
count(*) - count(DISTINCT doc_id) AS f FROM documents) SELECT check_name AS "check", n_bad, n_bad = 0 AS passed FROM (SELECT unnest(['text_filled', 'lang_known', 'no_junk', 'chars_match']) AS check_name, unnest([a, b, c, e]) AS n_bad FROM d)"""


@query(_LEDGER)
def quality_ledger(spark: SparkSession, sf: str) -> DataFrame:
    t = F.col("text")
    checks = {"text_filled": F.trim(t) != "", "lang_known": F.col("lang").isin("en", "fr", "de", "es"), "no_junk": ~t.rlike("[*#$%&]{3}"), "chars_match": F.col("n_chars") == F.length(t)}
    return G.ledger(table(spark, sf, "documents"), checks)


@query(_LEDGER)
def observed_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """The same checks, counted while the documents are written."""
    t = F.col("text")
    checks = {"text_filled": F.trim(t) != "", "lang_known": F.col("lang").isin("en", "fr", "de", "es"), "no_junk": ~t.rlike("[*#$%&]{3}"), "chars_match": F.col("n_chars") == F.length(t)}
    return write_checked(table(spark, sf, "documents"), new_folder(spark, "checked"), checks)


@query("""WITH g AS (SELECT o_custkey, count(*) AS n, bool_or(o_orderstatus = 'F') AS any_done, bool_and(o_totalprice > 0) AS all_priced FROM orders GROUP BY 1)
SELECT n, count(*) AS groups, count(*) FILTER (any_done) AS with_done, bool_and(all_priced) AS priced FROM g WHERE n <> 5 GROUP BY 1""")
def cardinality_check(spark: SparkSession, sf: str) -> DataFrame:
    """Groups that do not have exactly five rows, by their size."""
    g = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.bool_or(F.col("o_orderstatus") == "F").alias("any_done"), F.bool_and(F.col("o_totalprice") > 0).alias("all_priced"))
    return g.filter("n <> 5").groupBy("n").agg(F.count(F.lit(1)).alias("groups"), F.count_if("any_done").alias("with_done"), F.bool_and("all_priced").alias("priced"))


@query("""SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN 'B,C' WHEN turn % 3 = 1 THEN 'C' ELSE '' END AS missing FROM conversations""")
def section_check(spark: SparkSession, sf: str) -> DataFrame:
    """The sections that texts lack."""
    plain = F.translate("text", "[]", "")
    detail = F.concat_ws("\n\n", F.concat(F.lit("[A] "), plain), F.when(F.col("turn") % 3 != 0, "[B] b"), F.when(F.col("turn") % 3 == 2, "[C] c"))
    return table(spark, sf, "conversations").select("conv_id", "turn", F.array_join(C.missing_sections(detail, ("A", "B", "C")), ",").alias("missing"))


@query("""WITH i AS (SELECT l_orderkey, l_linenumber FROM lineitem), o AS (SELECT o_orderkey, o_orderstatus IN ('O', 'F') AS subject, year(o_orderdate) >= 1995 AS recent FROM orders WHERE o_orderkey % 11 <> 0),
b AS (SELECT CASE WHEN coalesce(subject, false) THEN '' ELSE 'subject,' END || CASE WHEN coalesce(recent, false) THEN '' ELSE 'recent,' END AS broken FROM i LEFT JOIN o ON o_orderkey = l_orderkey) SELECT rtrim(broken, ',') AS broken, count(*) AS n FROM b GROUP BY 1""")
def compliance_check(spark: SparkSession, sf: str) -> DataFrame:
    """Results whose source rows break the filter they were found by, counted by rule."""
    o = table(spark, sf, "orders").filter("o_orderkey % 11 <> 0")
    rules = {"subject": F.col("o_orderstatus").isin("O", "F"), "recent": F.year("o_orderdate") >= 1995}
    d = C.complies(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", o, "o_orderkey", rules)
    return d.groupBy(F.array_join("broken", ",").alias("broken")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH p AS (SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 13 = 0 THEN ' ' ELSE 'R' || o_orderkey END AS reg_no, (['한국', 'US', 'PCT', '미국'])[CAST(o_orderkey % 4 AS INTEGER) + 1] AS country FROM orders)
SELECT * FROM (SELECT unnest(['number_if_registered', 'country_named']) AS "check", unnest([count(*) FILTER (o_orderstatus = 'F' AND trim(reg_no) = ''), count(*) FILTER (country IN ('KR', 'US', 'CN', 'JP', 'EP', 'WO', 'XI', 'XU'))]) AS n_bad,
unnest([count(*) FILTER (o_orderstatus = 'F' AND trim(reg_no) = '') = 0, count(*) FILTER (country IN ('KR', 'US', 'CN', 'JP', 'EP', 'WO', 'XI', 'XU')) = 0]) AS passed FROM p)""")
def conditional_required(spark: SparkSession, sf: str) -> DataFrame:
    """A registered patent has its number, and no country is left as a code."""
    k = F.col("o_orderkey")
    p = table(spark, sf, "orders").select("o_orderstatus", F.when(k % 13 == 0, " ").otherwise(F.concat(F.lit("R"), k.cast("string"))).alias("reg_no"), F.element_at(F.array(*map(F.lit, ("한국", "US", "PCT", "미국"))), (k % 4 + 1).cast("int")).alias("country"))
    return G.ledger(p, {"number_if_registered": C.required_if(F.col("o_orderstatus") == "F", F.col("reg_no")), "country_named": ~F.col("country").rlike("^(" + "|".join(W.COUNTRIES) + ")$")})


_TOP = "SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank, o_orderkey, o_orderpriority, o_orderdate, o_orderstatus FROM orders"


@query(f"""WITH a AS (SELECT o_custkey, CAST(rank AS INTEGER) AS rank, replace(o_orderpriority, ' ', '') || o_orderkey AS v FROM ({_TOP}) WHERE rank <= 5), b AS (SELECT o_custkey, rank, CASE WHEN rank = 2 AND o_custkey % 5 = 0 THEN 'other' ELSE v END AS v FROM a WHERE NOT (rank = 5 AND o_custkey % 7 = 0))
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(a.rank, b.rank) AS rank, a.v AS "left", b.v AS "right" FROM a FULL JOIN b ON a.o_custkey = b.o_custkey AND a.rank = b.rank WHERE a.v IS DISTINCT FROM b.v""")
def ordered_equality(spark: SparkSession, sf: str) -> DataFrame:
    """Places where a report's lists and their source differ, white space aside."""
    top = top_k(table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderpriority", "o_totalprice"), "o_custkey", 5, F.desc("o_totalprice"), F.col("o_orderkey"))
    a = top.select("o_custkey", "rank", F.concat("o_orderpriority", F.lit(" "), F.col("o_orderkey").cast("string")).alias("v"))
    b = a.filter("not (rank = 5 and o_custkey % 7 = 0)").withColumn("v", F.when((F.col("rank") == 2) & (F.col("o_custkey") % 5 == 0), "other").otherwise(F.col("v")))
    return C.order_differences(a, b, ["o_custkey"], "rank", "v")


@query(f"""SELECT o_custkey AS no, CAST(rank AS VARCHAR) AS rank, 'order ' || o_orderkey AS title, o_orderpriority AS org, CAST(year(o_orderdate) AS VARCHAR) AS years, CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE '-' END AS reason FROM ({_TOP}) WHERE rank <= 5""")
def top_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The lines of a report's table of the five best: rank, title, organisation, years, reason."""
    o = top_k(table(spark, sf, "orders"), "o_custkey", 5, F.desc("o_totalprice"), F.col("o_orderkey"))
    years = T.year_lines(F.concat(F.year("o_orderdate").cast("string"), F.lit("년 과제")))
    return o.select(F.col("o_custkey").alias("no"), F.col("rank").cast("string").alias("rank"), F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("title"), F.col("o_orderpriority").alias("org"), years.alias("years"), T.dash(F.when(F.col("o_orderstatus") == "F", "done")).alias("reason"))


@query("""WITH p AS (SELECT o_custkey, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P' AND o_orderkey % 4 = 0)
SELECT c_custkey, coalesce(CASE o_orderstatus WHEN 'F' THEN '등록' WHEN 'O' THEN '출원' END, '특허 실적 없음') AS status, coalesce('patent ' || o_orderkey, '-') AS title FROM customer LEFT JOIN p ON o_custkey = c_custkey""")
def patent_section(spark: SparkSession, sf: str) -> DataFrame:
    """The patents of each project, or one line that says there are none."""
    p = table(spark, sf, "orders").filter("o_orderstatus <> 'P' and o_orderkey % 4 = 0").select(F.col("o_custkey").alias("c_custkey"), F.when(F.col("o_orderstatus") == "F", "등록").otherwise("출원").alias("status"), F.concat(F.lit("patent "), F.col("o_orderkey").cast("string")).alias("title"))
    return G.rows_or_none(table(spark, sf, "customer").select("c_custkey"), p, "c_custkey", {"status": "특허 실적 없음", "title": "-"})


@query("""SELECT doc_id, md5('[문서]' || chr(10) || coalesce(text, '') || chr(10) || chr(10) || '[기업]' || chr(10) || coalesce(source, '') || chr(10) || chr(10) || '[수요]' || chr(10) || '- 언어: ' || coalesce(trim(lang), '') || chr(10) || '- 길이: ' || n_chars) AS prompt_md5 FROM documents""")
def prompt_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks of a prompt: a whole document, a source, and named fields."""
    blocks = [M.text_block("문서", F.col("text")), M.text_block("기업", F.col("source")), M.field_block("수요", {"언어": F.col("lang"), "길이": F.col("n_chars")})]
    return table(spark, sf, "documents").select("doc_id", F.md5(F.concat_ws("\n\n", *blocks)).alias("prompt_md5"))
