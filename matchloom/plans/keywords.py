"""Keyword queries: frequency-ranked tokens, rule keywords with fill-up, noun keywords, combined texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import text as T
from ..functions.arrays import in_turn
from ..operators.llm_output import fill_keywords
from ..sources.readers import table
from .registry import query

_TOK = "regexp_extract_all(lower(coalesce(text, '')), '([가-힣a-zA-Z0-9]{2,})')"
_FREQ = f"""
t AS (SELECT doc_id, unnest({_TOK}) AS token FROM documents),
f AS (SELECT doc_id, token, count(*) AS n FROM t GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, length(token) DESC, token) AS rank FROM f)"""


def frequent_tokens(spark: SparkSession, sf: str, n: int) -> DataFrame:
    t = table(spark, sf, "documents").select("doc_id", F.explode(T.tokens(F.col("text"))).alias("token"))
    f = t.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("doc_id").orderBy(F.desc("n"), F.desc(F.length("token")), "token")
    return f.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


@query(f"WITH {_FREQ} SELECT doc_id, token, n, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 20")
def keyword_freq(spark: SparkSession, sf: str) -> DataFrame:
    return frequent_tokens(spark, sf, 20)


@query(f"""WITH {_FREQ}, k AS (SELECT doc_id, list(token ORDER BY rank) AS kws FROM r WHERE rank <= 20 GROUP BY 1),
e AS (SELECT d.doc_id, list_filter([source, lang], lambda x: x IS NOT NULL) AS have, coalesce(kws, []) AS rule FROM documents d LEFT JOIN k USING (doc_id))
SELECT doc_id, array_to_string(list_filter((list_filter(have, lambda x, i: list_position(list_transform(have, lambda y: lower(y)), lower(x)) = i) || list_filter(rule, lambda x: NOT list_contains(list_transform(have, lambda y: lower(y)), lower(x))))[1:20], lambda x: lower(x) NOT IN ('the', 'that')), ';') AS keywords FROM e""")
def keyword_fallback(spark: SparkSession, sf: str) -> DataFrame:
    """Too few keywords are filled up to the most by rule; boilerplate goes after that."""
    w = frequent_tokens(spark, sf, 20).groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "token"))), lambda x: x["token"]).alias("rule"))
    d = table(spark, sf, "documents").select("doc_id", F.array_compact(F.array("source", "lang")).alias("have")).join(w, "doc_id", "left")
    rule = F.coalesce("rule", F.array().cast("array<string>"))
    return d.select("doc_id", F.array_join(fill_keywords(F.col("have"), rule, boilerplate=("the", "that")), ";").alias("keywords"))


_NOUNS = {
    "반도체 제품 도매업, 반도체도매업": "반도체;반도체",
    "정밀화학공업 및 관련된 서비스": "정밀화학",
    "생명공학에 이용한 원료의약품의 개발하는 기술": "생명공학;원료의약품",
    "AI 기반 5G 030301 EH030301 MP3 RS232 H264": "AI;기반;5G;MP3;H264",
    "스마트팩토리를 위한 IoT 센서 활용하여 구축": "스마트팩토리;IoT;센서",
    "업 업체 RFID-태그 제조업": "RFID;태그",
}


@query(f"SELECT c_custkey, ({[*_NOUNS.values()]})[CAST(c_custkey % 6 AS INTEGER) + 1] || ';' || replace(c_mktsegment, ' ', ';') || ';Customer' AS nouns FROM customer")
def noun_normalize_ko(spark: SparkSession, sf: str) -> DataFrame:
    """Descriptions of a business in Korean, its segment and a name with a code, as noun keywords."""
    text = F.concat(in_turn(F.col("c_custkey"), [*_NOUNS]), F.lit(" / "), "c_mktsegment", F.lit(" 관련 "), "c_name")
    return table(spark, sf, "customer").select("c_custkey", F.array_join(T.noun_keywords(text), ";").alias("nouns"))


@query("""WITH t AS (SELECT p_partkey, CASE CAST(p_partkey % 7 AS INTEGER) WHEN 0 THEN p_partkey::VARCHAR WHEN 1 THEN 'EH' || lpad(p_partkey::VARCHAR, 6, '0') WHEN 2 THEN 'K' || (p_partkey % 100) WHEN 3 THEN '가' || p_partkey WHEN 4 THEN p_brand WHEN 5 THEN split_part(p_name, ' ', 1) ELSE replace(p_brand, '#', '') END AS v FROM part)
SELECT p_partkey, v AS token, (NOT regexp_matches(v, '[가-힣]')) AND (regexp_full_match(v, '[0-9]+') OR (regexp_full_match(v, '[A-Za-z0-9]{5,}') AND regexp_matches(v, '[A-Za-z]') AND regexp_matches(v, '[0-9]'))) AS code FROM t""")
def meaningless_code(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers, brands and words of parts: which are codes that tell nothing."""
    k, key = F.col("p_partkey") % 7, F.col("p_partkey").cast("string")
    token = F.when(k == 0, key).when(k == 1, F.concat(F.lit("EH"), F.lpad(key, 6, "0"))).when(k == 2, F.concat(F.lit("K"), (F.col("p_partkey") % 100).cast("string"))).when(k == 3, F.concat(F.lit("가"), key))
    token = token.when(k == 4, F.col("p_brand")).when(k == 5, F.split_part("p_name", F.lit(" "), F.lit(1))).otherwise(F.replace("p_brand", F.lit("#"), F.lit("")))
    return table(spark, sf, "part").select("p_partkey", token.alias("token")).withColumn("code", T.is_meaningless_code(F.col("token")))


_NOCASE = "list_filter({a}, lambda x, i: list_position(list_transform({a}, lambda y: lower(y)), lower(x)) = i)"


@query(f"""WITH p AS (SELECT p_partkey, string_split(p_name, ' ') AS kws, {_TOK.replace('text', "p_type || ' ' || p_brand")} AS added, {_TOK.replace('text', 'p_name')} AS fb FROM part),
m AS (SELECT p_partkey, kws || added || CASE WHEN len(kws) <= 3 THEN fb ELSE [] END AS a FROM p)
SELECT p_partkey, array_to_string({_NOCASE.format(a='a')}, ';') AS combined FROM m""")
def combined_text(spark: SparkSession, sf: str) -> DataFrame:
    """Own keywords, those of other fields, and of the fallback field where there are three own ones at most."""
    p = table(spark, sf, "part")
    merged = A.merge_keywords(F.split("p_name", " "), T.tokens(F.concat_ws(" ", "p_type", "p_brand")), fallback=T.tokens(F.col("p_name")))
    return p.select("p_partkey", F.array_join(merged, ";").alias("combined"))


@query(f"""WITH m AS (SELECT conv_id, regexp_extract_all(string_agg(text, ' ' ORDER BY turn), '([가-힣a-zA-Z0-9]{{2,}})') AS a FROM conversations GROUP BY 1)
SELECT conv_id, array_to_string(({_NOCASE.format(a='a')})[1:15], ';') AS purposes FROM m""")
def purpose_list(spark: SparkSession, sf: str) -> DataFrame:
    turns = table(spark, sf, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", "text"))), lambda x: x["text"]), " ").alias("all"))
    words = F.regexp_extract_all("all", F.lit(T.TOKEN), F.lit(1))
    return turns.select("conv_id", F.array_join(A.cap(A.distinct_nocase(words), 15), ";").alias("purposes"))


@query(f"WITH m AS (SELECT doc_id, {_TOK.replace('lower(', '(')} AS a FROM documents) SELECT doc_id, len(list_distinct(list_transform(a, lambda x: lower(x)))) AS n, len(list_distinct(a)) AS n_exact FROM m")
def ordered_distinct(spark: SparkSession, sf: str) -> DataFrame:
    words = F.regexp_extract_all("text", F.lit(T.TOKEN), F.lit(1))
    d = table(spark, sf, "documents").select("doc_id", words.alias("a"))
    # For counts alone the distinct lower-case values do; the ordered form is quadratic in the length of a value list.
    return d.select("doc_id", F.size(F.array_distinct(F.transform("a", F.lower))).cast("long").alias("n"), F.size(F.array_distinct("a")).cast("long").alias("n_exact"))


@query(f"WITH d AS (SELECT doc_id, len({_TOK}) AS tokens, length(text) AS chars FROM documents) SELECT doc_id, tokens FROM d WHERE tokens <= 3000")
def token_budget(spark: SparkSession, sf: str) -> DataFrame:
    """Prompts over the token budget are left out."""
    d = table(spark, sf, "documents").select("doc_id", F.size(T.tokens(F.col("text"))).cast("long").alias("tokens"))
    return d.filter("tokens <= 3000")


