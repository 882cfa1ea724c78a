"""Model input and output: prompts, payloads, answers with fallbacks, sections and repairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import structs as X
from ..functions import text as T
from ..functions.arrays import in_turn
from ..operators import llm_output as L
from ..operators import models as M
from ..operators import retrieval as R
from ..sources.readers import table
from .registry import query
from .retrieval import _ALL_DOCS, _index_sql

#: Forms of scoring answers, by turn: D is an id, S a score; and the items that they hold.
_SCORE_ANSWERS = (
    '{"results": [{"id": D, "score": S.5, "reason": " good "}, {"id": 1D, "score": 130, "reason": "over"}, {"id": 2D, "score": -4, "reason": ""}]}',
    'text before {"results": [{"id": D, "score": S, "reason": "ok"}, {"score": 3}]} and after',
    '{"results": [{"id": D, "score": S, "reason": "ok"}, {"id": 2, "sco',
    '{"results": [{"id": D, "score": 5, "reason": "first"}, {"id": D, "score": S, "reason": "last"}]}',
    "no answer",
    ' [{"reason": "any order", "score": S.5, "id": D}, {"id": 1D, "score": 200, "reason": "bare"}] ',
    '[{"id": D, "score": S, "reason": "cut"}, {"id": 8, "sc',
)


@query("""WITH d AS (SELECT doc_id AS n, doc_id % 7 AS k, doc_id AS d, CAST('1' || doc_id AS BIGINT) AS d1, CAST('2' || doc_id AS BIGINT) AS d2, n_chars % 90 AS s, CAST(round_even(n_chars % 90 + 0.5::DOUBLE, 0) AS BIGINT) AS r FROM documents),
a AS (SELECT n, unnest(CASE CAST(k AS INTEGER) WHEN 0 THEN [{'id': d, 'score': r, 'reason': 'good'}, {'id': d1, 'score': 100, 'reason': 'over'}, {'id': d2, 'score': 0, 'reason': ''}] WHEN 1 THEN [{'id': d, 'score': s, 'reason': 'ok'}] WHEN 2 THEN [{'id': d, 'score': s, 'reason': 'ok'}]
  WHEN 3 THEN [{'id': d, 'score': s, 'reason': 'last'}] WHEN 5 THEN [{'id': d, 'score': r, 'reason': 'any order'}, {'id': d1, 'score': 100, 'reason': 'bare'}] WHEN 6 THEN [{'id': d, 'score': s, 'reason': 'cut'}] ELSE [] END) AS x FROM d)
SELECT n, x.id AS id, x.score AS score, x.reason AS reason FROM a""")
def parse_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scoring answers in all forms, whole, wrapped, cut and bare, with ids and scores of all documents."""
    form = F.replace(F.replace(in_turn(F.col("doc_id"), [*_SCORE_ANSWERS]), F.lit("D"), F.col("doc_id").cast("string")), F.lit("S"), (F.col("n_chars") % 90).cast("string"))
    return table(spark, sf, "documents").select(F.col("doc_id").alias("n"), F.inline(L.parse_scores(form)))


@query("""SELECT conv_id, turn, CAST(least(100, round_even(length(text)::DOUBLE / 10, 0)) AS INTEGER) AS score, role AS reason FROM conversations""")
def parse_scores_table(spark: SparkSession, sf: str) -> DataFrame:
    """Answers made from all conversation turns, read back by the parser; every third one is cut short and needs the fallback."""
    c = table(spark, sf, "conversations")
    whole = F.concat(F.lit('{"results": [{"id": '), F.col("turn").cast("string"), F.lit(', "score": '), F.bround(F.length("text") / 10).cast("int").cast("string"), F.lit(', "reason": "'), "role", F.lit('"}'))
    answer = F.concat(whole, F.when(F.col("conv_id") % 3 == 0, ', {"id": 9, "sc').otherwise("]}"))
    return c.select("conv_id", "turn", F.inline(L.parse_scores(answer))).select("conv_id", "turn", "score", "reason")


@query("""SELECT doc_id, CASE CAST(doc_id % 4 AS INTEGER) WHEN 0 THEN 'AI;' || coalesce(lang, '?') WHEN 2 THEN 'a b;' || coalesce(source, '?') ELSE '' END AS keywords FROM documents""")
def parse_keywords(spark: SparkSession, sf: str) -> DataFrame:
    """Keyword answers, whole, open, followed by more, and none."""
    k, word = F.col("doc_id") % 4, lambda c: F.coalesce(c, F.lit("?"))
    answer = F.when(k == 0, F.concat(F.lit('{"keywords": ["AI", " ai ", "'), word("lang"), F.lit('", ""]}'))).when(k == 1, 'x "keywords": ["one", "two", "ONE"')
    answer = answer.when(k == 2, F.concat(F.lit('{"keywords": ["a b", "'), word("source"), F.lit('"] broken'))).otherwise("none")
    return table(spark, sf, "documents").select("doc_id", F.array_join(L.parse_keywords(answer), ";").alias("keywords"))


_SECTIONS = ("연관성", "우수성")


@query("""SELECT c_custkey, CASE CAST(c_custkey % 3 AS INTEGER) WHEN 0 THEN c_mktsegment || ' 높다.' WHEN 1 THEN '본문 ' || c_mktsegment ELSE c_name || ' 안' END AS relation, CASE CAST(c_custkey % 3 AS INTEGER) WHEN 0 THEN '하나 ' || c_name WHEN 1 THEN c_name || ' 둘' ELSE '' END AS merit FROM customer""")
def parse_sections(spark: SparkSession, sf: str) -> DataFrame:
    """Explanations as an object, with a list among its values, by headers, and with a value in brackets."""
    k, name, segment = F.col("c_custkey") % 3, F.col("c_name"), F.col("c_mktsegment")
    answer = F.when(k == 0, F.concat(F.lit('{"연관성": "'), segment, F.lit(' 높다.", "우수성": ["하나", "'), name, F.lit('"]}')))
    answer = answer.when(k == 1, F.concat(F.lit("[연관성] 본문 "), segment, F.lit("\n\n[우수성] "), name, F.lit(" 둘"))).otherwise(F.concat(F.lit('{"연관성": "['), name, F.lit(' 안]"}')))
    found = L.parse_sections(answer, _SECTIONS)
    return table(spark, sf, "customer").select("c_custkey", F.element_at(found, _SECTIONS[0]).alias("relation"), F.element_at(found, _SECTIONS[1]).alias("merit"))


_DETAIL = "SELECT conv_id, turn, '[A] ' || role || chr(10) || chr(10) || '[B] ' || trim(replace(replace(text, '[', ''), ']', ''), ' ' || chr(10)) AS detail FROM conversations"


def _details(spark: SparkSession, sf: str) -> DataFrame:
    body = F.btrim(F.translate("text", "[]", ""), F.lit(" \n"))
    return table(spark, sf, "conversations").select("conv_id", "turn", F.concat(F.lit("[A] "), "role", F.lit("\n\n[B] "), body).alias("detail"))


@query(f"""WITH d AS ({_DETAIL}) SELECT conv_id, turn, '[A] ' || split_part(substr(detail, 5), chr(10), 1) AS a, length(substr(detail, strpos(detail, '[B] ') + 4)) AS b_chars FROM d""")
def split_sections(spark: SparkSession, sf: str) -> DataFrame:
    s = L.split_sections(F.col("detail"))
    d = _details(spark, sf).select("conv_id", "turn", F.element_at(s, 1).alias("a"), F.element_at(s, 2).alias("b"))
    return d.select("conv_id", "turn", F.concat("a.head", F.lit(" "), "a.body").alias("a"), F.length("b.body").cast("long").alias("b_chars"))


@query(f"""WITH d AS ({_DETAIL}) SELECT conv_id, turn, '[A] ' || 'turn ' || turn || chr(10) || chr(10) || substr(detail, strpos(detail, '[B] ')) AS detail FROM d WHERE substr(detail, strpos(detail, '[B] ') + 4) <> ''""")
def section_replace(spark: SparkSession, sf: str) -> DataFrame:
    d = _details(spark, sf)
    new = F.concat(F.lit("turn "), F.col("turn").cast("string"))
    return d.select("conv_id", "turn", L.replace_section(F.col("detail"), "[A]", new).alias("detail")).filter(F.col("detail").contains("[B]"))


@query("""SELECT conv_id, array_to_string(list('<|im_start|>' || role || chr(10) || trim(text) || '<|im_end|>' ORDER BY turn), chr(10)) || chr(10) || '<|im_start|>assistant' || chr(10) AS prompt FROM conversations GROUP BY 1""")
def prompt_messages(spark: SparkSession, sf: str) -> DataFrame:
    m = F.transform(F.sort_array(F.collect_list(F.struct("turn", "role", F.col("text").alias("content")))), lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    return table(spark, sf, "conversations").groupBy("conv_id").agg(m.alias("m")).select("conv_id", T.chat_prompt(F.col("m")).alias("prompt"))


@query("""SELECT d.doc_id, '{"id":' || d.doc_id || ',"source":"' || source || '","has_label":' || CASE WHEN l.doc_id IS NULL THEN 'false' ELSE 'true' END || CASE WHEN l.quality IS NULL THEN '' ELSE ',"quality":' || l.quality END || '}' AS payload FROM documents d LEFT JOIN labels l USING (doc_id)""")
def payload_json(spark: SparkSession, sf: str) -> DataFrame:
    """A record as the JSON that goes into a prompt; empty fields are left out."""
    d = table(spark, sf, "documents").select("doc_id", "source").join(table(spark, sf, "labels").select("doc_id", "quality", F.lit(True).alias("labelled")), "doc_id", "left")
    return d.select("doc_id", F.to_json(F.struct(F.col("doc_id").alias("id"), "source", F.coalesce("labelled", F.lit(False)).alias("has_label"), "quality")).alias("payload"))


@query("""SELECT d.doc_id, coalesce(l.quality * 60 + 20, 0) AS score, CASE WHEN l.doc_id IS NULL THEN '(LLM 응답 누락)' ELSE 'labelled' END AS reason FROM documents d LEFT JOIN labels l USING (doc_id)""")
def missing_score_default(spark: SparkSession, sf: str) -> DataFrame:
    answers = table(spark, sf, "labels").select("doc_id", (F.col("quality") * 60 + 20).alias("score"), F.lit("labelled").alias("reason"))
    return L.with_default_answer(table(spark, sf, "documents").select("doc_id"), answers, ["doc_id"])


@query("""SELECT n_nationkey, CASE WHEN n_nationkey % 3 = 2 THEN NULL ELSE n_name END AS grp FROM nation""")
def group_of_struct(spark: SparkSession, sf: str) -> DataFrame:
    """`{rank, group}` as JSON, as a Python literal, or with a group that is none."""
    n, k = table(spark, sf, "nation"), F.col("n_nationkey") % 3
    raw = F.when(k == 0, F.concat(F.lit('{"rank": 1, "group": "'), "n_name", F.lit('"}'))).when(k == 1, F.concat(F.lit("{'rank': None, 'group': '"), "n_name", F.lit("'}"))).otherwise('{"rank": 5, "group": "nan"}')
    return n.select("n_nationkey", X.group_of(raw).alias("grp"))


@query("""SELECT n_nationkey, CAST(n_nationkey AS VARCHAR) AS id, trim(n_name) AS name, 'r' || n_regionkey AS region, 'a;b' AS keywords FROM nation WHERE n_nationkey % 4 <> 3""")
def conduct_list_cleanup(spark: SparkSession, sf: str) -> DataFrame:
    """Nested performer lists: trimmed, without blanks, entries without any information left out."""
    n = table(spark, sf, "nation")
    item = F.concat(F.lit('{"company_id": "'), F.col("n_nationkey").cast("string"), F.lit('", "company_name": " '), "n_name", F.lit('", "company_info": {"region": "r'), F.col("n_regionkey").cast("string"), F.lit('", "company_keyword": ["a", " ", "b "]}}'))
    raw = F.when(F.col("n_nationkey") % 4 == 3, '[{"company_id": "none", "company_info": {"region": ""}}]').otherwise(F.concat(F.lit("["), item, F.lit(", {}]")))
    return n.select("n_nationkey", F.inline(X.conduct_list(raw, "company"))).select("n_nationkey", "id", "name", "region", F.array_join("keywords", ";").alias("keywords"))


@query("""WITH c AS (SELECT l_suppkey, p_partkey, p_name, p_type, p_brand, row_number() OVER (PARTITION BY l_suppkey ORDER BY p_partkey) AS pos FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) JOIN part ON p_partkey = l_partkey)
SELECT l_suppkey, '[candidates]' || chr(10) || string_agg(pos || '. ' || p_name || ' | ' || array_to_string((string_split(p_name, ' '))[1:8], ', ') || ' | ' || left(p_type || ' ' || p_brand, 280), chr(10) ORDER BY pos) AS block FROM c WHERE pos <= 20 GROUP BY 1""")
def candidate_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The candidate lists of prompts, 20 to a block."""
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name", F.concat_ws(" ", "p_type", "p_brand").alias("descr"))
    c = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey").distinct().join(part, "l_partkey")
    first = R.top_k(c, "l_suppkey", 20, F.col("l_partkey"), rank="pos")
    return M.candidate_block(first, "l_suppkey", "pos", M.candidate_line(F.col("pos"), F.col("p_name"), F.split("p_name", " "), F.col("descr")), "candidates")


@query("""SELECT p_partkey, '[name] ' || p_name || chr(10) || chr(10) || '[type] ' || p_type || CASE WHEN p_size > 25 THEN chr(10) || chr(10) || '[size] large' ELSE '' END AS detail FROM part""")
def explanation_template(spark: SparkSession, sf: str) -> DataFrame:
    """Sections with text, put together; empty ones are left out."""
    p = table(spark, sf, "part")
    return p.select("p_partkey", M.explanation({"name": F.col("p_name"), "type": F.col("p_type"), "size": F.when(F.col("p_size") > 25, "large").otherwise("")}).alias("detail"))


@query("""WITH t AS (SELECT item_id, unnest(regexp_extract_all(lower(coalesce(text, '')), '([가-힣a-zA-Z0-9]{2,})')) AS w FROM benchmark),
h AS (SELECT item_id, CAST('0x' || left(md5(w), 8) AS BIGINT) AS h FROM t), b AS (SELECT item_id, h % 64 AS i, sum(CASE WHEN h >= 2147483648 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END) AS x FROM h GROUP BY 1, 2),
l AS (SELECT item_id, sqrt(sum(x * x)) AS l FROM b GROUP BY 1), f AS (SELECT item_id, i, CAST(x / l AS FLOAT)::DOUBLE AS x FROM b JOIN l USING (item_id) WHERE l > 0),
n AS (SELECT item_id, sqrt(sum(x * x)) AS l FROM f GROUP BY 1), u AS (SELECT item_id, i, x / l AS x FROM f JOIN n USING (item_id)),
d AS (SELECT a.item_id AS query, b.item_id AS doc, sum(a.x * b.x) AS s FROM u a JOIN u b USING (i) GROUP BY 1, 2),
c AS (SELECT q.item_id AS query, e.item_id AS doc, round(greatest(-1.0::DOUBLE, least(1.0::DOUBLE, coalesce(d.s, 0))), 6) AS score FROM benchmark q JOIN benchmark e ON q.item_id <> e.item_id LEFT JOIN d ON d.query = q.item_id AND d.doc = e.item_id)
SELECT query, doc, score, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc) AS rank FROM c) WHERE rank <= 3""")
def encode_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors of all benchmark passages by the encoder boundary, and their nearest other passages."""
    b = M.encode(table(spark, sf, "benchmark"), "text").select(F.col("item_id").alias("vec_id"), "embedding")
    return R.cosine_top_k(b, b, 3)


@query(f"""WITH {_index_sql(_ALL_DOCS)}, k AS (SELECT * FROM (SELECT query, doc, row_number() OVER (PARTITION BY query ORDER BY round(score, 9) DESC, doc) AS pos FROM bm) WHERE pos <= 40)
SELECT query, doc, CAST(pos AS INTEGER) AS pos, CAST((pos - 1) // 20 AS INTEGER) AS batch, CAST(least(100, len(list_intersect(regexp_extract_all(lower(b.text), '[a-z]+'), regexp_extract_all(lower(d.text), '[a-z]+')))) AS INTEGER) AS score, 'shared words' AS reason
FROM k JOIN benchmark b ON item_id = query JOIN documents d ON doc_id = doc""")
def score_blocks_by_model(spark: SparkSession, sf: str) -> DataFrame:
    """Blocks of candidates as they go to a model function in Python workers; here a model that counts shared words."""

    def model(source: str, texts: list[str]) -> list[tuple[int, str]]:
        import re

        words = lambda t: set(re.findall("[a-z]+", t.lower()))
        return [(min(100, len(words(source) & words(t))), "shared words") for t in texts]

    best = R.bm25_scores(table(spark, sf, "benchmark"), R.build_index(table(spark, sf, "documents"), "doc_id", "text"), "item_id", "text")
    best = R.top_k(best, "query", 40, F.desc(F.round("score", 9)), F.col("doc"), rank="pos").select("query", "doc", "pos")
    b = table(spark, sf, "benchmark").select(F.col("item_id").alias("query"), F.col("text").alias("source"))
    candidates = best.join(b, "query").join(table(spark, sf, "documents").select(F.col("doc_id").alias("doc"), F.col("text").alias("body")), "doc")
    return M.score_in_blocks(candidates, "query", "pos", "source", "body", model).select("query", "doc", "pos", "batch", "score", "reason")
