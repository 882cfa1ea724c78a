"""Cell formats: flags, ratios, money, dates, periods, escapes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.arrays import in_turn
from ..sources.readers import table
from .registry import query



@query("""WITH f AS (SELECT o_orderkey, (['yes', '1', 't', 'Y', 'true', 'no', '0', 'F', 'N', '?', '', 'nan'])[CAST(o_orderkey % 12 AS INTEGER) + 1] AS flag FROM orders)
SELECT o_orderkey, flag, CASE WHEN upper(flag) IN ('Y', 'YES', '1', 'TRUE', 'T') THEN 'Y' WHEN upper(flag) IN ('N', 'NO', '0', 'FALSE', 'F') THEN 'N' ELSE '' END AS yn FROM f""")
def yn_flag(spark: SparkSession, sf: str) -> DataFrame:
    flags = F.array(*map(F.lit, ("yes", "1", "t", "Y", "true", "no", "0", "F", "N", "?", "", "nan")))
    o = table(spark, sf, "orders").select("o_orderkey", F.element_at(flags, (F.col("o_orderkey") % 12 + 1).cast("int")).alias("flag"))
    return o.withColumn("yn", T.yes_no(F.col("flag")))


@query("""SELECT p_partkey, CASE WHEN p_size IN (1, 5, 10, 20) THEN p_size END AS ratio, CASE WHEN p_size IN (1, 5, 10, 20) THEN p_brand END AS grp FROM part""")
def ratio_bucket(spark: SparkSession, sf: str) -> DataFrame:
    """A ratio counts only if it is one of the published steps; the group goes with it."""
    ratio = T.ratio_bucket(F.col("p_size").cast("string"))
    return table(spark, sf, "part").select("p_partkey", ratio.alias("ratio"), F.when(ratio.isNotNull(), F.col("p_brand")).alias("grp"))


@query("""WITH r AS (SELECT p_partkey, p_brand, percent_rank() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS pr FROM part)
SELECT p_partkey, p_brand, CASE WHEN pr <= 0.01 THEN 1 WHEN pr <= 0.05 THEN 5 WHEN pr <= 0.1 THEN 10 WHEN pr <= 0.2 THEN 20 END AS top_percent FROM r""")
def percentile_class(spark: SparkSession, sf: str) -> DataFrame:
    """The producer of the ratio columns: top 1, 5, 10 and 20 % of each group."""
    pr = F.percent_rank().over(Window.partitionBy("p_brand").orderBy(F.desc("p_retailprice"), "p_partkey"))
    p = table(spark, sf, "part").select("p_partkey", "p_brand", pr.alias("pr"))
    step = F.when(F.col("pr") <= 0.01, 1).when(F.col("pr") <= 0.05, 5).when(F.col("pr") <= 0.1, 10).when(F.col("pr") <= 0.2, 20)
    return p.select("p_partkey", "p_brand", step.alias("top_percent"))


@query("""WITH p AS (SELECT o_orderkey, CASE CAST(o_orderkey % 5 AS INTEGER) WHEN 0 THEN CAST(round(o_totalprice * 1000) AS BIGINT) WHEN 1 THEN CAST(floor(o_totalprice) AS BIGINT) WHEN 2 THEN CAST(floor(o_totalprice / 100) AS BIGINT) END AS w, o_orderkey % 5 AS k FROM orders)
SELECT o_orderkey, CASE k WHEN 3 THEN '-' WHEN 4 THEN '미정' ELSE CASE WHEN w >= 100000000 THEN printf('%.1f', w / 100000000.0::DOUBLE) || '억원' WHEN w >= 10000 THEN format('{:,}', CAST(round_even(w / 10000.0::DOUBLE, 0) AS BIGINT)) || '만원' ELSE format('{:,}', w) || '원' END END AS money FROM p""")
def money_format(spark: SparkSession, sf: str) -> DataFrame:
    """Amounts that arrive as text: whole, with a trailing .0, blank, and words."""
    k, price = F.col("o_orderkey") % 5, F.col("o_totalprice")
    whole = lambda c: c.cast("long").cast("string")
    won = F.when(k == 0, whole(F.round(price * 1000))).when(k == 1, F.concat(whole(F.floor(price)), F.lit(".0"))).when(k == 2, whole(F.floor(price / 100))).when(k == 3, " ").otherwise("미정")
    return table(spark, sf, "orders").select("o_orderkey", T.money_cell(won).alias("money"))


@query("""WITH d AS (SELECT o_orderkey, CASE CAST(o_orderkey % 4 AS INTEGER) WHEN 0 THEN strftime(o_orderdate, '%Y%m%d') WHEN 1 THEN strftime(o_orderdate, '%Y%m00') WHEN 2 THEN strftime(o_orderdate, '%Y0000') ELSE 'n/a' END AS raw FROM orders)
SELECT o_orderkey, raw, CASE WHEN NOT regexp_full_match(raw, '[0-9]{8}') THEN raw WHEN raw[5:6] = '00' THEN raw[1:4] WHEN raw[7:8] = '00' THEN raw[1:4] || '.' || raw[5:6] ELSE raw[1:4] || '.' || raw[5:6] || '.' || raw[7:8] END AS cell FROM d""")
def date_format(spark: SparkSession, sf: str) -> DataFrame:
    """Dates with unknown parts stay text: no calendar type holds them."""
    k, d = F.col("o_orderkey") % 4, "o_orderdate"
    raw = F.when(k == 0, F.date_format(d, "yyyyMMdd")).when(k == 1, F.concat(F.date_format(d, "yyyyMM"), F.lit("00"))).when(k == 2, F.concat(F.date_format(d, "yyyy"), F.lit("0000"))).otherwise("n/a")
    o = table(spark, sf, "orders").select("o_orderkey", raw.alias("raw"))
    return o.withColumn("cell", T.date_cell(F.col("raw")))


@query("""SELECT d.doc_id, coalesce(nullif(trim(CAST(l.quality AS VARCHAR)), ''), '-') AS quality, coalesce(nullif(trim(d.lang), ''), '-') AS lang FROM documents d LEFT JOIN labels l USING (doc_id)""")
def dash_default(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id", "left")
    return d.select("doc_id", T.dash(F.col("quality")).alias("quality"), T.dash(F.col("lang")).alias("lang"))


@query("""SELECT page_id, md5(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(10), '<br/>')) AS escaped_md5, regexp_extract(url, '^https?://([^/]+)', 1) AS host FROM pages""")
def html_escape(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", F.md5(T.html_escape(F.col("html"))).alias("escaped_md5"), F.regexp_extract("url", "^https?://([^/]+)", 1).alias("host"))


_FIELDS = ["정보통신", "생명과학", "기계 설계", "정보.통신", "과제 연구"]


@query(f"""WITH d AS (SELECT o_orderkey, o_orderkey % 6 AS k, year(o_orderdate) AS y, year(o_orderdate) + o_orderkey % 3 AS z, ({_FIELDS})[CAST(o_orderkey // 6 % 5 AS INTEGER) + 1] AS field FROM orders)
SELECT o_orderkey, CASE WHEN k = 5 THEN NULL WHEN k = 0 AND y <> z THEN y || '년 ~ ' || z || '년' ELSE y || '년' END AS period, CASE WHEN k = 5 OR field = '과제 연구' THEN NULL ELSE replace(field, '.', '·') END AS class FROM d""")
def period_and_class(spark: SparkSession, sf: str) -> DataFrame:
    """Years and field of descriptions in several phrasings; a field that names the project itself is none."""
    o = table(spark, sf, "orders")
    k, y, field = F.col("o_orderkey") % 6, F.year("o_orderdate").cast("string"), in_turn(F.floor(F.col("o_orderkey") / 6), _FIELDS)
    z = (F.year("o_orderdate") + F.col("o_orderkey") % 3).cast("string")
    descr = F.when(k == 0, F.concat(F.lit("이 과제는 "), y, F.lit("년 3월 1일에 시작하여 "), z, F.lit("년 12월 31일에 종료되었고, "), field, F.lit(" 분야에 속한다.")))
    descr = descr.when(k == 1, F.concat(y, F.lit("년 1월 1일에 시작되어 "), y, F.lit("년 12월 31일에 종료된 이 과제는 "), field, F.lit(" 분야에 해당한다.")))
    descr = descr.when(k == 2, F.concat(y, F.lit("년에 수행하며 "), field, F.lit(" 분야에 속하는 과제."))).when(k == 3, F.concat(y, F.lit("년 사업에서는 "), field, F.lit(" 분야의 연구를 한다.")))
    descr = descr.when(k == 4, F.concat(y, F.lit("년의 연구는 "), field, F.lit(" 분야에서 이루어진다."))).otherwise("연도도 없고 아무것도 없다.")
    return o.select("o_orderkey", T.period_cell(descr).alias("period"), T.subject_class(descr).alias("class"))


_SENTENCES = {"좋은 결과입니다.이 과제는": "좋은 결과입니다. 이 과제는", "3.2억원": "3.2억원", "H.264": "H.264", "β-1,3": "β-1,3", "성장률 5%.다음": "성장률 5%. 다음", "끝.": "끝. ", "(참고).그리고": "(참고). 그리고"}


@query(f"SELECT p_partkey, ({[*_SENTENCES.values()]})[CAST(p_partkey % 7 AS INTEGER) + 1] || p_name || '. ' || p_size || '.5' AS spaced FROM part")
def spacing_fix(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat(in_turn(F.col("p_partkey"), [*_SENTENCES]), "p_name", F.lit(". "), F.col("p_size").cast("string"), F.lit(".5"))
    return table(spark, sf, "part").select("p_partkey", T.fix_spacing(raw).alias("spaced"))


@query("""SELECT c_custkey, CASE CAST(c_custkey % 5 AS INTEGER) WHEN 0 THEN c_name || '은 우수한 기업이다. ' || c_mktsegment || ' 실적이 많다.' WHEN 1 THEN '해당 내용은 생략합니다.' WHEN 2 THEN c_name || '의 특허가 3건 있다.' WHEN 3 THEN c_mktsegment || ' 기업이 존재하지 않는다. ' || c_name || ' 자료는 제공되지 않았다.' ELSE '끝이다.' END AS scrubbed FROM customer""")
def absence_scrub(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences that tell of missing information go, unless nothing else is there."""
    k, name, segment = F.col("c_custkey") % 5, F.col("c_name"), F.col("c_mktsegment")
    raw = F.when(k == 0, F.concat(name, F.lit("은 우수한 기업이다. 관련 정보가 없다. "), segment, F.lit(" 실적이 많다."))).when(k == 1, "해당 내용은 생략합니다.").when(k == 2, F.concat(name, F.lit("의 특허가 3건 있다.")))
    raw = raw.when(k == 3, F.concat(segment, F.lit(" 기업이 존재하지 않는다. "), name, F.lit(" 자료는 제공되지 않았다."))).otherwise(F.concat(name, F.lit(" 내용은 확인되지 않아요. 끝이다.")))
    return table(spark, sf, "customer").select("c_custkey", T.scrub_absence(raw).alias("scrubbed"))


@query(r"""WITH t AS (SELECT doc_id, split_part(text, chr(10), 1) || ' (출처: ' || source || ')' AS head FROM documents)
SELECT doc_id, head, regexp_replace(head, '\s*\(출처[:：][^)]*\)\s*$', '') AS clean FROM t""")
def source_tag_strip(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id", F.concat(F.split_part("text", F.lit("\n"), F.lit(1)), F.lit(" (출처: "), "source", F.lit(")")).alias("head"))
    return d.withColumn("clean", T.strip_source_tag(F.col("head")))


@query(r"""WITH t AS (SELECT conv_id, turn, '<think>' || role || chr(10) || 'x</think>' || chr(10) || '"' || replace(text, '"', '') || '"' AS raw FROM conversations)
SELECT conv_id, turn, trim(trim(split_part(trim(regexp_replace(raw, '(?s)<think>.*?</think>\s*', '', 'g')), chr(10), 1)), '"''') AS line FROM t""")
def think_strip(spark: SparkSession, sf: str) -> DataFrame:
    """A model's answer without its thoughts: the first line, without quotes."""
    raw = F.concat(F.lit("<think>"), "role", F.lit("\nx</think>\n\""), F.replace("text", F.lit('"'), F.lit("")), F.lit('"'))
    return table(spark, sf, "conversations").select("conv_id", "turn", T.first_line(T.strip_think(raw)).alias("line"))


@query("""SELECT s_suppkey, replace(replace(replace(replace(trim(n), ' ', ''), '(주)', ''), '㈜', ''), '주식회사', '') AS short FROM (SELECT s_suppkey, (['(주) ', '주식회사', ' ㈜', '(유)'])[CAST(s_suppkey % 4 AS INTEGER) + 1] || s_name || ' Co' AS n FROM supplier)""")
def name_short(spark: SparkSession, sf: str) -> DataFrame:
    """Names without spaces and the commonest legal forms, case and others kept."""
    forms = F.array(*map(F.lit, ("(주) ", "주식회사", " ㈜", "(유)")))
    return table(spark, sf, "supplier").select("s_suppkey", T.short_name(F.concat(F.element_at(forms, (F.col("s_suppkey") % 4 + 1).cast("int")), "s_name", F.lit(" Co"))).alias("short"))


_TAILS = ["", "으로", "는", "은", "와", "과", "이", "가", "을", "를", "의", "도", "로", "에서"]


@query(f"""WITH t AS (SELECT o_orderkey, (['구조', '음극재', '회로', '것', 'cell'])[CAST(o_orderkey // 14 % 5 AS INTEGER) + 1] || ({_TAILS})[CAST(o_orderkey % 14 AS INTEGER) + 1] AS token FROM orders)
SELECT o_orderkey, token, CASE WHEN regexp_matches(token, '[가-힣]') THEN regexp_replace(token, '^(.{{2,}}?)(으로|는|은|와|과|이|가|을|를|의|도|로)$', '\\1') ELSE token END AS stem FROM t""".replace("\\\\", "\\"))
def clean_tail(spark: SparkSession, sf: str) -> DataFrame:
    """Tokens without the particle at their end, where two syllables stay."""
    k = F.col("o_orderkey")
    word = F.element_at(F.array(*map(F.lit, ("구조", "음극재", "회로", "것", "cell"))), (F.floor(k / 14) % 5 + 1).cast("int"))
    d = table(spark, sf, "orders").select(k, F.concat(word, F.element_at(F.array(*map(F.lit, _TAILS)), (k % 14 + 1).cast("int"))).alias("token"))
    return d.withColumn("stem", T.clean_tail(F.col("token")))


@query("""SELECT c_custkey, '대전에서;이용한;반도체;' || replace(c_mktsegment, ' ', ';') || CASE WHEN c_custkey % 2 = 0 THEN ';5G' ELSE '' END AS viewer, '대전;반도체;' || replace(c_mktsegment, ' ', ';') || CASE WHEN c_custkey % 2 = 0 THEN ';5G' ELSE '' END AS whole FROM customer""")
def noun_profiles(spark: SparkSession, sf: str) -> DataFrame:
    """Free input by both profiles: the viewer's keeps particles and verb forms."""
    text = F.concat(F.lit("대전에서 이용한 반도체 도매업, "), "c_mktsegment", F.when(F.col("c_custkey") % 2 == 0, " / 5G 업체").otherwise(" EH030301"))
    d = table(spark, sf, "customer").select("c_custkey", text.alias("t"))
    return d.select("c_custkey", F.array_join(T.noun_keywords(F.col("t"), "viewer"), ";").alias("viewer"), F.array_join(T.noun_keywords(F.col("t")), ";").alias("whole"))


@query("""WITH y AS (SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS a, CAST(year(o_orderdate) + o_orderkey % 3 AS VARCHAR) AS b FROM orders)
SELECT o_orderkey, CASE CAST(o_orderkey % 4 AS INTEGER) WHEN 3 THEN '' WHEN 2 THEN a ELSE CASE WHEN a = b THEN a ELSE a || ' ~' || chr(10) || b END END AS lines, CASE CAST(o_orderkey % 4 AS INTEGER) WHEN 3 THEN NULL WHEN 2 THEN a || '년' ELSE CASE WHEN a = b THEN a || '년' ELSE a || '년 ~ ' || b || '년' END END AS cell FROM y""")
def year_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Years of descriptions, in one line and in two."""
    k, a = F.col("o_orderkey"), F.year("o_orderdate")
    both = F.concat(F.lit("이 과제는 "), a.cast("string"), F.lit("년 3월 5일에 시작하여 "), (a + k % 3).cast("string"), F.lit("년 12월 31일에 종료된다."))
    text = F.when(k % 4 == 3, "기간 미정").when(k % 4 == 2, F.concat(a.cast("string"), F.lit("년 과제"))).otherwise(both)
    return table(spark, sf, "orders").select(k, T.year_lines(text).alias("lines"), T.period_cell(text).alias("cell"))


@query("""WITH p AS (SELECT o_orderkey, CAST(round(o_totalprice * 1000) AS BIGINT) AS won FROM orders)
SELECT o_orderkey, CASE WHEN won >= 100000000 THEN printf('%.1f', won / 100000000.0::DOUBLE) || '억원' WHEN won >= 10000 THEN format('{:,}', CAST(round_even(won / 10000.0::DOUBLE, 0) AS BIGINT)) || '만원' ELSE format('{:,}', won) || '원' END AS money FROM p""")
def money_cells(spark: SparkSession, sf: str) -> DataFrame:
    won = F.round(F.col("o_totalprice") * 1000).cast("long").cast("string")
    return table(spark, sf, "orders").select("o_orderkey", T.money_cell(won).alias("money"))


@query("""SELECT c_custkey, name FROM (SELECT c_custkey, CASE CAST(c_custkey % 6 AS INTEGER) WHEN 0 THEN 'nan' WHEN 1 THEN 'None' WHEN 2 THEN '  ' WHEN 3 THEN NULL ELSE c_name END AS name FROM customer) WHERE name IS NOT NULL AND trim(name) NOT IN ('', 'nan', 'None')""")
def present_values(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that have a value: not null, blank, or a word for none."""
    k = F.col("c_custkey") % 6
    d = table(spark, sf, "customer").select("c_custkey", F.when(k == 0, "nan").when(k == 1, "None").when(k == 2, "  ").when(k > 3, F.col("c_name")).alias("name"))
    return d.filter(T.is_present(F.col("name")))


@query("""SELECT n_nationkey, c_custkey, CAST(row_number() OVER (PARTITION BY n_nationkey ORDER BY number NULLS LAST, c_custkey) AS INTEGER) AS rank FROM (SELECT c_nationkey AS n_nationkey, c_custkey, CASE WHEN c_custkey % 10 = 9 THEN NULL ELSE c_custkey % 97 END AS number FROM customer)""")
def numeric_order(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers that are text are sorted as numbers, others last."""
    k = F.col("c_custkey")
    text = F.when(k % 10 == 9, "n/a").otherwise(F.concat(F.lit(" "), (k % 97).cast("string")))
    w = Window.partitionBy("n_nationkey").orderBy(T.number_of(F.col("no")).asc_nulls_last(), "c_custkey")
    return table(spark, sf, "customer").select(F.col("c_nationkey").alias("n_nationkey"), k, text.alias("no")).select("n_nationkey", "c_custkey", F.row_number().over(w).alias("rank"))


@query("""SELECT p_partkey, p_name AS project_name, p_brand AS brand FROM part""")
def derived_name(spark: SparkSession, sf: str) -> DataFrame:
    """A name that a table lacks comes from the column that has it; one that it has stays."""
    from ..operators.selection import ensure_column

    p = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("과제명"), F.col("p_brand").alias("brand"))
    return ensure_column(ensure_column(p, "project_name", "과제명"), "brand", "과제명").select("p_partkey", "project_name", "brand")


@query("""SELECT n_nationkey, CASE CAST(n_nationkey % 4 AS INTEGER) WHEN 0 THEN n_name || ',x' ELSE '' END AS strict, CASE CAST(n_nationkey % 4 AS INTEGER) WHEN 0 THEN n_name || ',x' WHEN 1 THEN n_name || '; y;' ELSE '' END AS lenient, CASE WHEN n_nationkey % 4 = 1 THEN n_name || ',y' ELSE '' END AS parts FROM nation""")
def lenient_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Lists that arrive as text: what is none counts as nothing or as one value, and lists by separator."""
    from ..functions import arrays as A

    k, n = F.col("n_nationkey") % 4, F.col("n_name")
    raw = F.when(k == 0, F.concat(F.lit('["'), n, F.lit('", " x ", ""]'))).when(k == 1, F.concat(n, F.lit("; y;"))).when(k == 2, "")
    d = table(spark, sf, "nation").select("n_nationkey", raw.alias("raw"))
    joined = lambda a: F.array_join(a, ",")
    parts = F.when(F.col("n_nationkey") % 4 == 1, joined(A.split_list(F.col("raw")))).otherwise("")
    return d.select("n_nationkey", joined(A.parse_list(F.col("raw"))).alias("strict"), joined(A.parse_list(F.col("raw"), whole_if_bad=True)).alias("lenient"), parts.alias("parts"))
