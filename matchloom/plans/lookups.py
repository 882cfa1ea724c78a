"""Look-up queries: names, descriptions, performed projects, regions and patents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions import text as T
from ..functions import vectors as V
from ..functions import words as W
from ..functions.arrays import in_turn
from ..operators import enrichment as E
from ..operators import selection as S
from ..sources.readers import table
from .registry import query

_SUPPLIER_NAME = "CASE CAST(s_suppkey % 4 AS INTEGER) WHEN 0 THEN '(주) ' || s_name WHEN 1 THEN '주식회사' || s_name WHEN 2 THEN upper(s_name) || '㈜' ELSE s_name END"
_NORM = r"lower(regexp_replace(regexp_replace({c}, '\(주\)|\(株\)|㈜|주식회사|\(유\)|유한회사|\(재\)|재단법인|\(사\)|사단법인|농업회사법인|\(농\)', '', 'g'), '\s+', '', 'g'))"


def _named_suppliers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "supplier").select("s_suppkey", "s_nationkey", F.expr(_SUPPLIER_NAME).alias("name"), "s_name")


@query(f"""WITH s AS (SELECT s_suppkey, {_SUPPLIER_NAME} AS name FROM supplier), m AS (SELECT s_name, s_acctbal FROM supplier)
SELECT s.s_suppkey, s.name, m.s_acctbal FROM s LEFT JOIN m ON {_NORM.format(c='s.name')} = {_NORM.format(c='m.s_name')}""")
def name_normalize_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Companies found by their names without legal forms and white space, blind to case."""
    s = _named_suppliers(spark, sf).withColumn("key", T.folded(T.norm_name(F.col("name")))).drop("s_name")
    m = table(spark, sf, "supplier").select(T.folded(T.norm_name(F.col("s_name"))).alias("key"), "s_acctbal")
    return s.join(m, "key", "left").select("s_suppkey", "name", "s_acctbal")


@query(f"""WITH s AS (SELECT s_suppkey, {_SUPPLIER_NAME} AS name, n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey),
d AS (SELECT {_NORM.format(c="n_name || ' ' || left(name, 1)")} AS key, name AS descr, CAST(s_suppkey % 2 AS INTEGER) AS desc_ok, CASE WHEN s_suppkey % 3 = 0 THEN '' ELSE 'issue ' || (s_suppkey % 3) END AS desc_issue, s_suppkey AS pos FROM s),
r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY length(descr) DESC, pos) AS nth FROM d WHERE key <> '')
SELECT key, descr, desc_ok, desc_issue FROM r WHERE nth = 1""")
def best_desc_per_name(spark: SparkSession, sf: str) -> DataFrame:
    """The longest description of each normalised name, the first of equally long ones, with its flag and issue."""
    n = table(spark, sf, "nation")
    s = _named_suppliers(spark, sf).join(n, F.col("s_nationkey") == F.col("n_nationkey"))
    d = s.select(T.norm_name(F.concat("n_name", F.lit(" "), F.left("name", F.lit(1)))).alias("key"), F.col("name").alias("descr"), (F.col("s_suppkey") % 2).cast("int").alias("desc_ok"), F.when(F.col("s_suppkey") % 3 == 0, "nan").otherwise(F.concat(F.lit("issue "), (F.col("s_suppkey") % 3).cast("string"))).alias("desc_issue"), F.col("s_suppkey").alias("pos"))
    best = S.longest_per_key(d.filter("key <> ''"), "key", "descr", "pos", ("desc_ok", "desc_issue"))
    return best.withColumn("desc_issue", T.safe_cell(F.col("desc_issue")))


@query("""SELECT l_orderkey, l_linenumber, coalesce(s_name, '') AS s_name, coalesce(n_name, '') AS n_name FROM lineitem
LEFT JOIN (SELECT s_suppkey, s_name, s_nationkey FROM supplier WHERE s_suppkey % 3 <> 0) s ON s_suppkey = l_suppkey LEFT JOIN nation ON n_nationkey = s_nationkey""")
def enrich_left_join(spark: SparkSession, sf: str) -> DataFrame:
    """Star of look-ups; what is missing is blank. The optimiser broadcasts the small sides by their size."""
    s = table(spark, sf, "supplier").filter("s_suppkey % 3 <> 0").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", F.col("s_nationkey").alias("n_nationkey"))
    n = table(spark, sf, "nation").select("n_nationkey", "n_name")
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return li.join(s, "l_suppkey", "left").join(n, "n_nationkey", "left").select("l_orderkey", "l_linenumber", F.coalesce("s_name", F.lit("")).alias("s_name"), F.coalesce("n_name", F.lit("")).alias("n_name"))


@query("""WITH c AS (SELECT CASE WHEN o_custkey % 2 = 0 THEN o_custkey || '.0' ELSE ' ' || o_custkey END AS id, o_orderkey FROM orders)
SELECT o_orderkey, regexp_replace(trim(id), '^(\\d+)\\.0$', '\\1') AS id, coalesce(c_name, '') AS c_name FROM c LEFT JOIN customer ON CAST(c_custkey AS VARCHAR) = regexp_replace(trim(id), '^(\\d+)\\.0$', '\\1')""".replace("\\\\", "\\"))
def id_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Ids that a numeric column has left as `123.0` find their rows."""
    o = table(spark, sf, "orders")
    ids = F.when(F.col("o_custkey") % 2 == 0, F.concat(F.col("o_custkey").cast("string"), F.lit(".0"))).otherwise(F.concat(F.lit(" "), F.col("o_custkey").cast("string")))
    d = o.select("o_orderkey", ids.alias("c_custkey"))
    found = E.look_up(d, table(spark, sf, "customer"), "c_custkey", ["c_name"])
    return found.select("o_orderkey", T.norm_id(F.col("c_custkey")).alias("id"), "c_name")


_TOK = "list_distinct(regexp_extract_all({c}, '([가-힣a-zA-Z0-9]{{2,}})'))"


@query(f"""WITH i AS (SELECT DISTINCT l_suppkey, p_partkey, p_name FROM lineitem JOIN part ON p_partkey = l_partkey),
r AS (SELECT l_suppkey, min_by(p_name, p_partkey) AS ref FROM i GROUP BY 1),
s AS (SELECT l_suppkey, p_partkey, len(list_intersect({_TOK.format(c='p_name')}, {_TOK.format(c='ref')})) AS shared FROM i JOIN r USING (l_suppkey)),
k AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY shared DESC, p_partkey) AS rank FROM s)
SELECT l_suppkey, p_partkey, CAST(shared AS INTEGER) AS shared, CAST(rank AS INTEGER) AS rank FROM k WHERE rank <= 15""")
def conduct_project_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """A company's performed projects by shared words with its reference, 15 at most."""
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    i = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey").distinct().join(part, "l_partkey").withColumnRenamed("l_partkey", "p_partkey")
    ref = i.groupBy("l_suppkey").agg(F.min_by("p_name", "p_partkey").alias("ref"))
    return E.overlap_rank(i, ref, "l_suppkey", "p_name", "ref", "p_partkey").select("l_suppkey", "p_partkey", "shared", "rank")


@query("""WITH c AS (SELECT c_custkey, n_name AS region, r_name AS grp FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey),
s AS (SELECT s_suppkey, s_name, n_name AS region, r_name AS grp FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey),
o AS (SELECT DISTINCT o_custkey AS c_custkey, l_suppkey AS s_suppkey FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
j AS (SELECT c_custkey, CASE WHEN c.region = s.region THEN 'same' WHEN c.region <> 'BRAZIL' AND s.region <> 'BRAZIL' AND c.grp = s.grp THEN 'similar' ELSE 'none' END AS rel FROM o JOIN c USING (c_custkey) JOIN s USING (s_suppkey))
SELECT c_custkey, count(*) FILTER (rel = 'same') AS n_same, count(*) FILTER (rel = 'similar') AS n_similar, count(*) AS n, bool_or(rel = 'same') AS has_same FROM j GROUP BY 1""")
def region_relation(spark: SparkSession, sf: str) -> DataFrame:
    """How many of a customer's suppliers sit in the same region, or in another one of its group."""
    where = table(spark, sf, "nation").join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.col("n_name").alias("region"), F.col("r_name").alias("grp"))
    c = table(spark, sf, "customer").join(where, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", F.col("region").alias("own"), F.col("grp").alias("own_group"))
    s = table(spark, sf, "supplier").join(where, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), "region", "grp")
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey")).join(table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey"), "l_orderkey").select("c_custkey", "l_suppkey").distinct()
    rel = E.region_relation(F.col("own"), F.col("region"), F.col("own_group"), F.col("grp"), alone="BRAZIL")
    j = o.join(c, "c_custkey").join(s, "l_suppkey").withColumn("rel", rel)
    return j.groupBy("c_custkey").agg(F.count_if(F.col("rel") == "same").alias("n_same"), F.count_if(F.col("rel") == "similar").alias("n_similar"), F.count(F.lit(1)).alias("n"), F.bool_or(F.col("rel") == "same").alias("has_same"))


_REGIONS = ["서울", "경기", "인천", "충남", "대전", "세종", "전북", "광주", "경북", "울산", "부산", "강원", "제주", ""]


@query(f"""WITH g(region, grp) AS (VALUES ('서울', 1), ('경기', 1), ('인천', 1), ('충남', 2), ('대전', 2), ('세종', 2), ('전북', 3), ('광주', 3), ('경북', 4), ('부산', 4)),
s AS (SELECT s_suppkey, ({_REGIONS})[CAST(s_suppkey % 14 AS INTEGER) + 1] AS own, ({_REGIONS})[CAST(s_nationkey * 3 % 14 AS INTEGER) + 1] AS other FROM supplier)
SELECT s_suppkey, own, other, CASE WHEN own = '' OR other = '' THEN NULL WHEN own = other THEN 'same' WHEN a.grp = b.grp THEN 'similar' ELSE 'none' END AS relation FROM s LEFT JOIN g a ON a.region = own LEFT JOIN g b ON b.region = other""")
def region_relation_ko(spark: SparkSession, sf: str) -> DataFrame:
    """Regions of suppliers against another one: the same, of one group of regions, or none."""
    own, other = in_turn(F.col("s_suppkey"), _REGIONS), in_turn(F.col("s_nationkey") * 3, _REGIONS)
    d = table(spark, sf, "supplier").select("s_suppkey", own.alias("own"), other.alias("other"))
    return d.withColumn("relation", E.region_relation(F.col("own"), F.col("other"), E.region_group(F.col("own")), E.region_group(F.col("other"))))


_PATENTS_SQL = """
p AS (SELECT o_custkey AS project, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'A' || (o_orderkey // 4) END AS app_no, CASE WHEN o_orderstatus = 'F' THEN 'R' || o_orderkey ELSE '' END AS reg_no,
  CASE WHEN o_orderstatus = 'F' THEN 'registered' WHEN o_orderstatus = 'O' THEN 'applied' ELSE 'other' END AS status, o_orderpriority AS name, CASE WHEN o_orderkey % 2 = 0 THEN 'kr' ELSE 'XI' END AS country,
  'inst' || (o_orderkey % 9) AS institution, strftime(o_orderdate, '%Y%m%d') AS app_date, strftime(o_orderdate, '%Y%m00') AS reg_date, o_orderkey AS pos FROM orders),
k AS (SELECT *, coalesce('a' || nullif(trim(app_no), ''), 'r' || nullif(trim(reg_no), ''), 'p' || pos) AS patent FROM p),
b AS (SELECT *, row_number() OVER (PARTITION BY project, patent ORDER BY CASE status WHEN 'registered' THEN 0 WHEN 'applied' THEN 1 ELSE 2 END, pos) AS nb,
  row_number() OVER (PARTITION BY project, patent ORDER BY CASE status WHEN 'applied' THEN 0 ELSE 1 END, pos) AS na, bool_or(status = 'registered') OVER (PARTITION BY project, patent) AS reg, bool_or(status = 'applied') OVER (PARTITION BY project, patent) AS app FROM k),
m AS (SELECT x.project, x.patent, CASE WHEN x.reg THEN 'registered' ELSE 'applied' END AS status, x.name, x.country, x.app_no, CASE WHEN x.app THEN y.institution ELSE x.institution END AS institution,
  CASE WHEN x.app THEN y.app_date ELSE x.app_date END AS app_date, CASE WHEN x.reg THEN x.reg_no END AS reg_no, CASE WHEN x.reg THEN x.reg_date END AS reg_date, x.pos
  FROM (SELECT * FROM b WHERE nb = 1) x JOIN (SELECT * FROM b WHERE na = 1) y ON x.project = y.project AND x.patent = y.patent)"""


def _patents(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    key, status = F.col("o_orderkey"), F.col("o_orderstatus")
    rows = o.select(
        F.col("o_custkey").alias("project"),
        F.when(key % 5 == 0, "").otherwise(F.concat(F.lit("A"), F.expr("cast(o_orderkey div 4 as string)"))).alias("app_no"),
        F.when(status == "F", F.concat(F.lit("R"), key.cast("string"))).otherwise("").alias("reg_no"),
        F.when(status == "F", "registered").when(status == "O", "applied").otherwise("other").alias("status"),
        F.col("o_orderpriority").alias("name"),
        F.when(key % 2 == 0, "kr").otherwise("XI").alias("country"),
        F.concat(F.lit("inst"), (key % 9).cast("string")).alias("institution"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("app_date"),
        F.concat(F.date_format("o_orderdate", "yyyyMM"), F.lit("00")).alias("reg_date"),
        key.alias("pos"),
    )
    return E.merge_patents(rows)


@query(f"WITH {_PATENTS_SQL} SELECT * FROM m")
def patent_merge(spark: SparkSession, sf: str) -> DataFrame:
    return _patents(spark, sf)


@query(f"""WITH {_PATENTS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY project ORDER BY CASE status WHEN 'registered' THEN 0 ELSE 1 END, coalesce(TRY_CAST(replace(reg_date, '.', '') AS INTEGER), 0) DESC, coalesce(TRY_CAST(replace(app_date, '.', '') AS INTEGER), 0) DESC, pos) AS rank FROM m)
SELECT project, patent, CAST(rank AS INTEGER) AS rank FROM r""")
def patent_sort(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import Window

    return _patents(spark, sf).select("project", "patent", F.row_number().over(Window.partitionBy("project").orderBy(*E.patent_order())).alias("rank"))


@query("""SELECT max_by(project, n * 10000000 - project) AS project, max(n) AS n FROM (SELECT o_custkey AS project, count(*) AS n FROM orders GROUP BY 1)""")
def most_patents(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("project")).agg(F.count(F.lit(1)).alias("n"))
    return n.agg(F.max_by("project", F.struct("n", -F.col("project"))).alias("project"), F.max("n").alias("n"))


@query("""SELECT n_name, code, CASE upper(code) WHEN 'KR' THEN '한국' WHEN 'US' THEN '미국' WHEN 'CN' THEN '중국' WHEN 'JP' THEN '일본' WHEN 'EP' THEN '유럽' WHEN 'XU' THEN '유럽' WHEN 'XI' THEN 'PCT' WHEN 'WO' THEN 'PCT' ELSE code END AS country
FROM (SELECT n_name, (['KR', 'us', 'CN', 'jp', 'EP', 'XU', 'XI', 'WO', 'DE'])[n_nationkey % 9 + 1] AS code FROM nation)""")
def country_map(spark: SparkSession, sf: str) -> DataFrame:
    codes = F.array(*map(F.lit, (*list(W.COUNTRIES)[:1], "us", "CN", "jp", "EP", "XU", "XI", "WO", "DE")))
    n = table(spark, sf, "nation").select("n_name", F.element_at(codes, F.col("n_nationkey") % 9 + 1).alias("code"))
    return n.withColumn("country", T.country_name(F.col("code")))


@query("""WITH i AS (SELECT l_suppkey, list(DISTINCT p_name ORDER BY p_name) AS names FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1)
SELECT l_suppkey, CASE WHEN len(names) < 10 THEN array_to_string(names, ';') ELSE array_to_string(names[1:15], ';') END AS patents, len(names) AS n FROM i""")
def patent_shortlist(spark: SparkSession, sf: str) -> DataFrame:
    """Few names: all; many without a reference vector: the first of them."""
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    i = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey").distinct().join(part, "l_partkey")
    names = i.groupBy("l_suppkey").agg(F.sort_array(F.collect_set("p_name")).alias("names"))
    return names.select("l_suppkey", F.array_join(F.when(F.size("names") < 10, F.col("names")).otherwise(A.cap(F.col("names"), 15)), ";").alias("patents"), F.size("names").cast("long").alias("n"))


@query("""WITH z AS (SELECT n_nationkey, string_split(n_name, ' ') AS ids, string_split(n_name || ' x', ' ') AS names FROM nation),
s AS (SELECT n_nationkey, unnest(generate_series(1, least(len(ids), len(names)))) AS i, ids, names FROM z)
SELECT n_nationkey, CAST(i AS INTEGER) AS pos, ids[i] AS id, names[i] AS name FROM s""")
def zip_names(spark: SparkSession, sf: str) -> DataFrame:
    """Two parallel lists, as long as both go."""
    z = table(spark, sf, "nation").select("n_nationkey", F.split("n_name", " ").alias("ids"), F.split(F.concat("n_name", F.lit(" x")), " ").alias("names"))
    pairs = z.select("n_nationkey", F.posexplode(A.zip_shorter(F.col("ids"), F.col("names"))))
    return pairs.select("n_nationkey", (F.col("pos") + 1).alias("pos"), F.col("col")["0"].alias("id"), F.col("col")["1"].alias("name"))


@query("""WITH v AS (SELECT vec_id // 8 AS text_id, list_transform(embedding, lambda x: x::DOUBLE) AS e, vec_id % 3 <> 0 AS used FROM embeddings),
d AS (SELECT text_id, generate_subscripts(e, 1) AS i, unnest(e) AS x FROM v WHERE used), a AS (SELECT text_id, i, avg(x) AS x FROM d GROUP BY 1, 2),
n AS (SELECT text_id, sqrt(sum(x * x)) AS l FROM a GROUP BY 1), p AS (SELECT text_id, round(sum(x / l), 5) AS total, round(max(x / l), 5) AS most FROM a JOIN n USING (text_id) GROUP BY 1)
SELECT text_id, coalesce(total, 0) AS total, coalesce(most, 0) AS most FROM (SELECT DISTINCT text_id FROM v) LEFT JOIN p USING (text_id)""")
def mean_pooling(spark: SparkSession, sf: str) -> DataFrame:
    """Texts of eight token vectors at most, with a mask: the mean of those it leaves, scaled to length 1 (0 if it leaves none)."""
    tokens = table(spark, sf, "embeddings").groupBy(F.floor(F.col("vec_id") / 8).alias("text_id")).agg(F.sort_array(F.collect_list(F.struct("vec_id", "embedding", (F.col("vec_id") % 3 != 0).cast("int").alias("used")))).alias("t"))
    part = lambda field: F.transform("t", lambda x: x[field])
    pooled = tokens.select("text_id", V.mean_pool(F.transform(part("embedding"), lambda v: v.cast("array<double>")), part("used")).alias("v"))
    return pooled.select("text_id", F.round(F.aggregate("v", F.lit(0.0), lambda a, x: a + x), 5).alias("total"), F.round(F.array_max("v"), 5).alias("most"))
