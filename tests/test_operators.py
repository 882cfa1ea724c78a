"""Operators, readers, writers and streams on small tables."""

import random
import threading
import time
from collections import Counter

import pandas as pd
import pytest
from matchloom.functions import structs as X
from matchloom.functions import text as T
from matchloom.functions import vectors as V
from matchloom.functions import words as W
from matchloom.operators import enrichment as E
from matchloom.operators import llm_output as L
from matchloom.operators import models as M
from matchloom.operators import payloads as P
from matchloom.operators import retrieval as R
from matchloom.operators import selection as S
from matchloom.sources import readers, writers
from matchloom.sources.keyed_store import KeyedStore
from matchloom.streaming.resume import dedup_within_watermark, process_once
from pyspark.sql import functions as F

# Invented demands and projects: each demand has one project that fits it.
PROJECTS = [
    ("P1", "반도체 패키지 열해석", "반도체 패키지 방열 구조 열해석 시뮬레이션"),
    ("P2", "수소 연료전지 촉매", "연료전지 백금 촉매 내구성 향상 수소 저장"),
    ("P3", "스마트팜 생육 예측", "온실 생육 영상 인공지능 예측 스마트팜 센서"),
    ("P4", "의료 영상 진단", "의료 영상 인공지능 진단 병변 검출"),
    ("P5", "반도체 패키지 열해석 ", "같은 제목을 가진 다른 과제 반도체"),
]
DEMANDS = [("D1", "패키지 방열 열해석 반도체"), ("D2", "수소 연료전지 촉매 내구성"), ("D3", "온실 스마트팜 센서 생육 예측"), ("D4", "영상 병변 검출 의료 진단")]


@pytest.fixture(scope="module")
def projects(spark):
    return spark.createDataFrame(PROJECTS, "pid string, title string, descr string")


@pytest.fixture(scope="module")
def demands(spark):
    return spark.createDataFrame(DEMANDS, "no string, body string")


def test_each_demand_finds_its_project(projects, demands):
    texts = projects.withColumn("doc_text", F.concat_ws(" ", "title", "descr"))
    index = R.build_index(texts, "pid", "doc_text", least_df=1)
    lexical = R.bm25_scores(demands, index, "no", "body")
    pool = R.union_candidates(R.top_k(lexical, "query", 3, F.desc("score"), F.col("doc")), R.tfidf_cosine(demands, R.build_index(texts, "pid", "doc_text"), "no", "body"))
    pairs = pool.join(demands.withColumnRenamed("no", "query"), "query").join(texts.withColumnRenamed("pid", "doc"), "doc")
    ranked = R.rerank(pairs, 5, R.rerank_tokens(F.col("body"), R.QUERY_CHARS), R.rerank_tokens(F.col("doc_text"), R.DOCUMENT_CHARS)).withColumn("score", R.dice_score(T.noun_keywords(F.col("body")), T.noun_keywords(F.col("doc_text"))))
    best = S.title_dedup_top_n(ranked, "query", "title", 5, F.desc("score"), F.desc("rerank"), F.col("pos")).collect()
    assert {r["query"]: r.doc for r in best if r["rank"] == 1} == {"D1": "P1", "D2": "P2", "D3": "P3", "D4": "P4"}
    for q in {r["query"] for r in best}:
        rows = sorted((r for r in best if r["query"] == q), key=lambda r: r["rank"])
        titles = [r.title.strip() for r in rows]
        assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1)) and len(titles) == len(set(titles))
        assert all(0 <= r.score <= 100 for r in rows) and [r.score for r in rows] == sorted((r.score for r in rows), reverse=True)


def test_filtered_corpus_has_its_own_statistics(projects, demands):
    texts = projects.withColumn("t", F.concat_ws(" ", "title", "descr"))
    scores = lambda docs: R.bm25_scores(demands, R.build_index(docs, "pid", "t", least_df=1), "no", "body").collect()
    some, every = scores(texts.filter("pid in ('P1', 'P5')")), {(r["query"], r.doc): r.score for r in scores(texts)}
    assert some and all(r.score != every[r["query"], r.doc] for r in some)


def test_similar_items_need_half_and_one_of_each_key(spark):
    rows = [(1, i, [1.0, x], k) for i, (x, k) in enumerate([(0.0, "a"), (0.1, "a"), (0.2, "b"), (0.3, "c"), (0.4, "d"), (9.0, "e")])]
    d = spark.createDataFrame(rows, "key int, item int, v array<float>, k string").withColumn("ref", F.array(F.lit(1.0), F.lit(0.0)))
    assert [r.item for r in E.similar_items(d, "key", V.cosine(F.col("ref"), F.col("v")), "k").orderBy("rank").collect()] == [0, 2, 3]


def test_patents_merge(spark):
    rows = [
        ("p", "A1", "", "applied", "n1", "KR", "inst", "20200101", "", 1), ("p", "A1", "R1", "registered", "n2", "US", "other", "20190101", "20210101", 2),
        ("p", "", "R9", "other", "n3", "KR", "x", "", "", 3), ("p", "", "", "other", "n4", "KR", "x", "", "", 4), ("p", "", "", "other", "n5", "KR", "x", "", "", 5),
    ]
    d = spark.createDataFrame(rows, "project string, app_no string, reg_no string, status string, name string, country string, institution string, app_date string, reg_date string, pos int")
    got = {r.pos: r for r in E.merge_patents(d).collect()}
    assert set(got) == {2, 3, 4, 5}
    assert (got[2].status, got[2].name, got[2].institution, got[2].app_date, got[2].reg_no) == ("registered", "n2", "inst", "20200101", "R1")
    assert got[4].status == "applied" and got[4].reg_no is None


def test_repair_keeps_what_is_refused(spark):
    d = spark.createDataFrame([("bad one",), ("bad",), ("fine",)], "t string")
    got = L.repair(d, "t", F.col("t").startswith("bad"), lambda c: F.trim(F.replace(c, F.lit("bad"), F.lit(""))), lambda c: F.length(c) > 0).collect()
    assert {(r.t, r.repaired) for r in got} == {("one", True), ("bad", False), ("fine", False)}


def test_sheets_of_several_files_have_their_own_title_rows(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"s{i}.csv").write_text(f"Title {i},,\nof it,,\nno,\"name, full\",\n" + "".join(f"{i}{k},n{k},x\n" for k in range(4)), encoding="utf-8")
    d = readers.sheet(spark, str(tmp_path), header_row=2)
    assert d.columns == ["no", "name, full", "column_2"]
    assert sorted(r.no for r in d.collect()) == sorted(f"{i}{k}" for i in range(3) for k in range(4))


def test_one_csv_for_a_spreadsheet(spark, tmp_path):
    path = f"{tmp_path}/out.csv"
    first = spark.createDataFrame([(i, f"가 {i}") for i in range(20)], "no int, `name, full` string").repartition(3)
    writers.single_csv(first, path)
    writers.single_csv(first.limit(5), path)
    lines = open(path, encoding="utf-8").read().split("\n")
    assert lines[0] == '\ufeffno,"name, full"' and len(lines) == 27 and lines[-1] == "" and not any("name" in x for x in lines[1:])
    assert readers.partition_path("/a/", field="IT", no="3") == "/a/field=IT/no=3"


def test_replacing_keeps_what_was_there(spark, tmp_path):
    path = f"{tmp_path}/result"
    assert writers.replace_with_backup(spark.range(1), path) is None and not readers.exists(spark, path)
    assert writers.replace_with_backup(spark.range(1), path, write=True) is None
    first = writers.replace_with_backup(spark.read.parquet(path).selectExpr("id + 5 AS id"), path, write=True)
    second = writers.replace_with_backup(spark.range(3), path, write=True)
    assert [spark.read.parquet(p).count() for p in (path, first, second)] == [3, 1, 1] and first != second
    assert spark.read.parquet(second).first().id == 5


def test_literals_with_apostrophes(spark):
    texts = ["""{'name': "it's", 'n': None, 'ok': True}""", """{'name': 'say "hi" None', 'n': 1}""", '{"name": "json", "n": 2}', "neither", r"""{'name': 'it\'s'}"""]
    d = spark.createDataFrame([(t,) for t in texts], "t string").select(X.parse_struct(F.col("t"), "name string, n int, ok boolean").alias("r"))
    assert [r.r and tuple(r.r) for r in d.collect()] == [("it's", None, True), ('say "hi" None', 1, None), ("json", 2, None), None, ("it's", None, None)]


def test_models_that_fail_lose_one_answer(spark):
    def load():
        def answer(prompts):
            if "bad" in prompts:
                raise ValueError("no answer")
            return [p.upper() for p in prompts]

        return answer

    d = spark.createDataFrame([("a",), ("bad",), ("c",), (None,)], "p string").coalesce(1)
    asked = M.ask(d, F.col("p"), load).cache()
    assert [(r.answer, r.answer_error) for r in asked.collect()] == [("A", None), (None, "ValueError: no answer"), ("C", None), ("", None)]
    assert [tuple(r) for r in M.failures(asked).collect()] == [("ValueError", 1)]
    assert M.backend(None, load) is load and M.backend("", load) is load
    with pytest.raises(ValueError, match="no back end 'unknown'"):
        M.backend("unknown", load)
    M.BACKENDS["x"] = other = lambda: None
    assert M.backend("x", load) is other
    del M.BACKENDS["x"]


def test_calls_are_under_way_together_in_order_and_with_an_end():
    started, ended, most = [], [], []
    lock = threading.Lock()

    def call(i, seconds):
        with lock:
            started.append(i)
            most.append(len(started) - len(ended))
        time.sleep(seconds)
        with lock:
            ended.append(i)
        if i == 3:
            raise KeyError("three")
        return i * 10

    began = time.monotonic()
    got = list(M.in_flight([(i, 0.2 if i % 2 else 0.05) for i in range(8)], call, most=4))
    assert got == [(i * 10, None) if i != 3 else (None, "KeyError: 'three'") for i in range(8)]
    assert max(most) == 4 and time.monotonic() - began < 0.8 and started != ended
    slow = list(M.in_flight([(9, 0.01), (8, 3.0), (7, 0.01)], call, most=3, time_out=0.3))
    assert slow == [(90, None), (None, "TimeoutError"), (70, None)] and time.monotonic() - began < 3


def test_a_model_is_asked_once_for_each_row_that_needs_it(spark):
    """Each round asks for what the rounds before it left broken, and the text that was tested is the text kept."""
    calls = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def model(round_):
        @F.pandas_udf("string")
        def answer(texts: pd.Series) -> pd.Series:
            calls[round_].add(len(texts))
            return pd.Series([f"{t.replace('!!', '') if round_ or t.startswith('a') else t} {random.random()}" for t in texts])

        return answer

    rows = [(f"a{i}!!" if i % 3 == 0 else f"b{i}!!" if i % 3 == 1 else f"c{i}", i) for i in range(90)]
    d = spark.createDataFrame(rows, "t string, attempts int").repartition(3)
    got = L.repair_ladder(d, "t", lambda c: F.contains(c, F.lit("!!")), [model(0), model(1)])
    first, again = ({(r.attempts, r.t): r.attempt for r in got.collect()} for _ in range(2))
    assert first == again and Counter(first.values()) == {0: 30, 1: 30, 2: 30}
    assert (calls[0].value, calls[1].value) == (60, 30)


def test_attempts_go_up_until_one_holds(spark):
    d = spark.createDataFrame([("[a] polite!! and long enough",), ("fine",), ("x!!",)], "t string")
    ladder = [lambda c: F.lit("short"), lambda c: F.replace(c, F.lit("!!"), F.lit("")), lambda c: F.lit("never reached")]
    got = L.repair_ladder(d, "t", lambda c: F.contains(c, F.lit("!!")), ladder).collect()
    assert {(r.t, r.attempt) for r in got} == {("[a] polite and long enough", 2), ("fine", 0), ("short", 1)}


def test_messages_with_examples(spark):
    m = spark.range(1).select(M.few_shot(F.lit("sys"), [("q", "a")], F.lit("now")).alias("m")).first().m
    assert [(x.role, x.content) for x in m] == [("system", "sys"), ("user", "q"), ("assistant", "a"), ("user", "now")]
    assert spark.range(1).select(P.direction("project").alias("a"), P.direction("other").alias("b")).first() == ("project", "company")
    assert "IT" in M.guide("IT", "project")


# Invented texts of four kinds: each has one of another kind that fits it.
KINDS = {
    "company": {1: "반도체 패키지 방열 소재 제조 기업", 2: "수소 연료전지 촉매 생산 기업", 3: "스마트팜 온실 센서 기업", 4: "의료 영상 진단 소프트웨어 기업", 5: "교량 구조 안전 점검 기업"},
    "project": {1: "반도체 패키지 방열 구조 열해석 연구", 2: "연료전지 촉매 내구성 수소 연구", 3: "온실 스마트팜 생육 센서 예측 연구", 4: "의료 영상 병변 진단 인공지능 연구", 5: "교량 안전 점검 드론 연구"},
    "patent": {1: "상기 특징 반도체 방열 패키지 장치", 2: "상기 연료전지 촉매 제조 방법 특징", 3: "온실 센서 제어 장치", 4: "의료 영상 진단 장치", 5: "교량 점검 로봇"},
    "demand": {1: "반도체 방열 열해석", 2: "온실 센서 예측"},
}
KEYWORD_REQUESTS = [("company", 1), ("company", 4), ("patent", 1), ("patent", 2), ("project", 2), ("project", 4), ("demand", 1), ("demand", 2)]
MATCH_REQUESTS = [("company", 1, "project", 1), ("company", 3, "project", 3), ("project", 3, "company", 3), ("project", 4, "company", 4), ("company", 2, "patent", 2), ("company", 1, "patent", 1), ("demand", 1, "project", 1), ("demand", 2, "project", 3)]


def test_requests_of_all_directions(spark):
    """Sixteen requests: keywords of each kind of text, and matches in each direction, with what must hold of the answers."""
    asked = spark.createDataFrame([(i, kind, KINDS[kind][n]) for i, (kind, n) in enumerate(KEYWORD_REQUESTS)], "no int, kind string, text string")
    rule = T.noun_keywords(F.col("text"))
    empty = lambda: lambda prompts: ['{"keywords": []}'] * len(prompts)
    for r in M.extract_keywords(asked, "text", rule, empty, boilerplate=W.BOILERPLATE).collect():
        low = [k.lower() for k in r.keywords]
        assert 0 < len(low) <= 20 and len(set(low)) == len(low)
        assert r.kind != "patent" or not {"상기", "특징"} & set(low)
        assert r.kind != "demand" or len(low) >= 3
    pairs = [(i, KINDS[a][n], pos, t) for i, (a, n, b, _) in enumerate(MATCH_REQUESTS) for pos, t in KINDS[b].items()]
    scored = M.score_in_blocks(spark.createDataFrame(pairs, "no int, source string, pos int, text string"), "no", "pos", "source", "text").collect()
    for i, (*_, best) in enumerate(MATCH_REQUESTS):
        mine = sorted((r for r in scored if r.no == i), key=lambda r: -r.score)
        assert len(mine) == 5 and mine[0].pos == best and all(0 <= r.score <= 100 for r in mine)
    cut = spark.createDataFrame([('{"results": [{"id": 1, "score": 88, "reason": "ok"}, {"id": 2, "sco',)], "a string")
    assert [tuple(r) for r in cut.select(F.inline(L.parse_scores(F.col("a")))).collect()] == [(1, 88, "ok")]


def test_sheet_with_title_rows(spark, tmp_path):
    p = tmp_path / "demand.csv"
    p.write_text("Title,,\nof the sheet,,\nno,name,\n1,가,x\n2,나,y\n", encoding="utf-8")
    d = readers.sheet(spark, str(p), header_row=2)
    assert d.columns == ["no", "name", "column_2"] and sorted(map(tuple, d.collect())) == [("1", "가", "x"), ("2", "나", "y")]
    assert readers.sheet(spark, str(p)).count() == 4


def test_keyed_json_and_fallbacks(spark, tmp_path):
    p = tmp_path / "best.json"
    p.write_text('{"3": {"name": "a", "top": [1, 2]}, "4": {"name": "b"}}', encoding="utf-8")
    assert sorted((r.no, r.name, r.top) for r in readers.keyed_json(spark, str(p), "name string, top array<int>", "no").collect()) == [("3", "a", [1, 2]), ("4", "b", None)]
    columns = {"id": "string", "org": "string"}
    assert readers.slim_or_wide(spark, f"{tmp_path}/slim", f"{tmp_path}/wide", columns).count() == 0
    spark.createDataFrame([(1, "o", "more")], "id int, org string, rest string").write.parquet(f"{tmp_path}/wide")
    assert [tuple(r) for r in readers.slim_or_wide(spark, f"{tmp_path}/slim", f"{tmp_path}/wide", columns).collect()] == [("1", "o")]
    for name in ("가_result", "전체_result"):
        spark.range(2).write.parquet(f"{tmp_path}/parts/{name}.parquet")
    got = readers.named_parts(spark, f"{tmp_path}/parts/*.parquet", r"/([^/]+)_result\.parquet", "who", exclude="전체")
    assert {(r.id, r.who) for r in got.collect()} == {(0, "가"), (1, "가")}


def test_writers(spark, tmp_path):
    items = spark.createDataFrame([(1, "a/b"), (2, "A B"), (3, "a/b"), (4, "")], "id int, name string")
    names = {r.name: r.sheet for r in writers.write_by_sheet(items, "name", "id", f"{tmp_path}/sheets").collect()}
    assert names == {"a/b": "a b", "A B": "A B_1", "": "무명"}
    assert spark.read.parquet(f"{tmp_path}/sheets").groupBy("sheet").count().filter("sheet = 'a b'").first()["count"] == 2
    for _ in range(2):
        kept = writers.append_missing(items, ["id"], f"{tmp_path}/memo")
    assert kept.count() == 4
    assert not writers.write_new(items, f"{tmp_path}/new") and not readers.exists(spark, f"{tmp_path}/new")
    assert writers.write_new(items, f"{tmp_path}/new", write=True)
    with pytest.raises(Exception, match="already exists"):
        writers.write_new(items, f"{tmp_path}/new", write=True)
    writers.append_csv(items, f"{tmp_path}/csv")
    writers.append_csv(items, f"{tmp_path}/csv")
    assert readers.sheet(spark, f"{tmp_path}/csv").count() == 8


def test_stream_does_each_key_once(spark, tmp_path):
    schema, source = "k int, ts timestamp, v int", f"{tmp_path}/in"
    run = lambda: process_once(spark.readStream.schema(schema).parquet(source), ["k"], ["ts", "v"], f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    first = spark.sql("select * from values (1, timestamp'2024-01-01 00:00:00', 1), (1, timestamp'2024-01-01 00:00:00', 0), (2, timestamp'2024-01-02 00:00:00', 5) t(k, ts, v)")
    first.write.mode("append").parquet(source)
    run()
    first.union(spark.sql("select 3, timestamp'2024-01-03 00:00:00', 7")).write.mode("append").parquet(source)
    run()
    assert sorted((r.k, r.v) for r in KeyedStore(spark, f"{tmp_path}/out", ["k"]).read().collect()) == [(1, 0), (2, 5), (3, 7)]
    assert dedup_within_watermark(spark.readStream.schema(schema).parquet(source), ["k"], "ts", "1 day").isStreaming


def test_sources_in_order(spark):
    keys = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    a, b = spark.createDataFrame([(1, "a")], "k int, v string"), spark.createDataFrame([(1, "b"), (2, "b")], "k int, v string")
    assert {tuple(r) for r in S.resolve_sources(keys, [("a", a), ("b", b)], "k", "v").collect()} == {(1, "a", "a"), (2, "b", "b"), (3, None, "miss")}


def test_model_boundary(spark, tmp_path):
    d = spark.createDataFrame([("q", "온도 센서 개발", i, t) for i, t in enumerate(["온도 센서", "무관한 글", "fail"], 1)], "query string, source string, pos int, body string")
    got = {r.pos: (r.score, r.reason) for r in M.score_in_blocks(d, "query", "pos", "source", "body").collect()}
    assert got[1] == (100, "핵심 기술 부합: 온도, 센서") and got[2] == (0, "직접 관련 근거 약함")

    def model(source, texts):
        if "fail" in texts:
            raise ValueError("no answer")
        return [(7, "ok")] * len(texts)

    asked = M.score_in_blocks(d, "query", "pos", "source", "body", model, size=2)
    assert {r.pos: (r.score, r.reason, r.error) for r in asked.collect()} == {1: (7, "ok", None), 2: (7, "ok", None), 3: (None, None, "ValueError: no answer")}
    filled = L.with_default_answer(d.select("pos"), asked.filter("score is not null").select("pos", "score", "reason"), ["pos"])
    assert {r.pos: r.reason for r in filled.collect()}[3] == L.NO_ANSWER
    vectors = M.encode(d, "body").select("embedding").collect()
    assert all(abs(sum(x * x for x in v[0]) - 1) < 1e-5 for v in vectors)
    assert M.object_schema(["a"])["required"] == ["a"]


def test_names_and_specifications(spark, tmp_path):
    d = spark.createDataFrame([(1, "(주)가나"), (2, "가 나"), (3, "다")], "pos int, name string")
    assert [r.pos for r in S.select_by_name(d, "name", "주식회사 가나", "pos", 5).collect()] == [1, 2]
    with pytest.raises(ValueError, match="no rows"):
        S.select_by_name(d, "name", "라", "pos", 5)
    p = tmp_path / "spec.md"
    p.write_text("# One\n```\nx\n```\n## Words\ntext\n```text\na, b,\nb, c\n```\n", encoding="utf-8")
    assert readers.word_set(readers.fenced_block(spark, str(p), "## Words")) == ["a", "b", "c"]
    with pytest.raises(ValueError, match="no header"):
        readers.fenced_block(spark, str(p), "## None")
