"""Column functions on values that show their rules."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from matchloom.functions import arrays as A
from matchloom.functions import text as T
from matchloom.functions import vectors as V
from matchloom.functions import words as W
from matchloom.operators import llm_output as L
from pyspark.sql import functions as F


def values(spark, f, inputs, kind="string"):
    d = spark.createDataFrame(list(enumerate(inputs)), f"n int, v {kind}")
    return [r.out for r in d.select("n", f(F.col("v")).alias("out")).orderBy("n").collect()]


def test_noun_keywords(spark):
    cases = {
        "반도체도매업": ["반도체"], "정밀화학공업": ["정밀화학"], "생명공학에": ["생명공학"], "원료의약품의": ["원료의약품"], "이용한 활용하여 개발하는": [], "030301 2024 EH030301 RS232": [],
        "5G 3D 4K MP3 H264 AI IoT RFID": "5G 3D 4K MP3 H264 AI IoT RFID".split(), "나노-입자, 촉매!": ["나노", "입자", "촉매"], "": [], "제조업": [],
    }
    assert values(spark, T.noun_keywords, list(cases)) == list(cases.values())
    assert values(spark, lambda c: T.noun_keywords(c, "viewer"), ["생명공학에 위한 반도체도매업"]) == [["생명공학에", "위한", "반도체"]]
    assert values(spark, T.noun_keywords, [None]) == [[]]


def nouns_by_steps(text):
    """The rules as a plain loop, for comparison."""
    import re

    out = []
    for w in re.sub(r"[^\w가-힣]", " ", text).split():
        if len(w) < 2 or w.lower() in W.STOP_WORDS or w.lower() in W.CONNECTIVES:
            continue
        if not re.search("[가-힣]", w) and (w.isdecimal() or (re.fullmatch("[A-Za-z0-9]{5,}", w) and re.search("[A-Za-z]", w) and re.search("[0-9]", w))):
            continue
        for s in W.TRADE_SUFFIXES:
            if w.endswith(s) and len(w) > len(s):
                w = w.removesuffix(s)
                break
        for p in W.PARTICLES:
            if w.endswith(p) and len(w) - len(p) >= 2:
                w = w.removesuffix(p)
                break
        if any(w.endswith(e) and w.removesuffix(e) in W.STOP_WORDS for e in W.VERB_ENDINGS) or len(w) < 2 or w in W.STOP_WORDS or w in W.CONNECTIVES:
            continue
        out.append(w)
    return out


PARTS = [*W.STOP_WORDS[:12], *W.TRADE_SUFFIXES, *W.PARTICLES, *W.VERB_ENDINGS, "반도체", "정밀", "나노", "AI", "5G", "EH0303", "2024", " ", " ", " ", ",", "-", "(", "_", "é"]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.sampled_from(PARTS), max_size=12).map("".join), min_size=20, max_size=60))
def test_noun_keywords_follow_the_steps(spark, inputs):
    assert values(spark, T.noun_keywords, inputs) == [nouns_by_steps(x) for x in inputs]


@pytest.mark.parametrize(
    "f, pairs",
    [
        (T.norm_id, {"123.0": "123", " 45 ": "45", "1.5": "1.5", None: "", "a.0": "a.0"}),
        (T.norm_name, {"(주) 가나 다": "가나다", "주식회사ABC": "abc", "DEF㈜": "def", None: ""}),
        (T.date_cell, {"20240500": "2024.05", "20240000": "2024", "20240517": "2024.05.17", "n/a": "n/a", "2024-05-17": "2024.05.17", None: ""}),
        (T.money_cell, {"250000000": "2.5억원", "25000": "2만원", "900": "900원", "": "-", None: "-", "미정": "미정", "900.0": "900원"}),
        (T.country_name, {"XI": "PCT", "XU": "유럽", "kr": "한국", "DE": "DE", None: ""}),
        (T.yes_no, {"yes": "Y", "1": "Y", "t": "Y", "no": "N", "0": "N", "?": "", "nan": "", None: ""}),
        (T.ratio_bucket, {"1": 1, "20": 20, "7": None, "x": None, None: None}),
        (T.fix_spacing, {"합니다.이": "합니다. 이", "3.2억원": "3.2억원", "H.264": "H.264", "β-1,3": "β-1,3", None: ""}),
        (T.squeeze, {" a b\tc ": "abc", None: ""}),
        (T.dash, {"": "-", " ": "-", None: "-", "x": "x"}),
        (T.strip_think, {"<think>a\nb</think>\n c": "c", "c": "c"}),
        (T.first_line, {'"one"\ntwo': "one", "  x ": "x"}),
        (T.html_escape, {"<a & b>\n": "&lt;a &amp; b&gt;<br/>", None: ""}),
        (T.tokens, {"AB c 가나-12 é": ["ab", "가나", "12"], None: []}),
        (A.split_list, {"a; b;;c ": ["a", "b", "c"], "": []}),
        (A.parse_list, {'["a", " b ", ""]': ["a", "b"], "bad": [], None: [], "": []}),
        (L.parse_keywords, {'{"keywords": ["AI", " ai ", "x"]}': ["AI", "x"], "none": []}),
    ],
)
def test_scalars(spark, f, pairs):
    assert values(spark, f, list(pairs)) == list(pairs.values())


def test_scores_of_cut_and_odd_answers(spark):
    answers = ['{"results": [{"id": 1, "score": 88, "reason": "ok"}, {"id": 2, "sco', '{"results": [{"id": 1, "score": 2.5, "reason": "a"}, {"id": "x", "score": 1}, {"id": 2, "score": 300}]}', "", None]
    got = values(spark, L.parse_scores, answers)
    assert [[tuple(x) for x in g] if g is not None else None for g in got] == [[(1, 88, "ok")], [(1, 2, "a"), (2, 100, "")], [], None]


def test_arrays_and_vectors(spark):
    assert values(spark, A.distinct_nocase, [["A", "b", "a", "B", "c"], []], "array<string>") == [["A", "b", "c"], []]
    d = spark.createDataFrame([([3.0, 4.0], [3.0, 4.0]), ([0.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [-1.0, 0.0])], "a array<float>, b array<float>")
    assert [r[0] for r in d.select(V.cosine(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, -1.0]
    pooled = spark.createDataFrame([([[1.0, 0.0], [0.0, 1.0], [9.0, 9.0]], [1, 1, 0])], "v array<array<double>>, m array<int>").select(V.mean_pool(F.col("v"), F.col("m"))).first()[0]
    assert pooled == pytest.approx([0.5**0.5, 0.5**0.5])
