"""Block products, global order, counted arrays and case-blind keys, against plain Python."""

import random
from collections import Counter

import numpy as np
from matchloom.functions import text as T
from matchloom.functions.arrays import counted, in_turn
from matchloom.operators import dense
from matchloom.operators import retrieval as R
from matchloom.operators import selection as S
from matchloom.operators.ranges import largest, number_rows
from pyspark.sql import functions as F


def vectors(n, seed, size=8):
    rng = random.Random(seed)
    rows = [(i, [float(rng.randint(-2, 2)) for _ in range(size)], rng.choice(["a", "b", None])) for i in range(n)]
    rows += [(n + i, [1.0] * size, "a") for i in range(40)]  # many equal vectors: ties
    return rows + [(n + 100, [0.0] * size, "b"), (n + 101, None, "a")]


def plain_cosines(rows):
    unit = {i: np.array(v) / (np.linalg.norm(v) or 1) for i, v, _ in rows if v is not None}
    return {(a, b): round(float(np.floor(abs(x) * 1e6 + 0.5) / 1e6 * np.sign(x)), 6) + 0.0 for a in unit for b in unit if a != b for x in [np.clip(unit[a] @ unit[b], -1, 1)]}


def test_nearest_by_blocks_are_those_of_all_pairs(spark, monkeypatch):
    rows = vectors(300, 3)
    cos = plain_cosines(rows)
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label string").repartition(5)
    asked = v.filter("vec_id % 40 = 0 OR vec_id >= 399")
    ids = [i for i, x, _ in rows if x is not None and (i % 40 == 0 or i >= 399)]
    want = {(q, d, s, r) for q in ids for r, (s, d) in enumerate(sorted(((s, b) for (a, b), s in cos.items() if a == q), key=lambda e: (-e[0], e[1]))[:7], 1)}
    for cells, values in ((dense.CELLS, dense.QUERY_VALUES), (50, 24)):
        monkeypatch.setattr(dense, "CELLS", cells)
        monkeypatch.setattr(dense, "QUERY_VALUES", values)
        assert {tuple(r) for r in R.cosine_top_k(v, asked, 7).select("query", "doc", "score", "rank").collect()} == want
        pairs = {tuple(r) for r in dense.similar_pairs(v, asked, 0.5, "label").collect()}
        label = {i: x for i, _, x in rows}
        assert pairs == {(a, b, s) for (a, b), s in cos.items() if a in ids and s >= 0.5 and label[a] is not None and label[a] == label[b]}
    assert R.cosine_top_k(v, asked.limit(0), 3).count() == 0 and R.cosine_top_k(v.limit(0), asked, 3).count() == 0


def test_largest_of_many_with_ties_at_the_cut(spark):
    rng = random.Random(4)
    rows = [(f"t{i:04}", rng.choice([1, 2, 2, 2, 3, 900, 10**12, rng.randint(1, 50)])) for i in range(2000)]
    d = spark.createDataFrame(rows, "term string, cf long").repartition(6)
    in_order = sorted(rows, key=lambda r: (-r[1], r[0]))
    for n in (0, 1, 250, 700, 1200, 1999, 2000, 5000):
        got = largest(d, n, "cf", "term")
        assert {tuple(r) for r in got.collect()} == set(in_order[:n])
        assert "TakeOrdered" not in got._jdf.queryExecution().toString()
    numbered = number_rows(d, F.desc("cf"), F.col("term")).collect()
    assert [(r.term, r.cf) for r in sorted(numbered, key=lambda r: r.nth)] == in_order and {r.nth for r in numbered} == set(range(1, 2001))
    assert number_rows(d.limit(0), F.col("term")).count() == 0


def test_counted_arrays(spark):
    rows = [(["b", "a", "b", "b"],), ([],), (None,), (["x"],)]
    got = spark.createDataFrame(rows, "a array<string>").select(counted(F.col("a")).alias("c")).collect()
    assert [Counter({x.term: x.n for x in r.c}) for r in got] == [Counter({"b": 3, "a": 1}), Counter(), Counter(), Counter({"x": 1})]
    assert [r[0] for r in spark.range(-1, 4).select(in_turn(F.col("id"), ["p", "q", "r"])).collect()] == ["r", "p", "q", "r", "p"]


def test_keys_that_are_blind_to_case(spark):
    """The collation decides: ß is ss and ligatures are their letters, accents tell words apart."""
    words = ["Straße", "STRASSE", "strasse", "Strase", "été", "ÉTÉ", "ete", "ﬁn", "FIN"]
    d = spark.createDataFrame([(w, i) for i, w in enumerate(words)], "w string, i int")
    assert {(r.word, r.n, r.n_spellings) for r in S.spellings(d, "w").collect()} == {("strasse", 3, 3), ("strase", 1, 1), ("été", 2, 2), ("ete", 1, 1), ("fin", 2, 2)}
    a, b = d.select(T.folded(F.col("w")).alias("k"), "i"), spark.createDataFrame([("STRAßE",)], "x string").select(T.folded(F.col("x")).alias("k"))
    assert sorted(r.i for r in a.join(b, "k").collect()) == [0, 1, 2]
    assert [r.i for r in S.title_dedup_top_n(d.filter("i < 3").withColumn("key", F.lit(1)), "key", "w", 5, F.col("i")).collect()] == [0]


# Tables that queries were once tried on: phrases and what becomes of them.
def column_of(spark, function, values):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "v string").select(function(F.col("v"))).collect()]


def test_cells_of_fixed_phrases(spark):
    money = {"250000000": "2.5억원", "25000": "2만원", "900": "900원", "35000.0": "4만원", "123456789012": "1234.6억원", "": "-", "미정": "미정", "99990000": "9,999만원", "1250000": "125만원"}
    assert column_of(spark, T.money_cell, money) == [*money.values()]
    spaced = {"좋은 결과입니다.이 과제는": "좋은 결과입니다. 이 과제는", "3.2억원": "3.2억원", "H.264": "H.264", "β-1,3": "β-1,3", "성장률 5%.다음": "성장률 5%. 다음", "끝.": "끝.", "(참고).그리고": "(참고). 그리고"}
    assert column_of(spark, T.fix_spacing, spaced) == [*spaced.values()]
    absent = {"우수한 과제이다. 관련 정보가 없다. 실적이 많다.": "우수한 과제이다. 실적이 많다.", "해당 내용은 생략합니다.": "해당 내용은 생략합니다.", "특허가 3건 있다.": "특허가 3건 있다."}
    assert column_of(spark, T.scrub_absence, absent) == [*absent.values()]
    codes = {"030301": True, "2024": True, "EH030301": True, "RS232": True, "5G": False, "3D": False, "MP3": False, "H264": False, "AI": False, "RFID": False, "가1234": False, "abc": False, "12a": False}
    assert column_of(spark, T.is_meaningless_code, codes) == [*codes.values()]
