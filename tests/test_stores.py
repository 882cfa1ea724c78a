"""Stores that grow: keyed rows, a lexical index, state of streams, and checks counted while writing."""

import glob
import math
import os
import random
import re
from collections import Counter, defaultdict

import pytest
from matchloom.operators import retrieval as R
from matchloom.operators.kept_index import BLOCK, KeptIndex
from matchloom.sources import writers
from matchloom.sources.keyed_store import KeyedStore
from matchloom.sources.manifest import Manifest
from matchloom.streaming.state import first_wins
from pyspark.sql import functions as F


def rows_of(store):
    return sorted(((r.k, r.v, r.at) for r in store.read().collect()), key=str)


def batch(spark, *rows):
    return spark.createDataFrame(rows, "k long, v string, at long")


def test_upserts_replace_rows_of_their_keys(spark, tmp_path):
    store = KeyedStore(spark, f"{tmp_path}/s", ["k"], 8)
    with pytest.raises(ValueError, match="nothing is kept"):
        store.read()
    store.upsert(batch(spark, (1, "a", 1), (2, "b", 1), (1, "c", 3), (1, "d", 2), (None, "n", 1)), F.col("at"))
    assert rows_of(store) == sorted([(1, "c", 3), (2, "b", 1), (None, "n", 1)], key=str)
    store.upsert(batch(spark, (2, "e", 0), (3, "f", 9), (None, "m", 2)), F.col("at"))
    assert rows_of(KeyedStore(spark, f"{tmp_path}/s", ["k"])) == sorted([(1, "c", 3), (2, "e", 0), (3, "f", 9), (None, "m", 2)], key=str)
    with pytest.raises(ValueError, match="kept by"):
        KeyedStore(spark, f"{tmp_path}/s", ["v"])
    assert store.vacuum() and rows_of(store)[0] == (1, "c", 3)


def test_a_batch_reads_and_writes_its_buckets_alone(spark, tmp_path, monkeypatch):
    store = KeyedStore(spark, f"{tmp_path}/s", ["k"], 16)
    store.upsert(spark.range(500).selectExpr("id AS k", "'old' AS v", "id AS at"))
    read = []
    monkeypatch.setattr(KeyedStore, "_rows", lambda self, state, buckets=None, real=KeyedStore._rows: read.append(buckets) or real(self, state, buckets))
    before = store.manifest.latest()[1]["folders"]
    store.upsert(batch(spark, (7, "new", 1)))
    store.insert_missing(batch(spark, (7, "not", 1), (1000, "added", 1)))
    after = store.manifest.latest()[1]["folders"]
    bucket = spark.range(1).selectExpr("cast(pmod(xxhash64(7L), 16) AS int)", "cast(pmod(xxhash64(1000L), 16) AS int)").first()
    assert read[0] == [bucket[0]] and set(read[1]) == set(bucket)
    assert {b for b in after if after[b] != before[b]} == {str(b) for b in bucket}
    monkeypatch.undo()
    got = {r.k: r.v for r in store.read().collect()}
    assert len(got) == 501 and got[7] == "new" and got[1000] == "added" and got[8] == "old"
    store.compact()
    assert all(len(f) == 1 for f in store.manifest.latest()[1]["folders"].values()) and {r.k: r.v for r in store.read().collect()} == got


def test_a_crash_before_the_commit_leaves_the_old_state(spark, tmp_path, monkeypatch):
    store = KeyedStore(spark, f"{tmp_path}/s", ["k"], 4)
    store.upsert(batch(spark, (1, "a", 1)))

    def crash(self, number, content):
        raise OSError("gone")

    monkeypatch.setattr(Manifest, "commit", crash)
    with pytest.raises(OSError):
        store.upsert(batch(spark, (1, "b", 2), (2, "b", 2)))
    monkeypatch.undo()
    assert rows_of(store) == [(1, "a", 1)] and len(glob.glob(f"{tmp_path}/s/data/*")) == 2
    assert len(store.vacuum()) == 1 and rows_of(store) == [(1, "a", 1)]
    number, state = store.manifest.latest()
    store.manifest.commit(number + 1, state)
    with pytest.raises(RuntimeError, match="already taken"):
        store.manifest.commit(number + 1, state)


# --- the kept index


def texts(n, seed):
    rng = random.Random(seed)
    topics = [[f"{t}{i}" for i in range(30)] for t in ("red", "green", "blue", "white")]
    return [(i, " ".join(rng.choice(topics[i * 4 // n]) if rng.random() < 0.9 else rng.choice(["common", "words", f"once{i}"]) for _ in range(rng.randint(3, 40)))) for i in range(n)] + [(n, None), (n + 1, "")]


def bm25(docs, queries, k, least_df=2, most=10**9):
    tokens = {i: re.findall("[a-z0-9]{2,}", (t or "").lower()) for i, t in docs}
    df, cf = Counter(t for w in tokens.values() for t in set(w)), Counter(t for w in tokens.values() for t in w)
    kept = set(sorted((t for t in df if df[t] >= least_df), key=lambda t: (-cf[t], t))[:most])
    length = {i: sum(t in kept for t in w) for i, w in tokens.items()}
    average = sum(length.values()) / len(docs) or 1.0
    out = {}
    for q, text in queries:
        scores = defaultdict(float)
        for t in set(re.findall("[a-z0-9]{2,}", text.lower())) & kept:
            idf = math.log(1 + (len(docs) - df[t] + 0.5) / (df[t] + 0.5))
            for i, w in tokens.items():
                if tf := w.count(t):
                    scores[i] += idf * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * length[i] / average))
        out[q] = [(i, round(s, 6)) for i, s in sorted(scores.items(), key=lambda e: (-round(e[1], 9), e[0]))[:k]]
    return out


@pytest.mark.parametrize("most", [10**9, 60])
def test_a_kept_index_equals_one_of_all_documents(spark, tmp_path, most):
    docs, queries = texts(1500, 7), [(1, "red1 red2 red3 red4"), (2, "blue5 blue6 words"), (3, "nothing here"), (4, "white1 once3 once900 green7")]
    asked = spark.createDataFrame(queries, "q int, t string")
    path = f"{tmp_path}/index"
    KeptIndex(spark, path, most_terms=most).append(spark.createDataFrame(docs[:900], "i long, t string").repartition(1), "i", "t")
    for upto, more in ((900, docs[900:]), (len(docs), None)):
        index = KeptIndex(spark, path, most_terms=most)
        best, looked = index.search(asked, "q", "t", 5)
        got = defaultdict(list)
        for r in sorted(best.collect(), key=lambda r: (r["query"], r["rank"])):
            got[r["query"]].append((r.doc, round(r.score, 6)))
        assert dict(got) == {q: v for q, v in bm25(docs[:upto], queries, 5, most=most).items() if v}
        counts = {r["query"]: (r.n_blocks, r.n_scored) for r in looked.collect()}
        assert all(n_scored <= n for n, n_scored in counts.values())
        if more:
            index.append(spark.createDataFrame(more, "i long, t string").repartition(1), "i", "t")
    if most > 60:  # documents of one topic lie together, and blocks of others are not looked into
        assert counts[1][0] > 1 and counts[2][1] < counts[2][0] and len(docs) / BLOCK > 40
    assert len(index.segments()) == 2 and {f.split("/")[-1] for f in glob.glob(f"{path}/data/*")} == {s["name"] for s in index.segments()}


def test_an_index_of_all_documents_is_the_same_as_by_hand(spark):
    docs, queries = texts(300, 8), [(1, "red1 red2 common"), (2, "blue5 blue6 words once7")]
    for most in (10**9, 40):
        index = R.build_index(spark.createDataFrame(docs, "i long, t string"), "i", "t", most_terms=most)
        got = defaultdict(list)
        for r in R.top_k(R.bm25_scores(spark.createDataFrame(queries, "q int, t string"), index, "q", "t"), "query", 5, F.desc(F.round("score", 9)), F.col("doc")).collect():
            got[r["query"]].append((r["rank"], r.doc, round(r.score, 6)))
        assert {q: [x[1:] for x in sorted(v)] for q, v in got.items()} == bm25(docs, queries, 5, most=most)


# --- streams and ledgers


def test_first_rows_by_a_state_store_across_restarts(spark, tmp_path):
    schema = "k int, t int, v string"

    def run(*rows, expire_ms=None, name="a"):
        if rows:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}-in")
        out = first_wins(spark.readStream.schema(schema).parquet(f"{tmp_path}/{name}-in"), ["k"], ["t", "v"], schema, expire_ms)
        # Timers of processing time ask for batches without end, so such a stream is given one at a time.
        trigger = {"availableNow": True} if expire_ms is None else {"once": True}
        running = out.writeStream.outputMode("append").format("parquet").option("checkpointLocation", f"{tmp_path}/{name}-check").trigger(**trigger).start(f"{tmp_path}/{name}-out")
        assert running.awaitTermination(60) or running.stop()
        return sorted(tuple(r) for r in spark.read.schema(schema).parquet(f"{tmp_path}/{name}-out").collect())

    assert run((1, 2, "b"), (1, 1, "a"), (2, 5, "x")) == [(1, 1, "a"), (2, 5, "x")]
    assert run((1, 0, "late"), (3, 9, "z"), (2, 5, "x")) == [(1, 1, "a"), (2, 5, "x"), (3, 9, "z")]
    assert run((1, 1, "a"), expire_ms=1, name="b") == [(1, 1, "a")]
    run((2, 1, "b"), expire_ms=1, name="b")  # by now the first key's time is over, and a batch has told its timer
    assert run((1, 7, "again"), expire_ms=1, name="b") == [(1, 1, "a"), (1, 7, "again"), (2, 1, "b")]


def test_checks_are_counted_in_the_pass_that_writes(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def looked(v):
        seen.add(1)
        return v

    d = spark.range(100).repartition(4).withColumn("v", looked("id"))
    got = writers.write_checked(d, f"{tmp_path}/out", {"small": F.col("v") < 90, "even": F.col("v") % 2 == 0, "all": F.col("v") >= 0, "null": F.lit(None).cast("boolean")})
    assert {(r["check"], r.n_bad, r.passed) for r in got.collect()} == {("small", 10, False), ("even", 50, False), ("all", 0, True), ("null", 100, False)}
    assert seen.value == 100 and spark.read.parquet(f"{tmp_path}/out").count() == 100
    assert os.path.isdir(f"{tmp_path}/out")
