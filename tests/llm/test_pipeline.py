"""Each stage on its own input, and the pipeline as a whole."""

import re
from collections import Counter

import corpus_pipeline
import pytest


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    docs.coalesce(2).write.parquet(f"{d}/documents.parquet")
    item = docs.filter("doc_id = 20").first().text[:200]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_takes_odd_and_empty_tables(spark, docs, clashing, empty, folder, name, stage):
    assert stage(spark, empty, folder).count() == 0
    out = stage(spark, clashing, folder)
    if name != "sharding":
        assert out.columns == clashing.columns
    else:
        assert set(out.columns) >= set(clashing.columns)
    assert out.count() > 0


def test_run(spark, docs, folder, rows):
    out = corpus_pipeline.run(spark, folder).collect()
    ids = Counter(r.doc_id for r in out)
    text = {i: t for i, t, *_ in rows}
    assert 20 not in ids  # holds the benchmark item
    assert all(re.search(r"[^\W\d_]", text[i] or "") for i in ids)
    assert all(r.text == text[r.doc_id] for r in out) and {"lang", "source", "n_chars", "shard", "slot"} <= set(out[0].asDict())
    assert len({text[i] for i in ids}) == len(ids) and all(n <= 2 for n in ids.values())
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None
