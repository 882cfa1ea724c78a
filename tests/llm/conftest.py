import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside, to clash with.
EXTRA = [
    "size", "row", "node", "score", "entry", "n", "kept", "key", "class", "leaks", "held_out", "_score", "_lang_pred", "lang_pred", "_leaks", "_mix_id", "_mix_n", "_near_doc", "_near_node", "_doc", "id", "h1", "h2",
    "copies", "repeats", "has_word", "doc", "item_id", "distance", "links", "root", "block", "bytes", "docs", "shard", "slot", "piece", "part", "bin", "bucket", "words", "with.dot",
]

WORDS = {
    "en": "the of and to in is that water house green river stone market walking morning".split(),
    "de": "der die und den von zu das wasser haus grün fluß stein markt gehen morgen".split(),
    "fr": "le la les de et des un eau maison verte rivière pierre marché matin été".split(),
}


def prose(rng: random.Random, lang: str, n: int) -> str:
    out = []
    for i in range(n):
        w = rng.choice(WORDS[lang])
        out.append(w if rng.random() < 0.6 else w + rng.choice(WORDS[lang]))
        if i % 17 == 16:
            out[-1] += ".\n"
    return " ".join(out)


@pytest.fixture(scope="session")
def rows():
    """Documents of three languages with copies, near copies, nulls, empty and very long texts, and repeated rows."""
    rng = random.Random(5)
    texts = []
    for i in range(60):
        lang = ("en", "de", "fr")[i % 3]
        texts.append((prose(rng, lang, rng.randint(20, 120)), lang))
    texts += texts[:6]  # exact copies
    for t, lang in texts[6:12]:  # near copies
        w = t.split(" ")
        w[len(w) // 2] = "changed"
        texts.append((" ".join(w), lang))
    long_text = prose(rng, "en", 20_000)
    texts += [(None, "en"), ("", None), ("   \n\t ", "de"), ("12345 678 !!!", "en"), ("one", "en"), (long_text, "en"), ("naïve ▁ 日本語 text\r\n two  spaces ", None)]
    out = [(i, t, lang, ("src0", "src1", "src2", None)[min(3, i % 7 // 2)], len(t or "")) for i, (t, lang) in enumerate(texts)]
    return out + [out[3], out[3], (None, "a row without an id but with words in it that count", "en", "src1", 5)]


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def clashing(docs):
    from pyspark.sql import functions as F

    return docs.withColumns({c: F.lit("x") for c in EXTRA})
