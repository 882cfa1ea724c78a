"""Resampling, alignment and merge rounds against brute force and against the tokenizers' own libraries."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from matchloom.llm import alignment, importance, queries, sentence_pieces

MODEL, OTHER = "/opt/tokenizers/piece_bpe_32k.model", "/opt/tokenizers/byte_bpe_50k.json"
ODD = [None, "", " ", "▁", "▁ x", "  two  spaces ", "a" * 70, " " * 33 + "x", "<s>a</s><0x41><|endoftext|>", "日本語のテキスト 😀 x", "it's 1,234.5% don't 'll", "a\nb\n\n  c\t d\r\n", "wide　x\x85y \x00 z", "été naïve ÷ ×2", "'s 's's"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    letters = "abcdefgthe in  ▁éèü日😀\n\t.,129'\"<s></s>　"
    return ODD + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(3000)]


# --- 13: sentencepiece


@pytest.fixture(scope="module")
def library():
    sentencepiece = pytest.importorskip("sentencepiece")
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_rounds_are_the_library(library, texts):
    model = sentence_pieces.load_pieces(MODEL)
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, 32000)]
    rng = random.Random(12)
    many = texts + ["".join(rng.choice(pieces[: rng.choice([300, 3000, 31000])]).strip(rng.choice(["", " "])) for _ in range(30)) for _ in range(3000)] + [" " * n for n in range(70)]
    got = model.encode_column(pa.array(many))
    want = [library.encode(t or "") for t in many]
    assert got.to_pylist() == want
    assert model.decode_column(got).to_pylist() == [library.decode(x) for x in want]


def test_any_ids_are_decoded_as_the_library_does(library):
    rng = random.Random(13)
    lists = [[rng.choice([0, 1, 2, 259, rng.randint(3, 258), rng.randint(3, 258), rng.randint(0, 31999)]) for _ in range(rng.randint(0, 9))] for _ in range(3000)]
    column = pa.array([[5], *lists], pa.list_(pa.int32())).slice(1)
    assert sentence_pieces.load_pieces(MODEL).decode_column(column).to_pylist() == [library.decode(x) for x in lists]
    with pytest.raises(ValueError):
        sentence_pieces.load_pieces(MODEL).decode_column(pa.array([[32000]], pa.list_(pa.int32())))


def test_merges_that_make_better_pairs_wait_their_turn():
    """Scores where joining a and b makes the best pair of all: taken at once, as one pair at a time would."""
    rng = random.Random(14)
    for _ in range(300):
        pieces = list({"".join(rng.choice("abc") for _ in range(rng.randint(2, 5))) for _ in range(rng.randint(2, 14))})
        rng.shuffle(pieces)
        rank = {p: i for i, p in enumerate(pieces)}
        ids = {c: i for i, c in enumerate("abc")} | {p: 3 + i for i, p in enumerate(pieces)}
        table = sentence_pieces.Merges({(ids[p[:k]], ids[p[k:]]): (rank[p], ids[p]) for p in pieces for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids}, len(ids) + 1) if pieces else None
        if not len(table.keys) > 1:
            continue
        words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 14))) for _ in range(12)]
        symbols = np.array([ids[c] for w in words for c in w], np.int32)
        of = np.repeat(np.arange(len(words)), [len(w) for w in words])
        alive = table.merge(symbols, of)
        names = {i: p for p, i in ids.items()}
        for i, w in enumerate(words):
            parts = list(w)
            while True:
                pairs = [(rank[x + y], k) for k, (x, y) in enumerate(zip(parts, parts[1:], strict=False)) if x + y in rank]
                if not pairs:
                    break
                k = min(pairs)[1]
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
            assert [names[s] for s in symbols[alive & (of == i)]] == parts


def test_pieces_of_documents(spark, docs, clashing, empty, rows, library):
    d = clashing.withColumn("ids", F.lit("old"))
    out = sentence_pieces.decode_pieces(sentence_pieces.encode_pieces(d, MODEL), MODEL)
    assert set(out.columns) == {*d.columns, "decoded"}
    got = Counter((r.doc_id, r.text, tuple(r.ids), r.decoded) for r in out.collect())
    assert got == Counter((i, t, tuple(library.encode(t or "")), library.decode(library.encode(t or ""))) for i, t, *_ in rows)
    assert sentence_pieces.encode_pieces(empty, MODEL).count() == 0
    assert sentence_pieces.decode_pieces(spark.createDataFrame([(None,)], "ids array<int>"), MODEL).first().decoded == ""


def test_a_long_word_is_one_word(library):
    text = "".join(random.Random(15).choice("abcdefgh") for _ in range(30_000))
    assert sentence_pieces.load_pieces(MODEL).encode_column(pa.array([text, " " * 100_000])).to_pylist() == [library.encode(text), library.encode(" " * 100_000)]


def test_unfit_files_are_refused(tmp_path):
    with pytest.raises(ValueError):
        alignment.load(str(tmp_path / "x.tiktoken"))
    with pytest.raises(ValueError, match="cannot be encoded"):
        alignment.ByteLevel("/opt/tokenizers/word_bpe_49k.json")


# --- 12: alignment


def both(library, text):
    """Token bytes of both libraries, or none."""
    tokenizer = alignment.load(OTHER).tokenizer
    e = tokenizer.encode(" " + text, add_special_tokens=False)
    inverse = alignment.byte_of_char()
    a = [(i, bytes(inverse[c] for c in t)) for i, t in zip(e.ids, e.tokens, strict=True)]
    b = [(i, bytes([int(p[3:5], 16)]) if library.is_byte(i) else p.replace("▁", " ").encode()) for i, p in ((i, library.id_to_piece(i)) for i in library.encode(text))]
    whole = (" " + text).encode()
    return (a, b) if text and b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def plainly_aligned(a, b):
    spans = lambda side: [(i, end - len(t), end) for (i, t), end in zip(side, np.cumsum([len(t) for _, t in side]).tolist(), strict=True)]
    a, b = spans(a), spans(b)
    common = sorted({e for _, _, e in a} & {e for _, _, e in b})
    groups, last = [], 0
    for cut in common:
        groups.append(",".join(str(i) for i, s, e in a if last <= s and e <= cut) + "|" + ",".join(str(i) for i, s, e in b if last <= s and e <= cut))
        last = cut
    return groups, [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]


def test_byte_level_units_are_the_library(texts):
    one = alignment.load(OTHER)
    many = [t or "" for t in texts]
    ids, upto, good = alignment.tokens_of(one, pa.array(many, pa.large_string()))
    want = [e.ids for e in one.tokenizer.encode_batch([" " + t if t else "" for t in many], add_special_tokens=False)]
    assert [ids[i:j].tolist() for i, j in zip(upto, upto[1:], strict=False)] == want
    assert [bool(g) for g in good] == ["▁" not in t for t in many]


def test_alignment(spark, docs, clashing, empty, rows, texts, library, monkeypatch):
    short = [(i, t) for i, t in enumerate(texts[:400])] + [(i, t) for i, t, *_ in rows if len(t or "") < 2000]
    d = spark.createDataFrame(short, "doc_id long, text string").repartition(3).withColumns({c: F.lit("x") for c in ("row", "a_ids", "groups", "links", "pack", "codes", "n", "pair")})
    links, plain = Counter(), []
    for i, t in short:
        a, b = both(library, t or "")
        groups, pairs = plainly_aligned(a, b)
        links.update(pairs)
        plain.append((i, t, [x for x, _ in a], [x for x, _ in b], groups, pairs))
    most = Counter()
    for (_, j), n in links.items():
        most[j] = max(most[j], n)
    got = Counter((r.row.doc_id, tuple(r.a_ids), tuple(r.b_ids), tuple(r.groups), tuple(sorted((x >> 32, x & 0xFFFFFFFF) for x in r.links))) for r in alignment.align(d, OTHER, MODEL).collect())
    assert got == Counter((i, tuple(a), tuple(b), tuple(g), tuple(sorted(p))) for i, _, a, b, g, p in plain)
    want = Counter((i, len(a), len(b), len(g), len(p), sum(links[x] == most[x[1]] for x in p), sum(links[x] for x in p), sha(";".join(g)) if g else "") for i, _, a, b, g, p in plain)
    assert Counter(map(tuple, alignment.align_documents(d, OTHER, MODEL).collect())) == want
    monkeypatch.setattr(alignment, "HOT_PAIR", 1 / 300)  # most pairs are joined
    assert Counter(map(tuple, alignment.align_documents(d, OTHER, MODEL).collect())) == want
    assert alignment.align_documents(empty, OTHER, MODEL).count() == 0
    none = alignment.align_documents(docs.filter("text IS NULL OR text = ''"), OTHER, MODEL).collect()
    assert none and all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "") for r in none)


def test_a_unit_of_many_parts_is_aligned_once(spark, monkeypatch):
    keep, written = alignment.materialize, []

    def counted(df, name):
        out = keep(df, name)
        if "links" in out.columns:
            written.append(out.agg(F.sum(F.size("links"))).first()[0])
        return out

    monkeypatch.setattr(alignment, "materialize", counted)
    monkeypatch.setattr(alignment, "MOST_UNITS", 5, raising=False)  # most units are asked for by packs
    texts = spark.range(0, 8, 1, 8).select(F.col("id").alias("doc_id"), F.lit("the river, the stone and thermodynamics: été 1,234 of the morning " * 20).alias("text"))
    one, *none = alignment.align_documents(texts.filter("doc_id = 0"), OTHER, MODEL).collect()
    got = sorted(map(tuple, alignment.align_documents(texts, OTHER, MODEL).collect()))
    assert not none and one.n_links
    assert got == [(i, one.n_a, one.n_b, one.n_groups, one.n_links, one.n_best, 8 * one.count_sum, one.groups_sha256) for i in range(8)]
    assert written[0] == written[1]


# --- 11: resampling


def test_suffix_runs_are_all_n_grams():
    rng = random.Random(16)
    for _ in range(100):
        rows = [[rng.randint(0, 3) for _ in range(rng.randint(0, 12))] for _ in range(rng.randint(0, 6))]
        bounds = np.append(0, np.cumsum([len(r) for r in rows])).astype(np.int64)
        ids = np.array([x for r in rows for x in r], np.int64)
        depth = rng.randint(1, 5)
        found, upto = importance.bucket_features([b"a", b"b", b"c", b"d"], ids, bounds, depth, 97)
        for i, r in enumerate(rows):
            want = [zlib.crc32(" ".join("abcd"[w] for w in r[k : k + n]).encode()) % 97 for n in range(1, depth + 1) for k in range(len(r) - n + 1)]
            assert found[upto[i] : upto[i + 1]].tolist() == want
        left = np.repeat(bounds[1:], np.diff(bounds)) - np.arange(len(ids))
        for n, at, first in importance.runs(ids, left, depth):  # each n-gram is one run
            grams = [tuple(ids[at[i] : at[i] + n]) for i in first]
            assert len(grams) == len(set(grams)) and len(at) == int((left >= n).sum())


def drawn(rows, target, depth, buckets, least, percent):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

    def grams(t):
        w = pattern.findall((t or "").translate(lower))
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, depth + 1) for i in range(len(w) - n + 1)]

    docs = [(i, *grams(t)) for i, t in rows]
    s, t = Counter(b for *_, g in docs for b in g), Counter(b for x in target for b in grams(x)[1])
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets))))
    scored = []
    for i, n, g in docs:
        weight = sum(map(gain, g)) // len(g) if g else 0
        h = int(sha(f"2024:{'null' if i is None else i}")[:8], 16)
        scored.append((i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((x for x in scored if x[4] >= least), key=lambda x: (-x[3], x[0] is None, x[0] or 0))
    chosen = [(*x[:4], k + 1 if k < len(able) * percent // 100 else None) for k, x in enumerate(able)]
    return Counter(chosen + [(*x[:4], None) for x in scored if x[4] < least])


@pytest.mark.parametrize(("depth", "buckets", "least", "percent"), [(1, 10_000, 20, 10), (3, 500, 1, 50)])
def test_resampling(spark, docs, clashing, empty, rows, depth, buckets, least, percent):
    target = [t for _, t, *_ in rows[:9]] + [None, ""]
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    want = drawn([(i, t) for i, t, *_ in rows], target, depth, buckets, least, percent)
    for d in (docs, clashing):
        assert Counter(map(tuple, importance.resample(d, aim, depth, buckets, least, percent).collect())) == want
    assert importance.resample(empty, aim).count() == 0
    nothing = Counter(map(tuple, importance.resample(docs, aim.limit(0), depth, buckets, least, percent).collect()))
    assert nothing == drawn([(i, t) for i, t, *_ in rows], [], depth, buckets, least, percent)


def test_ranks_of_many_equal_rows(spark):
    many = spark.range(3000).selectExpr("7L AS doc_id", "repeat('same words ', 15) AS text").unionByName(spark.range(3000).selectExpr("id AS doc_id", "concat(repeat('other text ', 15), id) AS text"))
    got = importance.resample(many, many.limit(1)).collect()
    ranks = sorted(r.rank for r in got if r.rank is not None)
    assert ranks == list(range(1, 601))
    in_turn = sorted((r for r in got if r.rank is not None), key=lambda r: r.rank)
    assert [(-r.score, r.doc_id) for r in in_turn] == sorted((-r.score, r.doc_id) for r in in_turn)


def test_queries_digest_what_the_operators_give(spark, library):
    folder = "/root/testdata/sf0.001"
    pytest.importorskip("os").path.isdir(folder) or pytest.skip("no tables")
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    want = Counter((i, len(x), sha(",".join(map(str, x))), sha(library.decode(x))) for i, t in texts for x in [library.encode(t or "")])
    assert Counter(map(tuple, queries.op13_piece_rounds(spark, folder).collect())) == want
    got = {r.doc_id: (r.n_a, r.n_b, r.n_links == r.n_a + r.n_b - r.n_groups) for r in queries.op12_tokenizer_alignment(spark, folder).collect()}
    assert got == {i: (len(a), len(b), True) for i, t in texts for a, b in [both(library, t or "")]}
