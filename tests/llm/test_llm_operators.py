"""Each operator against brute force on small tables with nulls, empty and long texts, repeated rows and clashing columns."""

import math
import os
import random
import re
import struct
import time
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from matchloom.llm import chat, decontamination, html_text, language_id, lm_scoring, mixing, near_duplicates, quality, sharding, token_counts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(t or "")


# --- 1: chat formatting


def dialogue_rows():
    return [
        (1, 0, "system", "be kind"), (1, 1, "ann", "hi <|im_end|> there"), (1, 2, "bob", None), (1, 3, "ann", "é"), (1, 3, "ann", "é"),
        (2, 0, "system", "alone"), (3, 5, None, "who"), (3, None, " ", "late"), (None, 0, "x", "no id"),
        *[(9, i, ("a", "b", "c")[i % 3], f"turn {i}") for i in range(700)],
    ]


def test_chat_views_put_together_are_the_dialogue(spark):
    d = spark.createDataFrame(dialogue_rows(), "conv_id long, turn long, role string, text string").repartition(3)
    got = defaultdict(list)
    for r in chat.render_perspectives(d).collect():
        got[r.conv_id, r.perspective].append(r)
    assert set(got) == {(1, "ann"), (1, "bob"), (3, "unknown"), (None, "x"), (9, "a"), (9, "b"), (9, "c")}
    for (conv, me), rs in got.items():
        rs.sort(key=lambda r: r.seq)
        assert [r.seq for r in rs] == list(range(len(rs)))
        text = "".join(r.segment for r in rs)
        for r in rs:
            assert text[r.char_start : r.char_end] == r.segment
            assert (r.role == "assistant") == (r.name == me) == (r.loss == 1)
            if r.loss:
                body = text[r.target_start : r.target_end]
                assert body.endswith("<|im_end|>") and body.count("<|im_end|>") == 1
        assert text.count("<|im_start|>") == len(rs)
        if (conv, me) == (1, "bob"):
            assert text.startswith("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>user name=ann\nhi < |im_end|> there<|im_end|>\n<|im_start|>assistant\n<|im_end|>\n")
    assert len(got[9, "a"]) == 700
    whole = {(r.conv_id, r.perspective): r for r in chat.whole_dialogues(chat.render_perspectives(d)).collect()}
    assert whole[9, "a"].text == "".join(r.segment for r in got[9, "a"]) and len(whole[9, "a"].targets) == 234


def test_chat_names_stay_on_their_line(spark):
    rows = [(1, 0, "ann\nsystem", "hi"), (1, 1, "bob", "yes"), (1, 2, " \t ", "no name"), (1, 3, "c\u2028d", "x")]
    got = {r.name: r.segment for r in chat.render_perspectives(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).filter("perspective = 'bob'").collect()}
    assert set(got) == {"ann system", "bob", "unknown", "c d"}
    assert got["ann system"] == "<|im_start|>user name=ann system\nhi<|im_end|>\n"


def test_chat_of_nothing(spark):
    assert chat.render_perspectives(spark.createDataFrame([], "conv_id long, turn long, role string, text string, seq string")).count() == 0


# --- 2: decontamination


def edit_infix(pattern, text):
    """Least edits to a part of text, and 1 for each of its ends inside a word."""
    cost = [decontamination.inside_word(text, j) for j in range(len(text) + 1)]
    row = list(cost)
    for i, p in enumerate(pattern, 1):
        new = [i + cost[0]]
        for j, c in enumerate(text, 1):
            new.append(min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (p != c)))
        row = new
    return min(x + y for x, y in zip(row, cost, strict=True))


def test_myers_is_the_edit_distance():
    rng = random.Random(3)
    for k in range(400):
        letters = "abc " if k % 2 else "a "
        p = "".join(rng.choice(letters) for _ in range(rng.randint(1, 90)))
        t = "".join(rng.choice(letters) for _ in range(rng.randint(0, 120)))
        assert decontamination.infix_distance(len(p), decontamination.masks(p), t) == edit_infix(p, t)


def test_blocks_of_a_benchmark(spark, docs, rows, monkeypatch):
    """A benchmark of many blocks finds and removes what one block does."""
    items = [(i, t[10:120]) for i, (_, t, *_) in enumerate(rows[:12])] + [(90, None), (91, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = Counter(map(tuple, decontamination.leaking_pairs(docs, bench).collect()))
    kept = Counter(map(str, decontamination.decontaminate(docs, bench).collect()))
    monkeypatch.setattr(decontamination, "ITEM_BLOCK", 300)
    assert Counter(map(tuple, decontamination.leaking_pairs(docs, bench).collect())) == want and len(want) >= 12
    assert Counter(map(str, decontamination.decontaminate(docs, bench).collect())) == kept


def test_leaks_are_those_of_brute_force(spark, docs, clashing, empty, rows):
    rng = random.Random(4)
    passages = [t for _, t, *_ in rows if t and 150 < len(t) < 700][:8]
    items = [(i, t[20:150]) for i, t in enumerate(passages)] + [(50, passages[0][20:150]), (51, None), (52, "short"), (53, "x" * 60), (54, "stone"), (55, "of the"), (56, passages[1][21:38]), (57, passages[2][20:33]), (58, "  ")]
    edited = []
    for i, t in items[:8]:
        c = list(t)
        for _ in range(i * 2):
            c[rng.randrange(len(c))] = "#"
        edited.append((1000 + i, "before it " + "".join(c) + " and after", "en", "src0", 1))
    d = docs.unionByName(spark.createDataFrame(edited, docs.schema))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = Counter((r.doc_id, r.item_id, r.distance) for r in decontamination.leaking_pairs(d, bench).collect())
    want = Counter()
    for doc, t, *_ in [*rows, *edited]:
        t = decontamination.normal(t)
        if len(t) > 5000:
            continue
        for i, item in items:
            item = decontamination.normal(item)
            if item and (x := edit_infix(item, t)) <= int(decontamination.ERROR_RATE * len(item)):
                want[doc, i, x] += 1
    long_ids = {r[0] for r in rows if len(r[1] or "") > 5000}
    assert Counter({k: v for k, v in got.items() if k[0] not in long_ids}) == want and want
    leaking = {k[0] for k in got}
    kept = decontamination.decontaminate(clashing, bench)
    assert kept.columns == clashing.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in rows if r[0] not in leaking)
    assert decontamination.leaking_pairs(empty, bench).count() == 0
    assert decontamination.leaking_pairs(docs, bench.limit(0)).count() == 0


# --- 3: token counts


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pretokens_sum_to_the_tokenizers_count(name):
    t, rng = token_counts.load(f"/opt/tokenizers/{name}"), random.Random(1)
    parts = [" ", "  ", "\n", "\t", "a", "the", "▁", "é", "e\u0301", "日本", "😀", "<s>", "</s>", "<|endoftext|>", "<|startoftext|>", "\x00", "\u3000", "ing", "'s", "1", ".", "\r\n", "x" * 50]
    for _ in range(2000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 12)))
        w, bounds = t.split(pa.array([text, None, text]))
        assert bounds.tolist() == [0, len(w) // 2, len(w) // 2, len(w)]
        assert sum(t.pieces(w.to_pylist())) == 2 * t.whole(text), repr(text)


def test_token_counts_of_a_json_file(docs, rows):
    from tokenizers import Tokenizer

    path = "/opt/tokenizers/byte_bpe_50k.json"
    t = Tokenizer.from_file(path)
    want = Counter((i, len((x or "").encode()), n := len(t.encode(x or "", add_special_tokens=False).ids), n > 4096) for i, x, *_ in rows)
    assert Counter(map(tuple, token_counts.count_tokens(docs, path).collect())) == want


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        token_counts.load("/opt/tokenizers/byte_bpe_50k.tiktoken")


def test_token_counts(docs, clashing, empty, rows):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = Counter((i, len((t or "").encode()), n := len(sp.encode(t or "")), n > 4096) for i, t, *_ in rows)
    assert Counter(map(tuple, token_counts.count_tokens(docs, MODEL).collect())) == want
    assert Counter(map(tuple, token_counts.count_tokens(clashing, MODEL).collect())) == want
    assert token_counts.count_tokens(empty, MODEL).count() == 0


# --- 4: language


def test_bloom_answers_with_all_owners():
    import numpy as np

    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**63, 3000).astype(np.uint64)
    owner = np.arange(3000) % 70  # more languages than bits of one word
    bloom = language_id.BitSlicedBloom([f"l{i:02}" for i in range(70)], h, owner)
    found = bloom.hits(h, np.arange(3000), 3000)
    assert (found[np.arange(3000), owner] == 1).all()
    other = rng.integers(0, 2**63, 20000).astype(np.uint64)
    rate = bloom.hits(other, np.zeros(20000, int), 1)[0] / 20000
    assert np.allclose(rate, bloom.false_rate, atol=0.01)


def test_languages(docs, clashing, empty, rows):
    got = language_id.predict_languages(docs).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    known = {i: (t, lang) for i, t, lang, *_ in rows if i is not None}
    for i, (t, lang) in known.items():
        r = by_id[i]
        assert r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1
        if not re.search(r"[^\W\d_]", t or ""):
            assert r.lang_pred == "und" and r.score == 0
        elif lang and len(t) > 60:
            assert r.lang_pred == lang
    assert language_id.predict_languages(empty).count() == 0
    kept = language_id.keep_identified(clashing)
    assert kept.columns == clashing.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {i for i, (t, lang) in known.items() if lang and len(t or "") > 60} <= ids
    assert not ids & {i for i, (t, _) in known.items() if not re.search(r"[^\W\d_]", t or "")}


def test_long_texts_are_read_part_by_part():
    """Parts of any size give the n-grams of the whole text, so its prediction."""
    rng = random.Random(7)
    letters = ["a", "B", "é", "1", " ", "--", "ß", "日", "\n", "x\u0301", "o", "n"]

    def grams(text, limit):
        out = Counter()
        for plain, _, lead in language_id.units(pa.array([text]), limit):
            for n in language_id.ORDERS:
                out.update((n, h) for h in language_id.ngrams(plain, n, lead)[0].tolist())
        return out

    for _ in range(100):
        text = "".join(rng.choice(letters) for _ in range(rng.randint(0, 300)))
        whole = grams(text, 10**9)
        assert all(grams(text, limit) == whole for limit in (4, 9, 40, 200))
    english = Counter(("the house by the river " * 50)[i : i + 3] for i in range(1000))
    model = language_id.BitSlicedBloom(["en"], np.array([language_id.ngrams(pa.array([g], pa.large_string()), 3, np.array([0]))[0][0] for g in english], np.uint64), np.zeros(len(english), int))
    lang, score = model.predict(pa.array(["the house by the river " * 2_000_000, "the house by the river " * 4, None]))
    assert lang == ["en", "en", "und"] and abs(score[0] - score[1]) < 0.05


def exact_languages(rows, per_order=language_id.PROFILE_SHARE):
    """Profiles as exact sets of n-grams, learned from all labelled rows outside the held-out third, and shares in them."""
    def plain(t):
        return " " + re.sub(" +", " ", "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in t.lower())).strip() + " "

    counts = defaultdict(Counter)
    for i, t, lang, *_ in rows:
        if lang and not (i is not None and zlib.crc32(str(i).encode()) % 3 == 1) and (t or "").strip():
            p = plain(t)
            for n in language_id.ORDERS:
                counts[lang, n].update(p[j : j + n] for j in range(len(p) - n + 1))
    profile = {}
    for key, c in counts.items():
        c = {g: k for g, k in c.items() if k > 1}
        profile[key] = {g for g, k in c.items() if k >= max(2, int(sum(c.values()) * per_order))}

    def best(t):
        p = plain(t)
        grams = [(n, p[j : j + n]) for n in language_id.ORDERS for j in range(len(p) - n + 1)]
        share = {lang: sum(g in profile[lang, n] for n, g in grams) / max(1, len(grams)) for lang in sorted({k for k, _ in counts})}
        top = max(share, key=lambda k: (share[k], [-ord(x) for x in k]))
        return top, share[top]

    return best


def test_languages_are_those_of_exact_sets(spark, docs, rows):
    best = exact_languages(rows)
    got = {r.doc_id: r for r in language_id.predict_languages(docs).collect()}
    for i, t, *_ in rows:
        if i is not None and t and len(t) < 5000 and len(re.findall(r"[^\W\d_]", t)) > 40:
            lang, share = best(t)
            assert got[i].lang_pred == lang and abs(got[i].score - share) < 0.03


def test_dirty_labels_are_bounded(spark):
    rows = [(i, f"some words of text number {i} and more", f"label {i}") for i in range(300)] + [(1000 + i, "the same words of english text again", "en") for i in range(60)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), most_languages=5)
    assert len(model.languages) == 5 and "en" in model.languages


def test_unlabelled_corpus_has_no_language(spark):
    d = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in language_id.predict_languages(d).collect()] == [("und", 0.0)]


# --- 5: quality


def base_measures(t):
    t = t or ""
    w = words(t)
    grams = Counter(tuple(w[j : j + 5]) for j in range(len(w) - 4))
    covered = {k for j in range(len(w) - 4) if grams[tuple(w[j : j + 5])] > 1 for k in range(j, j + 5)}
    lines = [x for x in t.split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered)


def test_quality_measures_and_verdicts(spark, docs, clashing, empty, rows):
    junk = [(900 + i, ("buy*** now### cheap$$$ " * 3 + f"w{i} ") * 4, "en", "src0", 1) for i in range(2)]
    junk += [(910, " ".join(f"{chr(97 + i % 26)}{i}###" for i in range(40)), "en", "src0", 1), (911, "a\nb c\nb c\nb c\n" + " ".join(f"x{i}" for i in range(30)), "de", "src1", 1)]
    d = docs.unionByName(spark.createDataFrame(junk, docs.schema))
    got = quality.judge(d).collect()
    want = Counter((i, *base_measures(t)) for i, t, *_ in [*rows, *junk])
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.kept and r.base_failed)
    assert quality.judge(clashing).count() == len(rows)
    assert quality.judge(empty).count() == 0
    import duckdb

    con = duckdb.connect()
    con.register("documents", d.toPandas())
    order = lambda r: tuple(map(str, r))
    sql = con.sql(f"SELECT doc_id, n_words, n_dup_lines, base_failed, kept, faults FROM ({quality.SQL})").fetchall()
    assert sorted(sql, key=order) == sorted(((r.doc_id, r.n_words, r.n_dup_lines, r.base_failed, r.kept, ",".join(r.faults)) for r in got), key=order)
    again = quality.judge(d.repartition(7)).collect()
    assert Counter(map(str, again)) == Counter(map(str, got))


def spread_rows(n):
    """Languages whose word lengths spread little or much, sources with more or less repetition, and some far outside."""
    words_of = {"aa": ["abcde", "fghij"], "bb": ["ab", "abcdefgh", "abcdefghijklmno"], None: ["x", "yy"]}
    rnd = random.Random(3)
    rows = []
    for i in range(n):
        lang = ("aa", "bb", "aa", None)[i % 4]
        w = [rnd.choice(words_of[lang]) + rnd.choice("xyz") * rnd.randrange(2) + ("#" if i % 97 == 5 else "") * 9 for _ in range(rnd.randint(12, 60))]
        rows.append((i, " ".join(w) + "\nsame line" * (i % 31 == 7) * 2, lang, "st"[i // 4 % 2]))
    return rows


def test_fences_are_those_of_exact_quantiles(spark, monkeypatch):
    monkeypatch.setattr(quality, "SHRINK", 0)
    d = spark.createDataFrame(spread_rows(1200), "doc_id long, text string, lang string, source string")
    m = quality.judge(d).filter("not base_failed")
    got = {(r.lang, r.source): r for r in quality.fences(m, list(quality.MEASURES)).collect()}
    values = defaultdict(lambda: defaultdict(list))
    for r in m.collect():
        for k in quality.MEASURES:
            values[r.lang, r.source][k].append(r[k])
    assert set(got) == set(values) and len(got) == 6
    quantile = lambda x, q: sorted(x)[max(1, math.ceil(q * len(x))) - 1]
    for group, measured in values.items():
        assert got[group].n == len(measured["mean_word"])
        for k, x in measured.items():
            q1, q3 = quantile(x, 0.25), quantile(x, 0.75)
            wide = math.ceil(math.log(max(q3, 1e-9)) / math.log(quality.GAMMA)) > math.ceil(math.log(max(q1, 1e-9)) / math.log(quality.GAMMA))
            high = q3 + 3 * (q3 - q1) if wide else quantile(x, 0.99)
            assert got[group][f"high_{k}"] == pytest.approx(high, rel=0.03, abs=1e-9)
    width = {g: r.high_mean_word - r.low_mean_word for g, r in got.items()}
    assert width["bb", "s"] > 2 * width["aa", "s"] and got["aa", "s"].high_mean_word != got["aa", "t"].high_mean_word


def test_small_groups_take_the_fences_of_their_language(spark):
    rows = spread_rows(800) + [(5000, " ".join(f"abcd{i}" for i in range(20)), "aa", "alone"), (5001, " ".join(f"abc{i}" for i in range(20)), "cc", "s")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {(r.lang, r.source): r for r in quality.fences(quality.judge(d).filter("not base_failed"), list(quality.MEASURES)).collect()}
    assert got["aa", "alone"].n == 1 and got["aa", "alone"].high_mean_word < 0.7 * got["bb", "s"].high_mean_word
    assert got["aa", "alone"].high_mean_word < got["cc", "s"].high_mean_word


def test_quality_of_a_text_of_many_megabytes(spark):
    text = " ".join(f"word{i}" for i in range(300_000)) + "\n" + "again and again it is said\n" * 50_000
    d = spark.createDataFrame([(1, text, "en", "s")], "doc_id long, text string, lang string, source string")
    r = quality.judge(d).first()
    assert (r.n_words, r.n_dup_lines, r.base_failed) == (600_000, 49_999, True)


# --- 6: mixing


def targets_by_hand(sizes, weights, share, most):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    rest, free, t = share * sum(sizes.values()), {s for s in order if sizes[s]}, dict.fromkeys(order, 0.0)
    while rest > 1e-9 and free:
        total = sum(w[s] for s in free)
        add, rest = {s: rest * w[s] / total for s in free}, 0
        for s in list(free):
            t[s] += add[s]
            if t[s] >= most * sizes[s] - 1e-9:
                rest += t[s] - most * sizes[s]
                t[s] = most * sizes[s]
                free.discard(s)
    return t


def test_mix(spark, docs, clashing, empty, rows):
    many = [(5000 + i, " ".join(["w"] * (1 + i * 37 % 211)), "en", f"big{i % 2}", 1) for i in range(2500)]
    d = docs.unionByName(spark.createDataFrame(many, docs.schema))
    got = mixing.mix(d).collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((i, len(words(t))) for i, t, *_ in [*rows, *many])
    sizes = defaultdict(int)
    for _, t, _, s, _ in [*rows, *many]:
        sizes[s] += len(words(t))
    want, taken, largest = targets_by_hand(sizes, (5, 2, 1), 1.5, 2.0), defaultdict(int), defaultdict(int)
    for r in got:
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9) and r.source_size == sizes[r.source]
        assert 0 <= r.taken <= 2 * r["size"]
        rate = r.target / r.source_size
        assert not r["size"] or r.copies in (math.floor(rate + 1e-9), math.ceil(rate - 1e-9))
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r["size"])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s]
    assert all(abs(taken[s] - want[s]) <= 0.01 * want[s] for s in ("big0", "big1"))
    again = mixing.mix(d.repartition(5)).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))
    assert mixing.mix(empty).count() == 0
    out = mixing.apply_mix(clashing)
    assert out.columns == clashing.columns
    alone = Counter()
    for r in mixing.mix(docs).collect():
        alone[r.doc_id] += r.copies
    assert Counter(r.doc_id for r in out.collect()) == +alone


def test_targets_of_many_sources(spark):
    """Caps that are reached one after another, empty sources, a null source, and far more sources than ranges."""
    rng = random.Random(4)
    sizes = {f"s{i:04}": rng.choice([0, 1, 5, 100, 10_000]) for i in range(700)} | {None: 50}
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long"), (5, 2, 1), 1.5, 2.0).collect()}
    want = targets_by_hand(sizes, (5, 2, 1), 1.5, 2.0)
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k], rel=1e-9, abs=1e-6) for k in want)
    for share in (0.0, 2.0, 3.0):
        got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame([("a", 10), ("b", 1000)], "source string, source_size long"), (5, 2, 1), share, 2.0).collect()}
        assert sum(got.values()) == pytest.approx(min(share, 2.0) * 1010)


def test_pivotal_keeps_expectations(spark):
    d = spark.createDataFrame([(i, "w " * 10, s) for i in range(40) for s in ("a", "b")], "doc_id long, text string, source string")
    n = Counter()
    for seed in range(12):
        for r in mixing.mix(d, weights=(1, 3), share=0.8, seed=seed).filter("source = 'a'").collect():
            n[r.doc_id] += r.copies
    total = sum(n.values())  # rate 0.4 of 40 rows, 12 times
    assert total == 12 * 16 and max(n.values()) <= 11


def spark_hash(*values):
    """xxhash64 of Spark: of longs (plain integers) and ints (given as bytes)."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(v if isinstance(v, bytes) else struct.pack("<q", v), h)
    return h - (1 << 64) if h >> 63 else h


def uniform(*values):
    return ((spark_hash(*values) & (1 << 64) - 1) >> 11) * 2.0**-53


def pivotal(items, *salt):
    """Fold [size, key, name, p] two at a time; returns {name: 0 or 1} and the one left over, if any."""
    left, done = None, {}
    for x in items:
        x = list(x)
        if left is None:
            left = x
            continue
        u, both = uniform(left[1], x[1], *salt), left[3] + x[3]
        if both < 1:
            stays, gone, up, p = (x, left, 0, both) if u * both < x[3] else (left, x, 0, both)
        else:
            stays, gone, up, p = (x, left, 1, both - 1) if u * (2 - both) < 1 - x[3] else (left, x, 1, both - 1)
        done[gone[2]] = up
        stays[3] = p
        left = stays
        if not 1e-9 < p < 1 - 1e-9:
            done[stays[2]] = round(p)
            left = None
    return done, left


@pytest.mark.parametrize("trials", [1, 64])
def test_mix_is_the_pivotal_fold_by_hand(spark, trials):
    """Row by row: classes folded largest first, the last rows drawn in shuffled orders, the nearest outcome mended once."""
    rng = random.Random(21)
    rows = [(i, " ".join(["w"] * rng.choice([3, 9, 10, 11, 40, 41, rng.randint(1, 300)])), rng.choice(["a", "b", "b", "c", None])) for i in range(400)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    seed, int_seed = 17, struct.pack("<i", 17)
    key = {r.doc_id: (r.key, r.h1, r.h2) for r in d.selectExpr("doc_id", f"xxhash64(doc_id, text, {seed}) AS key", "xxhash64(doc_id, text, source) AS h1", "xxhash64('second', doc_id, text, source) AS h2").collect()}
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len(words(t))
    targets, want = targets_by_hand(sizes, (5, 2, 1), 1.5, 2.0), {}
    for s, target in targets.items():
        rate = target / sizes[s]
        whole = math.floor(rate + 1e-9)
        classes = defaultdict(list)
        for i, t, of in rows:
            if of == s:
                classes[math.floor(math.log2(len(words(t))) * 8)].append((len(words(t)), key[i][0], i, max(0.0, rate - whole), key[i]))
        by_size = lambda x: (x[0], x[1], x[2], x[4][1], x[4][2], x[3])
        copies, last = {}, []
        for items in classes.values():
            items.sort(key=by_size, reverse=True)
            if rate - whole <= 1e-9:
                copies |= {x[2]: 0 for x in items}
            elif len(items) <= mixing.FEW:
                last += items
            else:
                done, left = pivotal([x[:4] for x in items], int_seed, struct.pack("<i", 0))
                copies |= done
                last += [(*left, key[left[2]])] if left else []
        size = {i: len(words(t)) for i, t, _ in rows}
        missing = target - sum((whole + up) * size[i] for i, up in copies.items())
        last.sort(key=by_size, reverse=True)
        outcomes = []
        for trial in range(1, trials + 1):
            in_turn = sorted(enumerate(last), key=lambda e: (spark_hash(e[1][1], int_seed, struct.pack("<i", trial)), e[1][0], e[1][1], e[0]))
            done, left = pivotal([(x[0], x[1], place, x[3]) for place, x in in_turn], int_seed, struct.pack("<i", -trial))
            if left:
                done[left[2]] = int(uniform(left[1], int_seed, struct.pack("<i", -trial)) < left[3])
            miss = missing - sum((whole + up) * last[i][0] for i, up in done.items())
            words_of = lambda i: last[i][0] if i >= 0 else 0
            ups, downs = ([-1, *(i for i, up in done.items() if up == n and trials > 1)] for n in (1, 0))
            swaps = [(abs(miss - words_of(y) + words_of(x)), x, y) for x in ups for y in downs]
            outcomes.append((min(swaps), trial, done))
        (_, down, up), _, done = min(outcomes, key=lambda e: (e[0][0], e[1]))
        copies |= {last[i][2]: n + (i == up) - (i == down) for i, n in done.items()}
        want |= {i: whole + n for i, n in copies.items()}
    assert {r.doc_id: r.copies for r in mixing.mix(d, trials=trials).collect()} == want


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_small_sources_come_near_their_targets(spark, folder):
    if not os.path.isdir(f"/root/testdata/{folder}"):
        pytest.skip("no tables")
    got = mixing.mix(spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    assert all(abs(r.taken - r.target) <= 0.01 * r.target for r in got)


# --- 7: HTML


def test_extract_article():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
    <div class="cookie-notice">We use cookies to make the site better for you.</div>
    <header><h1>Site</h1><nav><ul><li><a href=/>Home</a></li></ul></nav></header>
    <article><h1>Title &amp; more</h1><p>The first paragraph of the article is here, and it has a lot&nbsp;of   words in it.
    <p>Short.<script>var x = "<p>not text</p>";</script><div class=ad>Buy this thing now for a price that is low.</div><!-- <p>no</p> -->
    <p>The <b>last</b> one &eacute; &#x41; is in it as well<br>and goes on.</p><section id="comments"><p>I think that this is the best of all.</p></section></article>
    <aside><p>The most read of the week is in this list.</p></aside><form>Search the site <input></form><footer>&copy; of the site</footer></body></html>"""
    assert html_text.extract(page) == "Title & more The first paragraph of the article is here, and it has a lot of words in it. Short. The last one é A is in it as well and goes on."


def test_extract_without_article_uses_density_and_neighbours():
    menu = "".join(f'<li><a href="/{i}">Link number {i}</a></li>' for i in range(8))
    page = f"""<body><ul>{menu}</ul><div><h2>About it</h2><p>This is the text of the page and it is long enough to be told by the words that are in it, as it has many of them.</p>
    <p>Yes.</p><p>And this is another one of the paragraphs that are in the page, so that the short one is between two of them for sure.</p></div><ul>{menu}</ul></body>"""
    text = html_text.extract(page)
    assert text.startswith("About it This is the text") and " Yes. And this" in text and "Link" not in text


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "a < b", "<!-- open", "<script>x", "<a" * 50, "</p></div>", "<p>&#0;&#1114112;&bogus;"])
def test_extract_of_odd_pages(page):
    assert isinstance(html_text.extract(page), str)


HARD = {
    "open tags": "<a " * 700_000, "unmatched ends": "<span>" * 150_000 + "</b>" * 150_000, "quotes": "<a \"\"" * 300_000 + "\">x", "one quote": "<a '>" * 300_000 + '"', "beyond a table": "<b><table>" + "<i>" * 200_000 + "</b>" * 200_000,
    "blocks after inline": "<span>" * 150_000 + "<h1></h1>" * 100_000, "items after inline": "<span>" * 150_000 + "<li>" * 150_000, "all unsure": "<p>a b</p>" * 100_000, "long name": "<p class='" + "a_" * 500_000 + "'>x", "lone": "<" * 1_000_000 + ">",
    "comments": "<!--" * 500_000, "declarations": "<!a" * 500_000, "raw": "<script>" * 200_000, "digits": "<p>&#" + "9" * 100_000 + "; &#x" + "f" * 100_000 + "; &#0000000065;",
}


@pytest.mark.parametrize("name", HARD)
def test_extract_takes_time_linear_in_broken_pages(name):
    began = time.process_time()
    text = html_text.extract(HARD[name])
    assert time.process_time() - began < 10
    assert name != "digits" or text == "\ufffd \ufffd A"


def plain_reference(page):
    """The text of article elements less furniture, by the library's parser: for well-formed pages with an article."""
    from html.parser import HTMLParser

    class Reader(HTMLParser):
        out, open_, now = [], [], ""

        def flush(self):
            if t := " ".join(self.now.split()):
                self.out = [*self.out, t]
            self.now = ""

        def handle_starttag(self, tag, attrs):
            if tag in html_text.BLOCKS:
                self.flush()
            if tag not in html_text.VOID:
                bad = tag in html_text.SKIPPED | {"nav", "footer", "aside"} or "junk" in dict(attrs).values() or any("advert" in (v or "") or "comments" in (v or "") for _, v in attrs)
                self.open_ = [*self.open_, (tag, bad)]

        def handle_endtag(self, tag):
            if tag in html_text.BLOCKS:
                self.flush()
            self.open_ = self.open_[:-1]

        def handle_data(self, data):
            if any(t == "article" for t, _ in self.open_) and not any(b for _, b in self.open_):
                self.now += data

    r = Reader()
    r.feed(page)
    r.flush()
    return " ".join(r.out)


def test_extract_is_a_plain_reader_of_well_formed_articles():
    rng = random.Random(12)
    words_ = "the of and to in house river stone market walking morning with was for".split()
    sentence = lambda n: " ".join(rng.choice(words_) for _ in range(n)) + "."
    for _ in range(60):
        parts = []
        for _ in range(rng.randint(1, 9)):
            kind = rng.randrange(8)
            if kind < 4:
                parts.append(f"<p>{sentence(rng.randint(12, 60))} <b>{sentence(3)}</b> &amp; {sentence(5)}</p>")
            else:
                parts.append(["<h2>" + sentence(4) + "</h2>", '<div class="advert">' + sentence(20) + "</div>", "<script>if (a < b) { c }</script>", "<ul><li>" + sentence(15) + "</li><li>" + sentence(14) + "</li></ul>"][kind - 4])
        page = f"<html><body><nav><a href='/'>{sentence(5)}</a></nav><article><h1>{sentence(6)}</h1><p>{sentence(40)}</p>{''.join(parts)}<section id='comments'><p>{sentence(30)}</p></section></article><aside><p>{sentence(30)}</p></aside><footer>{sentence(12)}</footer></body></html>"
        assert html_text.extract(page) == plain_reference(page)


def test_extract_pages_keeps_rows(spark):
    rows = [(1, "u", "<article><p>One</p></article>"), (1, "u", "<article><p>One</p></article>"), (None, None, None), (2, "v", "<article>" + "<p>word and the rest</p>" * 20000 + "</article>")]
    d = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = html_text.extract_pages(d).collect()
    assert Counter((r.page_id, r.n_chars) for r in got) == Counter({(1, 3): 2, (None, 0): 1, (2, 20000 * 18 - 1): 1})
    assert html_text.extract_pages(d.limit(0)).count() == 0


# --- 8: language model


def reference_scores(rows, order=3):
    """Every text token by token through an automaton in dicts: states, arcs and failure arcs of all training n-grams."""
    low = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    texts = [[*words((t or "").translate(low)), "\n"] for _, t, *_ in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, *_ in rows]
    c = Counter(tuple(t[j - k : j + 1]) for t, h in zip(texts, held, strict=True) if not h for j in range(len(t)) for k in range(min(j + 1, order)))
    n, v = sum(x for g, x in c.items() if len(g) == 1), sum(len(g) == 1 for g in c)
    prior = lm_scoring.PRIOR

    def p(g):
        return (c[g] + 1) / (n + v + 1) if len(g) == 1 else (c[g] + prior[len(g) - 2] * p(g[1:])) / (c[g[:-1]] + prior[len(g) - 2])

    out = []
    for (i, *_), t, h in zip(rows, texts, held, strict=True):
        state, score = (), 0.0
        for w in t:
            while state and not c[*state, w]:
                score += math.log10(prior[len(state) - 1] / (c[state] + prior[len(state) - 1]))
                state = state[1:]
            score += math.log10(p((*state, w)))
            state = (*state, w)[1 - order :]
            while state and not c[state]:
                state = state[1:]
        base = sum(math.log10((c[w,] + 1) / (n + v + 1)) for w in t)
        out.append((i, h, len(t), sum(c[w,] > 0 for w in t), n, base, score))
    return out


def same_scores(got, want):
    order = lambda r: (str(r[0]), r[2], r[5])
    got, want = sorted(map(tuple, got), key=order), sorted(want, key=order)
    assert len(got) == len(want)
    for g, w in zip(got, want, strict=True):
        assert g[:5] == w[:5] and g[5] == pytest.approx(w[5], rel=1e-9) and g[6] == pytest.approx(w[6], rel=1e-9)


def test_lm_scores(spark, docs, clashing, empty, rows):
    want = reference_scores(rows)
    for d in (docs, clashing):
        same_scores(lm_scoring.score_documents(d).collect(), want)
    assert lm_scoring.score_documents(empty).count() == 0
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    only = lm_scoring.score_documents(spark.createDataFrame([(held, "no training text")], "doc_id long, text string")).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in only] == [(4, 0, 0, 0.0, 0.0)]


def test_lm_scores_do_not_depend_on_blocks(spark, docs, rows, monkeypatch):
    """Texts cut into many pieces, many blocks and many buckets give the same sums."""
    monkeypatch.setattr(lm_scoring, "BUCKET_ENTRIES", 500)
    from pyspark.sql import functions as F

    got = lm_scoring.score_texts(docs, lm_scoring.split_of("doc_id", 7) == 2, block_bytes=3000)
    assert got.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    same_scores(got.collect(), reference_scores(rows))
    assert got.agg(F.max("n_tokens")).first()[0] > 15_000


@pytest.mark.parametrize("history", ["a b", "c d", "zz b", "b zz", "zz yy", "a", ""])
def test_lm_probabilities_sum_to_one(history):
    """Over all words, the end and one unknown word, after known and unknown histories."""
    train, k = ["a b c a b d", "b c d"], len(history.split())
    texts = train + [history, *(f"{history} {w}" for w in ("a", "b", "c", "d", "unknown"))]
    n = len(texts)
    batch = pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip((range(n), range(n), [False] * n, [0] * n, [True] * n, texts), lm_scoring.PACKED, strict=True)], schema=lm_scoring.PACKED)
    grams = lm_scoring.Grams(batch, 3)
    counts = grams.counts(np.arange(n) < 2)
    add = lm_scoring.Automaton(grams, counts, 11, 5).run()
    assert sum(10 ** add[grams.starts[i] + k] for i in range(2, n)) == pytest.approx(1)


@pytest.mark.parametrize("limit", [5, 17, 1000])
def test_lm_pieces_are_the_text(limit):
    text = "one two  three\nfour ünï five " + "x" * 40 + " six seven   "
    got = lm_scoring.cut(text, limit, 2)
    assert [w for lead, _, t in got for w in words(t)[lead:]] == words(text)
    assert [e for _, e, _ in got] == [False] * (len(got) - 1) + [True]
    before = []
    for lead, _, t in got:
        assert words(t)[:lead] == before[len(before) - lead :] and lead == min(2, len(before))
        before += words(t)[lead:]


def test_lm_packing():
    rng = np.random.default_rng(1)
    for x in (np.zeros(0, np.uint64), np.sort(rng.integers(0, 2**63, 999).astype(np.uint64)), np.array([2**64 - 1], np.uint64)):
        assert (np.cumsum(lm_scoring.unpacked(lm_scoring.packed(np.diff(x, prepend=np.uint64(0)))), dtype=np.uint64) == x).all()


# --- 9: sharding


def test_differencing_beats_first_come():
    rng = random.Random(2)
    weights = [int(rng.paretovariate(1.2) * 100) for _ in range(300)]
    weights = [min(w, sum(weights) // 16) for w in weights]
    final = sharding.difference([[w, 0, 0, 0] for w in weights], 4)
    sums = Counter()
    for w, f in zip(weights, final, strict=True):
        sums[f[0]] += w
    assert max(sums.values()) - min(sums.values()) <= 2
    parts = sharding.difference([[5, 3, 1], [4, 4, 0], [7, 0, 0]], 3)
    assert all(sorted(p) == [0, 1, 2] for p in parts)


def plain_differencing(weights, k):
    """Karmarkar-Karp by sorted lists of sums and their members, nothing else."""
    parts = [[(w, [i])] + [(0, [])] * (k - 1) for i, w in enumerate(weights)]
    while len(parts) > 1:
        parts.sort(key=lambda p: -(p[0][0] - p[-1][0]))
        a, b = parts[0], parts[1]
        joined = sorted(((x + y, m + n) for (x, m), (y, n) in zip(a, reversed(b), strict=True)), key=lambda e: -e[0])
        parts = [joined, *parts[2:]]
    return sorted(s for s, _ in parts[0])


def test_differencing_is_that_of_plain_lists():
    rng = random.Random(9)
    for _ in range(40):
        k, weights = rng.choice([2, 3, 5]), rng.sample(range(1, 100_000), rng.randint(1, 40))
        final = sharding.difference([[w] + [0] * (k - 1) for w in weights], k)
        sums = Counter({b: 0 for b in range(k)})
        for w, f in zip(weights, final, strict=True):
            sums[f[0]] += w
        assert max(sums.values()) - min(sums.values()) == max(plain_differencing(weights, k)) - min(plain_differencing(weights, k))


def test_a_giant_group_stays_whole(spark):
    d = spark.range(2000).selectExpr("id as doc_id", "if(id % 2 = 0, 'copy of one text', concat('text ', id)) as text")
    for got in (sharding.shard_documents(d).toPandas(), sharding.apply_shards(d).toPandas()):
        assert got[got.doc_id % 2 == 0].shard.nunique() == 1 and got.shard.nunique() == 16


def test_shards(spark, docs, clashing, empty, rows):
    got = sharding.shard_documents(docs, chunk_groups=10, fan_in=3).collect()
    text = {i: t for i, t, *_ in rows}
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    slots, where = defaultdict(list), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        where[text[r.doc_id]].add(r.shard)
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < 16
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and all(len(v) == 1 for v in where.values())
    assert sharding.shard_documents(clashing).count() == len(rows)
    assert sharding.shard_documents(empty).count() == 0


def test_sharded_rows_keep_their_columns(docs, clashing, empty):
    both = docs.unionByName(docs.filter("doc_id < 20"))
    got = sharding.apply_shards(both, chunk_groups=10).collect()
    assert Counter(tuple(r[c] for c in docs.columns) for r in got) == Counter(map(tuple, both.collect()))
    want = sharding.shard_documents(both, chunk_groups=10).collect()
    columns = ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert Counter(tuple(r[c] for c in columns[:5]) for r in got) == Counter(tuple(r[c] for c in columns[:5]) for r in want)
    assert sorted((r.shard, r.slot) for r in got) == sorted((r.shard, r.slot) for r in want)
    dealt = sharding.apply_shards(clashing)
    assert len(set(dealt.columns)) == len(dealt.columns) and {"with.dot", "row", *columns} <= set(dealt.columns)
    assert dealt.count() == clashing.count() and dict(dealt.dtypes)["shard"] == "int"
    assert sharding.apply_shards(empty).collect() == []


def test_shard_bytes_are_near_equal_beside_a_giant(spark):
    d = spark.range(4000).selectExpr("id as doc_id", "if(id % 3 = 0, repeat('copy ', 20), concat(repeat('x', cast(id * 7919 % 997 as int)), id)) as text")
    got = sharding.shard_documents(d, chunk_groups=200).toPandas()
    giant = got[got.doc_id % 3 == 0].shard.unique()
    sums = got.groupby("shard")["size"].sum()
    assert len(sums) == 16 and len(giant) == 1
    assert set(got[got.shard == giant[0]].doc_id % 3) == {0}
    rest = sums.drop(giant[0])
    assert rest.max() - rest.min() <= 0.01 * rest.mean()


# --- 10: near duplicates


def brute_force_links(rows, similarity=0.8):
    sets = []
    for _, t, *_ in rows:
        w = words(t)
        sets.append(frozenset(tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))) if w else frozenset())
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = [0] * len(rows)
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    classes = defaultdict(list)
    for k in range(len(rows)):
        classes[find(k)].append(rows[k][0])
    least = {root: min((i for i in ids if i is not None), default=None) for root, ids in classes.items()}
    return Counter((rows[k][0], least[find(k)], links[k]) for k in range(len(rows)))


def test_near_duplicates_are_those_of_brute_force(spark, docs, clashing, empty, rows):
    want = brute_force_links(rows)
    assert Counter(map(tuple, near_duplicates.near_duplicates(docs).collect())) == want
    assert near_duplicates.near_duplicates(empty).count() == 0
    kept = near_duplicates.deduplicate(clashing)
    assert kept.columns == clashing.columns
    ids = Counter(r.doc_id for r in kept.collect())
    no_word = {i for i, t, *_ in rows if not words(t)}
    assert set(ids) == {c for (_, c, _) in want} | no_word and all(n == 1 for n in ids.values())


def test_texts_with_one_first_hash_are_told_apart(spark, docs, rows, monkeypatch):
    want = {tuple(r) for r in near_duplicates.near_duplicates(docs).collect()}
    kept = sorted(map(str, near_duplicates.deduplicate(docs).collect()))
    monkeypatch.setattr(near_duplicates, "node_of", lambda text: F.pmod(F.xxhash64(text), F.lit(9)))
    assert {tuple(r) for r in near_duplicates.near_duplicates(docs).collect()} == want
    assert len(kept) < len(rows)
    assert len(near_duplicates.deduplicate(docs).collect()) == len(kept)


def test_near_duplicates_in_large_groups(spark, monkeypatch):
    """A group larger than a bucket and a block, a passage that all share, and exact copies."""
    monkeypatch.setattr(near_duplicates, "BLOCK", 40)
    rng = random.Random(8)
    shared = [f"s{i}" for i in range(30)]
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(100):  # near copies
        w = list(base)
        w[rng.randrange(120)] = f"e{i}"
        rows.append((i, " ".join(w)))
    for i in range(150):  # one passage in all, else different
        rows.append((1000 + i, " ".join(shared + [f"d{i}_{j}" for j in range(60)])))
    rows += [(2000 + i, rows[0][1]) for i in range(70)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert Counter(map(tuple, near_duplicates.near_duplicates(d).collect())) == brute_force_links(rows)


def test_sampled_tokens_branch():
    """A set samples BRANCHING tokens on average, sets that are alike the same ones, and other runs others."""
    rng = np.random.default_rng(3)
    same = np.sort(near_duplicates.mix64(rng.integers(0, 2**62, 400).astype(np.uint64)))
    other = np.sort(near_duplicates.mix64(rng.integers(0, 2**62, 400).astype(np.uint64)))
    got = near_duplicates.chosen_tokens(np.concatenate([same, same, other]), np.array([0, 400, 800, 1200]), 0, 100).to_pylist()
    assert got[0] == got[1] and {len(x) for x in got[0]} >= {0, 1, 2}
    assert abs(np.mean([len(x) for x in got[0] + got[2]]) - near_duplicates.BRANCHING) < 0.2
    later = near_duplicates.chosen_tokens(same, np.array([0, 400]), 50, 50).to_pylist()[0]
    assert later == got[0][50 * near_duplicates.LEVELS :]


def test_rounds_go_on_until_hardly_a_join_is_new(spark, docs, rows, monkeypatch):
    """With one run a round a single round loses links; rounds are repeated, with tokens of more passes, until none is new."""
    monkeypatch.setattr(near_duplicates, "RUNS", 1)
    asked = []
    edges = near_duplicates.candidate_edges
    monkeypatch.setattr(near_duplicates, "candidate_edges", lambda nodes, first, runs: asked.append(first) or edges(nodes, first, runs))
    near_duplicates.near_duplicates(docs, missed=0.0).count()
    assert asked == list(range(len(asked))) and len(asked) >= 2


def test_short_items_follow_the_rule_of_all():
    m = decontamination.Matcher(["who is it?", "ann", "", "abcdefghij klmnopq", "  Ann "])
    assert m.leaks("Tell me: WHO  is it? Ann.") == {"who is it?": 0, "ann": 0, "  Ann ": 0}
    assert m.leaks("annual plans of Joann, and who is in?") == {}
    assert m.leaks("so abcdefXhij klmnopq it is") == m.leaks("so xabcdefghij klmnopq it is") == {"abcdefghij klmnopq": 1}
    assert m.leaks("so xabcdefghij klmnopqx it is") == m.leaks("so abcdeXXhij klmnopq it is") == {}


def test_one_item_many_times_is_one_text(spark, docs, rows, monkeypatch):
    """Repeated and empty items are gone before blocks are cut: many blocks' worth of them are one text."""
    text = rows[0][1][:100]
    monkeypatch.setattr(decontamination, "ITEM_BLOCK", 150)
    bench = spark.createDataFrame([(i, text) for i in range(300)] + [(900 + i, None) for i in range(300)] + [(2000, " ")], "item_id long, text string")
    got = decontamination.leaking_pairs(docs, bench).collect()
    assert len({r.item_id for r in got}) == 300 and len(got) % 300 == 0


@pytest.mark.parametrize("text", ["Вчера вечером жители города собрались возле старой мельницы чтобы послушать рассказ мастера который много лет чинил колёса плотины лодки мосты дороги заборы крыши окна двери печи колодцы", "昨天傍晚城里的居民聚集在古老的磨坊旁边聆听一位工匠讲述他多年来修理水车堤坝船只桥梁道路屋顶门窗火炉水井的故事大家都觉得非常有趣并且久久不愿离去"])
def test_pages_in_languages_without_known_stop_words(text):
    links = "".join(f'<li><a href="/{i}">ссылка номер {i} 链接</a></li>' for i in range(30))
    page = f"<body><ul>{links}</ul><div><p>{text}</p><p>{text[:20]}</p><p>{text}!</p></div><ul>{links}</ul></body>"
    assert html_text.extract(page) == f"{text} {text[:20]} {text}!"


def test_unlabelled_corpus_is_kept(spark):
    d = spark.createDataFrame([(i, t, None) for i, t in enumerate(["some words", "ещё слова", "12 + 3", None, ""])], "doc_id long, text string, lang string")
    assert sorted(r.doc_id for r in language_id.keep_identified(d).collect()) == [0, 1]
