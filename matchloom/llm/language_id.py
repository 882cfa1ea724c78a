"""Language identification by bit-sliced Bloom filters that answer with a bitmask of languages for each n-gram."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filtered, mix64, slices, split_of, text_offsets

#: n-gram orders, in code points of the lower-cased text with runs of non-letters as one space.
ORDERS = (2, 3, 4)
#: An n-gram belongs to a language's profile if it makes up at least this share of the language's n-grams of its order.
PROFILE_SHARE = 1 / 4000
#: Labelled documents that the profiles are learned from, per language, about: a documented bound on the training sample.
TRAIN_DOCS = 20_000
#: Labels that are learned at most, the most frequent first: a bound where labels are dirty.
MOST_LANGUAGES = 2_000
#: Bloom filter: slots for each profile entry of the largest language, and hash functions.
SLOTS_PER_ENTRY, HASHES = 8, 3
#: Text bytes that a worker handles at a time: each takes some 60 bytes of arrays.
SLICE = 1_500_000
UNDECIDED = "und"


def normal(column: pa.Array) -> pa.Array:
    """Lower case, with each run of other than letters and marks as one space."""
    return pc.replace_substring_regex(pc.utf8_lower(column.cast(pa.large_string())), r"[^\p{L}\p{M}]+", " ")


_LETTER = regex.compile(r"[\p{L}\p{M}]")


def units(column: pa.Array, limit: int) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray]]:
    """Normalised texts in arrays of about `limit` bytes, the row of each, and how many of its first characters are known.

    Each text has a space at either end. A longer text is cut after letters, so that its parts normalise as the whole
    does, and each further part is led by the last characters before it, as many as the longest n-gram takes back.
    """
    back = max(ORDERS) - 1
    texts, rows, lead, size = [], [], [], 0
    sizes = np.diff(text_offsets(column)[0])
    start = 0
    while start < len(column):
        if sizes[start] > limit:
            text, at, before = column[start].as_py() + " ", 0, " "
            while at < len(text):
                end = at + limit // 4  # characters take four bytes at most
                m = _LETTER.search(text, end) if end < len(text) else None
                end = m.end() if m else len(text) if end >= len(text) or not _LETTER.search(text, at) else end
                part = normal(pa.array([before + text[at:end]]))[0].as_py() + ("" if m else " ")
                yield normal(pa.array([part])), np.array([start]), np.array([0 if at == 0 else len(before)])
                at, before = end, part[-back:]
                if not m:
                    break
            start += 1
            continue
        end = start
        size = 0
        while end < len(column) and sizes[end] <= limit and (size := size + sizes[end] + 2) <= limit + 2:
            end += 1
        part = column.slice(start, end - start).fill_null("").cast(pa.large_string())
        space = pa.scalar(" ", pa.large_string())
        yield normal(pc.binary_join_element_wise(space, part, space, pa.scalar("", pa.large_string()))), np.arange(start, end), np.zeros(end - start, np.int64)
        start = end


def ngrams(plain: pa.Array, n: int, lead: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams of normalised texts that end after the first `lead` characters, and the text of each."""
    lengths = pc.utf8_length(plain).to_numpy()
    raw = text_offsets(plain)[1]
    chars = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.uint64)
    if len(chars) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32)
    row = np.repeat(np.arange(len(plain), dtype=np.int32), lengths)
    with np.errstate(over="ignore"):
        h = chars[: len(chars) - n + 1].copy()
        for i in range(1, n):
            h *= np.uint64(0x100000001B3)
            h ^= chars[i : len(chars) - n + 1 + i]
    whole = row[: len(chars) - n + 1] == row[n - 1 :]
    if lead.any():
        at = np.arange(len(chars), dtype=np.int64) - np.repeat(np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        whole &= (at >= np.repeat(lead, lengths))[n - 1 :]
    return mix64(h[whole], n), row[: len(chars) - n + 1][whole]


class BitSlicedBloom:
    """One Bloom filter for each language, stored slot by slot: a slot holds one bit for each language.

    The AND of an n-gram's slots is the set of languages that (may) contain it: one look-up for all languages.
    """

    def __init__(self, languages: list[str], hashes: np.ndarray, owner: np.ndarray):
        """owner[i]: index of the language whose profile has hashes[i]."""
        self.languages = languages
        largest = int(np.bincount(owner, minlength=1).max()) if len(owner) else 0
        self.bits = max(10, int(np.ceil(np.log2(max(1, largest) * SLOTS_PER_ENTRY))))
        self.planes = [np.zeros(1 << self.bits, np.uint64) for _ in range(-(-max(1, len(languages)) // 64))]
        for word, plane in enumerate(self.planes):
            mine = owner // 64 == word
            for slot in self._slots(hashes[mine]):
                np.bitwise_or.at(plane, slot, np.uint64(1) << (owner[mine] % 64).astype(np.uint64))
        fill = [float(((self.planes[i // 64] >> np.uint64(i % 64)) & np.uint64(1)).mean()) for i in range(len(languages))]
        self.false_rate = np.array(fill) ** HASHES

    def _slots(self, hashes: np.ndarray) -> list[np.ndarray]:
        mask, step = np.uint64((1 << self.bits) - 1), np.uint64(self.bits)
        return [((hashes >> (step * np.uint64(i))) & mask).astype(np.int64) for i in range(HASHES)]

    def hits(self, hashes: np.ndarray, rows: np.ndarray, n_rows: int) -> np.ndarray:
        """n_rows x languages: how many of a row's n-grams each language has, by popcounts of the masks' bits."""
        out = np.zeros((n_rows, len(self.languages)))
        slots = self._slots(hashes)
        for word, plane in enumerate(self.planes):
            mask = plane[slots[0]]
            for slot in slots[1:]:
                mask &= plane[slot]
            for i in range(64 * word, min(64 * (word + 1), len(self.languages))):
                out[:, i] = np.bincount(rows, ((mask >> np.uint64(i % 64)) & np.uint64(1)).astype(np.float64), n_rows)
        return out

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        has_letter = pc.match_substring_regex(column.fill_null(""), r"\p{L}").to_numpy(zero_copy_only=False)
        if not self.languages:
            return [UNDECIDED] * len(column), np.zeros(len(column))
        found, total = np.zeros((len(column), len(self.languages))), np.zeros(len(column))
        for plain, of, lead in units(column, SLICE):
            for n in ORDERS:  # one order at a time: memory for one hash of each character
                hashes, rows = ngrams(plain, n, lead)
                found[of] += self.hits(hashes, rows, len(plain))
                total[of] += np.bincount(rows, minlength=len(plain))
        share = np.clip((found / np.maximum(total, 1)[:, None] - self.false_rate) / np.maximum(1 - self.false_rate, 1e-9), 0, 1)
        best = share.argmax(axis=1)
        score = np.where(has_letter, share[np.arange(len(column)), best], 0.0)
        return [self.languages[b] if ok else UNDECIDED for b, ok in zip(best, has_letter, strict=True)], score


def train(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = TRAIN_DOCS, most_languages: int = MOST_LANGUAGES) -> BitSlicedBloom:
    """Learn profiles from labelled rows (null labels are left out).

    The classifier is fitted on a bounded sample. Of each language, rows whose id hash falls under per_language / (rows of
    the language) are taken: all if there are no more, about per_language else. Where labels are dirty, the most_languages
    most frequent ones are learned. Profiles have at most orders / PROFILE_SHARE entries a language, so they fit the driver.
    """
    spark = labelled.sparkSession
    d = labelled.filter(F.col(lang_col).isNotNull()).select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    most = d.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages).collect()
    languages = sorted(r["lang"] for r in most)
    index = {lang: i for i, lang in enumerate(languages)}
    taken = spark.createDataFrame([(r["lang"], index[r["lang"]], min(1 << 30, int((1 << 30) * per_language / r["n"]))) for r in most], "lang string, number int, upto long")
    d = d.join(F.broadcast(taken), "lang").filter(F.pmod(F.xxhash64("id", F.lit("train")), F.lit(1 << 30)) < F.col("upto")).select("text", "number")

    def count(batches):
        parts = []

        def flush():
            for n in ORDERS:
                mine = [p[1] for p in parts if p[0] == n]
                if mine:
                    t = pa.concat_tables(mine).group_by(["lang", "gram"], use_threads=False).aggregate([("n", "sum")])
                    yield from pa.table({"size": pa.array(np.full(t.num_rows, n, np.int32)), "lang": t["lang"], "gram": t["gram"], "n": t["n_sum"]}).to_batches()
            parts.clear()

        rows_held = 0
        for batch in slices(batches, "text", SLICE):
            lang_of = batch.column("number").to_numpy()
            for plain, of, lead in units(batch.column("text"), SLICE):
                mine = lang_of[of]
                for n in ORDERS:
                    h, rows = ngrams(plain, n, lead)
                    for lang in np.unique(mine):
                        gram, c = np.unique(h[mine[rows] == lang], return_counts=True)
                        parts.append((n, pa.table({"lang": pa.array(np.full(len(gram), lang, np.int32)), "gram": gram.view(np.int64), "n": c})))
                        rows_held += len(gram)
            if rows_held > 500_000:
                yield from flush()
                rows_held = 0
        yield from flush()

    grams = d.mapInArrow(count, "size int, lang int, gram long, n long").groupBy("size", "lang", "gram").agg(F.sum("n").alias("n"))
    grams = grams.filter(F.col("n") > 1)
    # The share is taken of the n-grams of the same order; their totals come from one more sum over the counted n-grams.
    grams = grams.persist()
    totals = grams.groupBy("size", "lang").agg(F.sum("n").alias("total"))  # a row for each language and order
    least = F.greatest(F.lit(2), F.floor(F.col("total") * PROFILE_SHARE))
    profile = grams.join(F.broadcast(totals), ["size", "lang"]).filter(F.col("n") >= least).select("gram", "lang").toArrow()
    grams.unpersist()
    return BitSlicedBloom(languages, profile["gram"].to_numpy().view(np.uint64), profile["lang"].to_numpy().astype(np.int64))


def identify(docs: DataFrame, model: BitSlicedBloom, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred and score of every row of docs, from each whole text.

    score is the share of the text's n-grams in the predicted language's profile, less the filter's false-positive rate.
    Null text and text without a letter: `und`, 0. Ties go to the first language by code point. Texts of any length are
    taken part by part, in bounded memory. Nothing else of a row is used; repeated rows are answered alike.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches):
        for batch in slices(batches, "text", SLICE):
            lang, score = shared.value.predict(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(predict, f"doc_id {docs.schema[id_col].dataType.simpleString()}, lang_pred string, score double")


def predict_languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score for `documents`: learned from rows outside the held-out third that have a lang.

    Null text and text without a letter are `und` with score 0, and so is every text if there is no labelled row. Null ids
    and repeated rows give a row each; a null id is not held out. Other columns are ignored; an empty table gives none.
    """
    held_out = F.coalesce(split_of("doc_id", 3) == 1, F.lit(False))
    model = train(docs.filter(~held_out))
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, least_score: float = 0.3) -> DataFrame:
    """The rows of docs whose language is told: not those without a letter, nor those of which under least_score of the
    n-grams are in the predicted language's profile. All columns stay, whatever their names. The model is learned from docs
    themselves; where they teach no language (no labels, or none outside the held-out third), every text with a letter is
    kept. Null and empty texts go; rows with null ids and repeated rows are judged by their texts like others; an empty
    table stays empty; long texts are taken whole, part by part.
    """
    model = train(docs.filter(F.coalesce(split_of("doc_id", 3) != 1, F.lit(True))))
    if not any(plane.any() for plane in model.planes):
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def told():
        def mask(batch):
            lang, score = shared.value.predict(batch.column("text"))
            return np.array([x != UNDECIDED for x in lang], bool) & (score >= least_score)

        return mask

    return filtered(docs, "text", told, SLICE)
