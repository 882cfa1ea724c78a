"""Target-distribution importance resampling: hashed n-gram features out of word-id suffix arrays, and a Gumbel top k."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, slices, words_of

#: What separates words: all of ASCII but digits and letters.
BREAKS = np.zeros(256, bool)
BREAKS[[*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]] = True


def suffix_order(ids: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """Places of word ids in the order of the (up to depth) words that begin there; left: words from a place to its text's end.

    Ranks by one word become ranks by two, four and more, each from pairs of the ranks before; a text's end comes first.
    """
    rank, seen = ids.astype(np.int64) + 1, 1
    while seen < depth:
        step = min(seen, depth - seen)
        after = np.zeros_like(rank)
        on = np.flatnonzero(left > step)
        after[on] = rank[on + step]
        order = np.lexsort((after, rank))
        new = np.append(False, (rank[order][1:] != rank[order][:-1]) | (after[order][1:] != after[order][:-1]))[: len(order)]
        rank = np.empty_like(rank)
        rank[order] = np.cumsum(new) + 1
        seen += step
    return np.argsort(rank, kind="stable")


def runs(ids: np.ndarray, left: np.ndarray, depth: int):
    """For n of 1 to depth: n, the places where n-grams begin, run by run of equal ones, and the place in them where each run
    begins. Runs are read off the lengths of the prefixes that neighbours in suffix order share."""
    order = suffix_order(ids, left, depth)
    shared = np.append(False, np.ones(max(0, len(order) - 1), bool))[: len(order)]  # the first n - 1 words with the place before
    for n in range(1, depth + 1):
        whole = left[order] >= n
        at = order[whole]
        word = ids[np.minimum(order + n - 1, max(0, len(ids) - 1))]
        shared = shared & whole & np.append(False, (word[1:] == word[:-1]) & whole[:-1])[: len(order)]
        yield n, at, np.flatnonzero(~shared[whole])


def bucket_features(words: list[bytes], ids: np.ndarray, bounds: np.ndarray, depth: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams (n up to depth) of texts, text by text, and the number of them before each text.

    words[ids[i]] is the i-th word, bounds the number of words before each text. An n-gram's bucket is the crc32 of its words
    joined by one space; it is worked out once for each run of equal n-grams and scattered to their places.
    """
    size = np.diff(bounds)
    left = np.repeat(bounds[1:], size) - np.arange(len(ids))
    text = np.repeat(np.arange(len(size)), size)
    grams = np.minimum(np.maximum(size[:, None] - np.arange(depth), 0), size[:, None])  # of each text, by n
    upto = np.append(0, np.cumsum(grams.sum(axis=1)))
    before = np.append(np.zeros((len(size), 1), np.int64), np.cumsum(grams, axis=1)[:, :-1], axis=1)
    out = np.empty(upto[-1], np.int32)
    for n, at, first in runs(ids, left, depth):
        heads = at[first]
        hashed = np.fromiter((zlib.crc32(b" ".join([words[w] for w in ids[i : i + n]])) % buckets for i in heads), np.int32, len(heads))
        place = upto[text[at]] + before[text[at], n - 1] + at - bounds[text[at]]
        out[place] = np.repeat(hashed, np.diff(np.append(first, len(at))))
    return out, upto


def features(docs: DataFrame, depth: int, buckets: int, text_col: str, *carried: Column) -> DataFrame:
    """The carried columns with n_words and buckets (array<int>, one entry for each n-gram) of each text."""
    d = docs.select(F.struct(*carried).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches):
        for batch in slices(batches, "text"):
            words, bounds = words_of(batch.column("text"), True, BREAKS)
            coded = words.dictionary_encode()
            distinct = coded.dictionary.cast(pa.large_binary()).to_pylist()
            found, upto = bucket_features(distinct, coded.indices.to_numpy(zero_copy_only=False), bounds, depth, buckets)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(np.diff(bounds)), pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(found))], names=["row", "n_words", "buckets"])

    out = d.mapInArrow(run, d.select("row", F.lit(0).cast("long").alias("n_words"), F.lit(None).cast("array<int>").alias("buckets")).schema)
    return out.select("row.*", "n_words", "buckets")


def _counted(found: DataFrame, name: str) -> DataFrame:
    return found.select(F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias(name))


def bucket_gains(found: DataFrame, target: DataFrame, buckets: int) -> DataFrame:
    """(bucket, gain) of every bucket: how much likelier it is in the target, with one more of each, in floored thousandths of
    a natural logarithm."""
    both = found.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(_counted(found, "s"), "bucket", "left").join(_counted(target, "t"), "bucket", "left").na.fill(0, ["s", "t"])
    sums = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))  # one row
    ratio = (F.col("t") + 1.0) * (F.col("all_s") + float(buckets)) / ((F.col("s") + 1.0) * (F.col("all_t") + float(buckets)))
    return both.crossJoin(F.broadcast(sums)).select("bucket", F.floor(F.log(ratio) * 1000.0).alias("gain"))


def resample(docs: DataFrame, target: DataFrame, depth: int = 1, buckets: int = 10_000, least_words: int = 20, percent: int = 10, seed: int = 2024, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text") -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row: draws `percent` of the rows with least_words words, without
    putting any back, by how likely the target makes their n-grams.

    1. Each task takes the words of a slice of texts (A-Z in lower case) as ids, sorts their suffixes by `depth` words and
       hashes each run of equal n-grams once; the buckets of all occurrences are written, beside the row, for the next steps.
    2. Buckets are counted over docs and target; a bucket's gain is a logarithm of its shares' ratio (`bucket_gains`). There
       are `buckets` of them whatever docs holds, and these go to all workers.
    3. weight is the floored mean of a row's gains, score adds Gumbel noise made of a hash of seed and id, so the rows of
       highest score are a draw by weight, and reruns agree. Rows are dealt into ranges of score and numbered there; ties go
       to the smaller id, null ids last. No task holds more than a range, equal scores and ids included.

    Null and empty texts have no features and weight 0. A null id is hashed as the word null. Repeated rows count as often as
    they come, and take ranks one after the other. A text of any length is one row's work; other columns are ignored,
    whatever their names. An empty table gives none; with an empty target all gains come from docs alone.
    """
    found = materialize(features(docs, depth, buckets, text_col, F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("nth")), "features")
    aim = features(target, depth, buckets, target_col, F.lit(0).alias("doc_id"))
    gains = np.zeros(buckets, np.int64)
    for r in bucket_gains(found, aim, buckets).collect():  # as many rows as buckets
        gains[r.bucket] = r.gain
    known = docs.sparkSession.sparkContext.broadcast(gains)

    def weigh(batches):
        gain = known.value
        for batch in batches:
            lists = batch.column("buckets")
            n = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            upto = np.append(0, np.cumsum(gain[lists.flatten().to_numpy(zero_copy_only=False)]))
            bounds = np.append(0, np.cumsum(n))
            weight = (upto[bounds[1:]] - upto[bounds[:-1]]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("nth"), batch.column("n_words"), pa.array(n), pa.array(weight)], names=["doc_id", "nth", "n_words", "n_features", "weight"])

    weighed = found.mapInArrow(weigh, "doc_id long, nth long, n_words long, n_features long, weight long")
    drawn = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.log(-F.log((drawn + 0.5) / 4294967296.0)) * -1000.0)
    scored = weighed.withColumn("score", F.col("weight") + noise)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("nth").asc()]
    in_turn = scored.filter(F.col("n_words") >= least_words).repartitionByRange(*order).sortWithinPartitions(*order)
    # Numbers rise within a range from its own multiple of 2^33 on.
    in_turn = materialize(in_turn.withColumn("at", F.monotonically_increasing_id()).drop("nth", "n_words"), "ranges")
    in_turn = in_turn.withColumns({"range": F.shiftright("at", 33), "within": F.col("at").bitwiseAND(F.lit(2**33 - 1))})
    before = Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # over a row for each range
    offsets = in_turn.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    most = in_turn.count() * percent // 100
    rank = F.col("offset") + F.col("within") + 1
    columns = ["doc_id", "n_features", "weight", "score"]
    ranked = in_turn.join(F.broadcast(offsets), "range").select(*columns, F.when(rank <= most, rank).alias("rank"))
    return ranked.unionByName(scored.filter(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("long").alias("rank")))


_TABLE = "lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
_BYTES = "list_transform(range(0, octet_length(encode(w))), lambda i: CAST('0x' || substr(hex(encode(w)), 2 * i + 1, 2) AS BIGINT))"
_CRC = f"xor(list_reduce([4294967295::BIGINT] || {_BYTES}, lambda c, b: list_reduce([xor(c, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], {_TABLE})), 4294967295::BIGINT)"
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
#: The same for single words and the parameters of the query.
SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS words FROM documents),
x AS (SELECT r, unnest(words) AS w FROM d), y AS (SELECT unnest({_WORDS}) AS w FROM benchmark),
hashed AS (SELECT w, {_CRC} % 10000 AS bucket FROM (SELECT w FROM x UNION SELECT w FROM y)),
s AS (SELECT bucket, count(*) AS n FROM x JOIN hashed USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM y JOIN hashed USING (w) GROUP BY bucket),
sums AS (SELECT (SELECT coalesce(sum(n), 0) FROM s)::DOUBLE AS all_s, (SELECT coalesce(sum(n), 0) FROM t)::DOUBLE AS all_t),
gains AS (SELECT s.bucket, floor(1000 * ln((coalesce(t.n, 0) + 1) * (all_s + 10000) / ((s.n + 1) * (all_t + 10000)))) AS gain FROM s LEFT JOIN t USING (bucket), sums),
weights AS (SELECT r, floor(sum(gain) / count(*))::BIGINT AS weight FROM x JOIN hashed USING (w) JOIN gains USING (bucket) GROUP BY r),
scored AS (SELECT r, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN weights USING (r)),
ranked AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= n * 10 // 100 THEN rank END AS rank FROM scored LEFT JOIN ranked USING (r)
"""
