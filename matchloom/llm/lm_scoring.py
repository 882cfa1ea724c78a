"""Language-model scoring by a weighted backoff automaton over smoothed word n-grams."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_strings, materialize, release, slices, split_of, words_of

#: Highest order of the model's n-grams.
ORDER = 3
#: Weight of the next shorter n-gram in the estimate of one of two, three, ... words: so many occurrences of the history.
PRIOR = (1000.0, 20.0)
#: The end of a text as a word; no word has white space.
END = "\n"
#: Text bytes of a block, the unit that is counted and scored at once; longer texts are cut into pieces.
BLOCK_BYTES = 8_000_000
#: Text bytes of which words are found at once.
SLICE_BYTES = 2_000_000
#: Bits of an n-gram's hash: of n distinct n-grams, n * n / 2**57 pairs share one (a tenth of a pair in 10**8).
KEY_BITS = 56
#: n-grams that one bucket of the count holds, about, and text bytes for each distinct n-gram of a block, about.
BUCKET_ENTRIES, BYTES_AN_ENTRY = 2_000_000, 4

END_HASH = hash_strings(pa.array([END]))
PACKED = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("context", pa.int64()), ("ended", pa.bool_()), ("text", pa.large_string())])


# --- blocks: some megabytes of texts as one compressed value


def cut(text: str, limit: int, context: int) -> list[tuple[int, bool, str]]:
    """(words of context, whether it ends the text, piece): pieces of about `limit` bytes, each led by the last words before."""
    if len(text) <= limit // 4 or len(data := text.encode()) <= limit:
        return [(0, True, text)]
    out, start, lead = [], 0, []
    while True:
        end = min(start + limit, len(data))
        while end < len(data) and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        piece = b" ".join([*lead, data[start:end]])
        out.append((len(lead), end == len(data), piece.decode()))
        if end == len(data):
            return out
        start, lead = end, piece.rsplit(None, context)[-context:] if context else []
        lead = [w for w in lead if w.strip()]


def _pack(context: int, limit: int):
    def pack(batches):
        held: list[tuple] = []
        size = 0

        def block():
            columns = [pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), PACKED, strict=True)]
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, PACKED, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_batch(pa.RecordBatch.from_arrays(columns, schema=PACKED))
            return pa.RecordBatch.from_arrays([pa.array([uuid.uuid4().int >> 65]), pa.array([size], pa.int64()), pa.array([sink.getvalue().to_pybytes()])], names=["block", "bytes", "docs"])

        for batch in slices(batches, "text", limit):
            for row, doc_id, held_out, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for lead, ended, piece in cut(text or "", limit, context):
                    held.append((row, doc_id, held_out, lead, ended, piece))
                    size += len(piece) + 8
                    if size >= limit:
                        yield block()
                        held, size = [], 0
        if held:
            yield block()

    return pack


def _texts_of(docs: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(pa.py_buffer(docs)).read_next_batch()


def coded(texts: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of each piece, with the end where it ends its text, and bounds."""
    hashes, lengths = [], []
    for part in slices([texts], "text", SLICE_BYTES):
        words, bounds = words_of(part.column("text"), lower=True)
        d = words.dictionary_encode()
        ended = part.column("ended").to_numpy(zero_copy_only=False)
        starts = bounds + np.concatenate([[0], np.cumsum(ended)])
        h = np.full(int(starts[-1]), END_HASH[0], np.uint64)
        h[np.arange(len(words)) + np.repeat(starts[:-1] - bounds[:-1], np.diff(bounds))] = hash_strings(d.dictionary)[d.indices.to_numpy()]
        hashes.append(h)
        lengths.append(np.diff(starts))
    return np.concatenate(hashes), np.concatenate([[0], np.cumsum(np.concatenate(lengths))])


class Grams:
    """The distinct n-grams of a block, by sorted hashes of KEY_BITS bits (odd for words, even for longer ones), and where they are.

    at[n - 1][j] is the number of the n-gram that ends at token j, -1 where the text has fewer words before j.
    """

    def __init__(self, texts: pa.RecordBatch, order: int):
        hashes, self.starts = coded(texts)
        lengths = np.diff(self.starts)
        self.text = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
        before = np.arange(len(hashes), dtype=np.int32) - np.repeat(self.starts[:-1].astype(np.int32), lengths)
        #: Tokens that are counted and scored: all but a piece's words of context.
        self.own = before >= np.repeat(texts.column("context").to_numpy(), lengths)
        shift = np.uint64(64 - KEY_BITS)
        n_places = [int((before >= n).sum()) for n in range(order)]
        merged, end = np.empty(sum(n_places), np.uint64), len(hashes)
        merged[:end] = (hashes >> shift) | np.uint64(1)
        last = hashes
        for n in range(1, order):
            longer = np.zeros(len(hashes), np.uint64)
            with np.errstate(over="ignore"):
                longer[1:] = _mixed(last[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:] + np.uint64(n))
            merged[end : end + n_places[n]] = (longer[before >= n] >> shift) & ~np.uint64(1)
            end, last = end + n_places[n], longer
        del hashes, last
        by_key = np.argsort(merged)
        merged = merged[by_key]
        first = np.concatenate([[True], merged[1:] != merged[:-1]])
        self.keys = merged[first]
        del merged
        number = np.empty(len(by_key), np.int32)
        number[by_key] = np.cumsum(first, dtype=np.int32) - 1
        del by_key, first
        self.at, begin = [], 0
        for n in range(order):
            at = np.full(len(before), -1, np.int32)
            at[before >= n] = number[begin : begin + n_places[n]]
            self.at.append(at)
            begin += n_places[n]

    def counts(self, learned: np.ndarray) -> np.ndarray:
        """Occurrences of each n-gram at the own tokens of the texts to learn from."""
        use = self.own & learned[self.text]
        out = np.zeros(len(self.keys), np.int64)
        for at in self.at:
            out += np.bincount(at[use & (at >= 0)], minlength=len(out))
        return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


# --- counts: packed lists of n-grams go to buckets of their keys, and the corpus's counts come back in the same order


def packed(values: np.ndarray) -> bytes:
    """Unsigned numbers byte plane by byte plane, compressed: small ones and sorted hashes' steps take few bytes."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return len(values).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes.tobytes(), asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(pa.Codec("zstd").decompress(data[8:], 8 * n, asbytes=True) if n else b"", np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).reshape(-1).view("<u8")


def _bounds(keys: np.ndarray, n_buckets: int) -> np.ndarray:
    """Where each bucket starts in sorted keys: buckets are equal ranges of all keys."""
    edges = np.array([i * (1 << KEY_BITS) // n_buckets for i in range(1, n_buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _count(order: int, n_buckets: int):
    def count(batches):
        for batch in batches:
            for block, docs in zip(batch.column("block").to_pylist(), batch.column("docs"), strict=True):
                texts = _texts_of(docs.as_py())
                grams = Grams(texts, order)
                counts = grams.counts(~texts.column("held_out").to_numpy(zero_copy_only=False))
                bounds = _bounds(grams.keys, n_buckets)
                rows = []
                for bucket, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)):
                    if hi > lo:
                        rows.append((block, bucket, packed(np.diff(grams.keys[lo:hi], prepend=np.uint64(0))), packed(counts[lo:hi])))
                for i in range(0, len(rows), 500):
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[i : i + 500], strict=True), (pa.int64(), pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["block", "bucket", "keys", "counts"])

    return count


def _total(t: pa.Table) -> pa.Table:
    """One bucket: for each block's list, what each of its n-grams has in all blocks; and the bucket's words and tokens, once."""
    lists = [np.cumsum(unpacked(x.as_py()), dtype=np.uint64) for x in t["keys"]]
    keys, counts = np.concatenate(lists), np.concatenate([unpacked(x.as_py()) for x in t["counts"]])
    order = np.argsort(keys)
    sorted_ = keys[order]
    first = np.flatnonzero(np.concatenate([[True], sorted_[1:] != sorted_[:-1]]))
    sums = np.add.reduceat(counts[order], first)
    word = sums[(sorted_[first] & np.uint64(1)).astype(bool)]
    total = np.empty(len(keys), np.uint64)
    total[order] = np.repeat(sums, np.diff(np.append(first, len(keys))))
    ends = np.cumsum([len(x) for x in lists])
    back = [packed(x) for x in np.split(total, ends[:-1])]
    once = [None] * (len(back) - 1)
    return pa.table({"block": t["block"], "bucket": t["bucket"], "counts": pa.array(back, pa.binary()), "words": pa.array([int((word > 0).sum()), *once], pa.int64()), "tokens": pa.array([int(word.sum()), *once], pa.int64())})


# --- the automaton


class Automaton:
    """States are word histories; an arc reads a word with a weight (log10 of its smoothed probability), and a state
    without an arc for the word takes its failure arc to the history less its first word, for the state's backoff weight.

    State 0 is the empty history, with an arc for every word; any n-gram of up to order - 1 words that training texts hold
    is a state, any longer or equal one an arc. An automaton has the part of the model that one block of texts can reach.
    Weights: p(w | h) = (c(hw) + prior * p(w | h less its first word)) / (c(h) + prior), which sums to 1 over all words, the
    end and one unknown word, as every n-gram is counted; so an arc has that weight, and a failure prior / (c(h) + prior).
    """

    def __init__(self, grams: Grams, counts: np.ndarray, tokens: int, words: int, prior: tuple[float, ...] = PRIOR):
        self.grams, n = grams, len(grams.keys)
        self.count = np.append(counts.astype(np.float64), 0.0)  # the last entry stands for "no such n-gram"
        #: Probability and log10 weight of the arc of each n-gram, and weight of the failure arc of each as a state.
        self.p, self.weight, self.backoff = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
        lower = None
        for k, at in enumerate(grams.at):
            here = np.flatnonzero(at >= 0)
            gram = at[here]
            if k == 0:
                self.p[gram] = (self.count[gram] + 1) / (tokens + words + 1)
            else:
                history = grams.at[k - 1][here - 1]
                self.p[gram] = (self.count[gram] + prior[k - 1] * self.p[lower[here]]) / (self.count[history] + prior[k - 1])
            if k < len(prior):
                self.backoff[gram] = np.log10(prior[k] / (self.count[gram] + prior[k]))
            lower = at
        self.weight[:n] = np.log10(self.p[:n])

    def run(self) -> np.ndarray:
        """log10 probability that the traversal adds at each token.

        The state after a token is its longest n-gram that is a state, whatever the state before, so all tokens go from
        their states at once: time is linear in them, however long a text is. From its state a token follows failure arcs
        until a state has an arc for its word; the empty history has one for every word.
        """
        at, n = self.grams.at, len(self.grams.keys)
        add = np.zeros(len(at[0]))
        open_ = np.ones(len(add), bool)
        for k in range(len(at) - 1, 0, -1):
            # histories of k words: state if training texts hold it
            state = np.full(len(add), n)
            state[1:] = np.where(at[k][1:] >= 0, at[k - 1][:-1], n)
            in_state = open_ & (self.count[state] > 0)
            arc = in_state & (self.count[at[k]] > 0)
            add[arc] += self.weight[at[k][arc]]
            failed = in_state & ~arc
            add[failed] += self.backoff[state[failed]]
            open_ &= ~arc
        add[open_] += self.weight[at[0][open_]]
        return add


SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _score(tokens: int, words: int, order: int, prior: tuple[float, ...]):
    def score(blocks: pa.Table, replies: pa.Table) -> pa.Table:
        texts = _texts_of(blocks["docs"][0].as_py())
        grams = Grams(texts, order)
        replies = replies.sort_by("bucket")
        counts = np.concatenate([unpacked(x.as_py()) for x in replies["counts"]]) if replies.num_rows else np.zeros(0, np.uint64)
        model = Automaton(grams, counts, tokens, words, prior)
        own, size = grams.own, texts.num_rows
        of = grams.text[own]
        word = grams.at[0][own]
        sums = [np.bincount(of, x, size) for x in (model.weight[word], model.run()[own])]
        known = np.bincount(of[model.count[word] > 0], minlength=size)
        return pa.table([*(texts.column(c) for c in ("row", "doc_id", "held_out")), pa.array(np.bincount(of, minlength=size)), pa.array(known), *map(pa.array, sums)], names=["row", "doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return score


def score_texts(docs: DataFrame, held_out, order: int = ORDER, prior: tuple[float, ...] = PRIOR, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every whole text; see `score_documents`.

    held_out: a boolean column, true for rows that the model does not learn from.

    1. Texts are packed into blocks. A block's distinct n-grams go, as sorted and packed hashes with their counts, to
       buckets of equal ranges of hashes; as each block sends an n-gram once, no bucket is hot.
    2. A bucket adds the counts up and answers every block with the corpus's counts of its n-grams, in the same order.
    3. Each block builds the part of the automaton that its texts can reach and runs it over them.

    So the model is all n-grams of all training texts, at every size, and nothing of it is broadcast or gathered.
    """
    d = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    blocks = materialize(d.mapInArrow(_pack(order - 1, block_bytes), "block long, bytes long, docs binary"), "lm-blocks")
    total = blocks.agg(F.sum("bytes")).first()[0] or 0
    n_buckets = max(1, -(-total // (BYTES_AN_ENTRY * BUCKET_ENTRIES)))
    lists = blocks.mapInArrow(_count(order, n_buckets), "block long, bucket int, keys binary, counts binary")
    replies = materialize(lists.groupBy("bucket").applyInArrow(_total, "block long, bucket int, counts binary, words long, tokens long"), "lm-counts")
    words, tokens = (x or 0 for x in replies.agg(F.sum("words"), F.sum("tokens")).first())
    release(docs.sparkSession)
    mine = replies.select("block", "bucket", "counts").groupBy("block")
    pieces = blocks.select("block", "docs").groupBy("block").cogroup(mine).applyInArrow(_score(tokens, words, order, prior), SCORED)
    sums = pieces.groupBy("row").agg(*[F.first(c).alias(c) for c in ("doc_id", "held_out")], *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    return sums.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")


def score_documents(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for `documents`.

    Tokens are the words of a text (A-Z in lower case) and its end. The model interpolates n-grams of up to `order` words
    (Dirichlet priors, `PRIOR`) down to the add-one unigram of the base score, learned from all n-grams of all texts
    outside the held-out part. Null text has its end alone. Null ids (not held out) and repeated rows each give a row and
    count each time. Texts of any length are cut into pieces that know the words before them, so a long one is several
    blocks' work; the sums are those of the whole. Without training texts every token is unknown, with score 0. Other
    columns are ignored, whatever their names; an empty table gives none.
    """
    return score_texts(docs, split_of("doc_id", 7) == 2, order)


_TABLE = "lambda a, k: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
_CRC = f"xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: ascii(x)::BIGINT), lambda c, b: list_reduce([xor(c, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], {_TABLE})), 4294967295::BIGINT)"
#: The same by interpolating counts at every token, without states.
SQL = f"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce({_CRC} % 7 = 2, false) AS held_out,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') || [chr(10)] AS words FROM documents),
u AS (SELECT r, held_out, unnest(words) AS w, generate_subscripts(words, 1) AS i FROM t),
g AS (SELECT *, lag(w, 1) OVER o AS w1, lag(w, 2) OVER o AS w2 FROM u WINDOW o AS (PARTITION BY r ORDER BY i)),
c1 AS (SELECT w, count(*) AS n FROM g WHERE NOT held_out GROUP BY 1),
c2 AS (SELECT w1, w, count(*) AS n FROM g WHERE NOT held_out AND w1 IS NOT NULL GROUP BY 1, 2),
c3 AS (SELECT w2, w1, w, count(*) AS n FROM g WHERE NOT held_out AND w2 IS NOT NULL GROUP BY 1, 2, 3),
s AS (SELECT coalesce(sum(n), 0)::BIGINT AS tokens, count(*) AS words FROM c1),
k AS (SELECT g.r, coalesce(a.n, 0) AS n1, coalesce(b.n, 0) AS n2, coalesce(c.n, 0) AS n3, coalesce(h.n, 0) AS h1, coalesce(hh.n, 0) AS h2, g.w1 IS NOT NULL AS two, g.w2 IS NOT NULL AS three
  FROM g LEFT JOIN c1 a ON a.w = g.w LEFT JOIN c2 b ON b.w1 = g.w1 AND b.w = g.w LEFT JOIN c3 c ON c.w2 = g.w2 AND c.w1 = g.w1 AND c.w = g.w LEFT JOIN c1 h ON h.w = g.w1 LEFT JOIN c2 hh ON hh.w1 = g.w2 AND hh.w = g.w1),
p1 AS (SELECT *, (n1 + 1)::DOUBLE / (tokens + words + 1) AS p1 FROM k, s),
p2 AS (SELECT *, CASE WHEN two THEN (n2 + {PRIOR[0]!r}::DOUBLE * p1) / (h1 + {PRIOR[0]!r}::DOUBLE) ELSE p1 END AS p2 FROM p1),
p3 AS (SELECT *, CASE WHEN three THEN (n3 + {PRIOR[1]!r}::DOUBLE * p2) / (h2 + {PRIOR[1]!r}::DOUBLE) ELSE p2 END AS p3 FROM p2),
e AS (SELECT r, count(*) AS n_tokens, count(*) FILTER (n1 > 0) AS n_known, any_value(tokens) AS train_tokens, sum(log10(p1)) AS base_score, sum(log10(p3)) AS score FROM p3 GROUP BY 1)
SELECT doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score FROM t JOIN e ON t.r = e.r
"""
