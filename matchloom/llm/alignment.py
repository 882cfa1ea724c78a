"""Alignment of two tokenizers' tokens over the same bytes: Python tokenises, Spark's array functions align."""

from __future__ import annotations

import hashlib
import json
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_rows, materialize, release, slices, text_offsets
from .lexicon import count_entries, hot_from
from .sentence_pieces import Merges, load_pieces
from .token_counts import SPACE_MARK, pretokens_of

#: Text bytes that are tokenised at a time, and those of a pack of texts whose units are looked up together.
SLICE, PACK_BYTES = 1_000_000, 2_500_000
#: Units that are sent to every worker, the most frequent ones. Texts whose groups are put together at a time.
MOST_UNITS, DIGESTED = 600_000, 500
#: What is known of a unit: sums over its tokens, groups and links, and the groups as text.
FACTS = ["n_a", "n_b", "n_groups", "n_best", "count_sum", "groups"]
#: Pairs with at least this share of all links are sent to every worker: half a million of them at most.
HOT_PAIR = 1 / 500_000
_loaded: dict[str, "ByteLevel"] = {}


def byte_of_char() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, others from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """A byte-level byte-pair tokenizer of the tokenizers library; files that read texts otherwise are refused by their flags.

    Texts are cut into units before single spaces between other characters: its pattern always begins a token there, and no
    rule looks back or ahead over such a place, so units are encoded alone and distinct ones once. Units of letters, digits,
    signs and single spaces are split by the classes of their bytes and merged in rounds; the library itself encodes others
    (apostrophes, runs of white space, further scripts).
    """

    #: Classes of bytes: 0 for what the library splits.
    SPACE, LETTER, DIGIT, SIGN, BREAK = 1, 2, 3, 4, 5

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallel ones
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            form = json.load(f)
        split, model = form.get("pre_tokenizer") or {}, form.get("model") or {}
        flags = {
            "not byte-pair": model.get("type") != "BPE", "dropout": model.get("dropout"), "marks of word ends or parts": model.get("end_of_word_suffix") or model.get("continuing_subword_prefix"), "a normaliser": form.get("normalizer"),
            "whole words before merges": model.get("ignore_merges"), "not byte-level": split.get("type") != "ByteLevel" or not split.get("use_regex", True), "a space of its own": split.get("add_prefix_space"),
            "added tokens that are not special": any(not t["special"] for t in form.get("added_tokens", [])),
        }
        if found := [what for what, wrong in flags.items() if wrong]:
            raise ValueError(f"{path} cannot be encoded unit by unit: {', '.join(found)}")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        byte_of, ids = byte_of_char(), model["vocab"]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.bytes_of = [b""] * (max(vocabulary.values()) + 1)
        for entry, i in vocabulary.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.merges = Merges({(ids[x], ids[y]): (rank, ids[x + y]) for rank, (x, y) in reversed([*enumerate(pairs)])}, len(self.bytes_of) + 1)
        self.symbol_of = np.array([ids[c] for c, _ in sorted(byte_of.items(), key=lambda e: e[1])], np.int32)
        self.kind = np.zeros(256, np.int8)
        self.kind[0x20], self.kind[[0x09, 0x0A, 0x0D]] = self.SPACE, self.BREAK
        for b in range(0x21, 0x7F):
            self.kind[b] = self.LETTER if chr(b).isalpha() else self.DIGIT if chr(b).isdigit() else 0 if chr(b) == "'" else self.SIGN

    def split(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All units of the texts (each after a space) as one array, and for each text the number of units before it."""
        at, raw = text_offsets(with_space(texts))
        lead = (raw >= 0xC3) & (raw < 0xE0)  # of two bytes, none of them a space of any kind
        plain = (raw > 0x20) & (raw < 0x7F)
        ends = plain | np.append(False, lead[:-1])[: len(raw)] & ((raw & 0xC0) == 0x80)
        begins = plain | lead | (raw >= 0xE4)
        first = np.zeros(len(raw), bool)
        if len(raw):
            first[1:-1] = (raw[1:-1] == 0x20) & ends[:-2] & begins[2:]
            border = at[1:-1][(at[1:-1] > 0) & (at[1:-1] < len(raw))]
            first[border - 1] = False  # a space that ends a text
            first[at[:-1][at[:-1] < at[1:]]] = True
        starts = np.flatnonzero(first)
        offsets = np.append(starts, len(raw)).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw))), np.searchsorted(starts, at)

    def encode(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        at, raw = text_offsets(units)
        unit = np.repeat(np.arange(len(units), dtype=np.int32), np.diff(at))
        kind = self.kind[raw]
        letters = (raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] != 0x97) & (raw[1:] != 0xB7)  # of two bytes, from A grave on
        kind[:-1][letters] = self.LETTER
        kind[1:][letters] = self.LETTER
        same = np.append(False, unit[1:] == unit[:-1])[: len(unit)]
        blank = (kind == self.SPACE) | (kind == self.BREAK)
        hard = (kind == 0) | (same & blank & np.append(False, blank[:-1])[: len(unit)])
        last = np.append(~same[1:], True)[: len(unit)]
        easy = np.bincount(unit[hard | (last & (kind == self.SPACE) & same)], minlength=len(units)) == 0
        before = np.append(0, kind[:-1])[: len(unit)]
        begins = ~same | ((kind != before) & (before != self.SPACE)) | (kind == self.BREAK)
        mine = np.flatnonzero(easy[unit])
        symbols, owner = self.symbol_of[raw[mine]], unit[mine]
        left = self.merges.merge(symbols, np.cumsum(begins[mine], dtype=np.int32))
        symbols, owner = symbols[left], owner[left]
        rest = np.flatnonzero(~easy)
        found = [e.ids for e in self.tokenizer.encode_batch_fast(units.take(pa.array(rest)).to_pylist(), add_special_tokens=False)] if len(rest) else []
        counts = np.bincount(owner, minlength=len(units)).astype(np.int64)
        counts[rest] = [len(x) for x in found]
        offsets = np.append(0, np.cumsum(counts))
        out = np.empty(offsets[-1], np.int32)
        by_rounds = np.repeat(easy, counts)
        out[by_rounds] = symbols
        out[~by_rounds] = [i for ids in found for i in ids]
        return out, offsets


def with_space(texts: pa.Array) -> pa.Array:
    """A space before each text that is not empty."""
    return pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, pc.binary_join_element_wise(pa.scalar(" ", texts.type), texts, pa.scalar("", texts.type)))


class Pieces:
    """A sentencepiece model, by pre-tokens, with the same interface."""

    def __init__(self, path: str):
        self.model = load_pieces(path)
        self.bytes_of = self.model.bytes_of

    def split(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        return pretokens_of(texts)

    def encode(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return self.model.encode(units)


def load(path: str) -> ByteLevel | Pieces:
    if path not in _loaded:
        if not path.endswith((".model", ".json")):
            raise ValueError(f"not a tokenizer file: {path}")
        _loaded[path] = (Pieces if path.endswith(".model") else ByteLevel)(path)
    return _loaded[path]


def lengths(tokenizer: ByteLevel | Pieces, ids: np.ndarray) -> np.ndarray:
    return np.array([len(b) for b in tokenizer.bytes_of], np.int32)[ids]


def tokens_of(tokenizer: ByteLevel | Pieces, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts with a space before each: ids of all tokens, the number of tokens before each text, and for each text whether
    its tokens' bytes are the text's. A distinct unit is encoded once."""
    units, bounds = tokenizer.split(texts)
    coded = units.dictionary_encode()
    distinct, code = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    ids, offsets = tokenizer.encode(distinct)
    joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(offsets), pa.array(tokenizer.bytes_of, pa.binary()).take(pa.array(ids))), b"")
    same = pc.equal(joined.cast(pa.large_binary()), distinct.cast(pa.large_binary())).to_numpy(zero_copy_only=False).astype(bool)
    size = np.diff(offsets)[code]
    upto = np.append(0, np.cumsum(size))
    at = np.arange(upto[-1]) + np.repeat(offsets[code] - upto[:-1], size)
    wrong = np.append(0, np.cumsum(~same[code]))[bounds]
    marked = pc.match_substring(texts, SPACE_MARK).to_numpy(zero_copy_only=False).astype(bool)  # read as a space
    return ids[at], upto[bounds], (wrong[1:] == wrong[:-1]) & ~marked


def both_tokens(a: ByteLevel | Pieces, b: ByteLevel | Pieces, texts: pa.Array) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], np.ndarray]:
    """For each tokenizer ids, byte offsets of ends within their text, and tokens before each text; and which texts have tokens."""
    found = [tokens_of(t, texts) for t in (a, b)]
    good = found[0][2] & found[1][2]
    out = []
    for t, (ids, upto, _) in zip((a, b), found, strict=True):
        n = np.diff(upto)
        ids = ids[np.repeat(good, n)]
        upto = np.append(0, np.cumsum(np.where(good, n, 0)))
        ends = np.cumsum(lengths(t, ids), dtype=np.int64)
        out.append((ids, (ends - np.repeat(np.append(0, ends)[upto[:-1]], np.diff(upto))).astype(np.int32), upto))
    return out, good


def _lists(values: np.ndarray, upto: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(upto.astype(np.int32)), pa.array(values.astype(np.int32)))


def tokenize(docs: DataFrame, a: str, b: str, text_col: str = "text") -> DataFrame:
    """`row` (all columns of docs) with a_ids, a_ends, b_ids, b_ends: tokens of space + text, and the byte offsets of their ends.

    Texts that are null or empty, or whose tokens' bytes differ from space + text, have none.
    """
    d = as_rows(docs, text=F.col(f"`{text_col}`").cast("string"))

    def run(batches):
        for batch in slices(batches, "text", SLICE):
            found, _ = both_tokens(load(a), load(b), batch.column("text").fill_null("").cast(pa.large_string()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), *[_lists(x, upto) for ids, ends, upto in found for x in (ids, ends)]], names=["row", *TOKENS])

    return d.mapInArrow(run, d.select("row", *[F.lit(None).cast("array<int>").alias(c) for c in TOKENS]).schema)


TOKENS = ["a_ids", "a_ends", "b_ids", "b_ends"]
PACK = "ids array<bigint>, upto array<int>, codes binary, rare array<string>"
RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def alignable(texts: pa.Array) -> pa.Array:
    """Texts, empty where they are null or hold the space mark, which reads back as a space."""
    texts = texts.fill_null("").cast(pa.large_string())
    return pc.if_else(pc.match_substring(texts, SPACE_MARK), pa.scalar("", texts.type), texts)


def count_units(docs: DataFrame, a: str) -> DataFrame:
    """(entry, n): how often each unit comes in all texts that have tokens."""

    def units(batch):
        for part in slices(iter([batch]), "text", PACK_BYTES):
            yield load(a).split(alignable(part.column("text")))[0]

    return count_entries(docs, "text", units)


def tokenize_units(counts: DataFrame, a: str, b: str) -> DataFrame:
    """(entry, n) with TOKENS. Units are those of a byte-level a; tokens of neither side reach over their borders, so what
    holds of a unit's tokens holds wherever the unit stands."""

    def run(batches):
        for batch in slices(batches, "entry", SLICE):
            inner = pc.utf8_slice_codeunits(batch.column("entry").cast(pa.large_string()), 1)  # each unit begins with a space
            found, good = both_tokens(load(a), load(b), inner)
            if not good.all():
                raise ValueError(f"tokens of {a} or {b} do not give {inner[int(np.argmin(good))].as_py()[:80]!r} back")
            yield pa.RecordBatch.from_arrays([batch.column("entry"), batch.column("n"), *[_lists(x, upto) for ids, ends, upto in found for x in (ids, ends)]], names=["entry", "n", *TOKENS])

    return counts.mapInArrow(run, counts.select("entry", "n", *[F.lit(None).cast("array<int>").alias(c) for c in TOKENS]).schema)


def code_packs(docs: DataFrame, a: str, names: Broadcast) -> DataFrame:
    """Texts of (doc_id, text) in packs of PACK_BYTES: the codes of their units, each text's up to its place in upto.

    A code is a place among the frequent units (names), or, from their number on, one in the pack's list of rare ones;
    codes are 32-bit numbers, compressed, as they are written and shuffled once.
    """

    def run(batches):
        known = names.value
        for batch in slices(batches, "text", PACK_BYTES):
            units, bounds = load(a).split(alignable(batch.column("text")))
            coded = units.dictionary_encode()
            place = pc.index_in(coded.dictionary, value_set=known)
            rare = pc.is_null(place).to_numpy(zero_copy_only=False)
            code_of = np.where(rare, len(known) + np.cumsum(rare) - 1, place.fill_null(0).to_numpy(zero_copy_only=False))
            codes = code_of[coded.indices.to_numpy(zero_copy_only=False)].astype(np.int32)
            packed = pa.array([pa.compress(codes, codec="zstd", asbytes=True)], pa.binary())
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in (batch.column("doc_id"), pa.array(bounds[1:], pa.int32()), coded.dictionary.filter(pa.array(rare)).cast(pa.string()))]
            yield pa.RecordBatch.from_arrays([*lists[:2], packed, lists[2]], names=["ids", "upto", "codes", "rare"])

    return docs.mapInArrow(run, PACK)


def put_together(packs: DataFrame, rare: DataFrame, facts: Broadcast) -> DataFrame:
    """RESULT of each text of packs: sums over its units, and the digest of their groups, one unit's after the other.

    facts: FACTS of the frequent units; rare: (pack, place, FACTS) of the packs' rare units, by their places in the lists.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        right, known, pack = right.sort_by("place"), facts.value, left.combine_chunks()
        ids, upto = (pack.column(c).combine_chunks().flatten() for c in ("ids", "upto"))
        bounds = np.append(0, upto.to_numpy()).astype(np.int64)
        code = np.frombuffer(pa.decompress(pack.column("codes")[0].as_buffer(), 4 * int(bounds[-1]), "zstd"), np.int32)
        sums = {}
        for c in FACTS[:-1]:
            of = np.append(known.column(c).to_numpy(), right.column(c).to_numpy())
            sums[c] = np.diff(np.append(0, np.cumsum(of[code], dtype=np.int64))[bounds])
        texts = pa.concat_arrays([t.column("groups").combine_chunks().cast(pa.large_binary()) for t in (known, right)])
        digests = []
        for first in range(0, len(ids), DIGESTED):
            at = bounds[first : first + DIGESTED + 1]
            taken = texts.take(pa.array(code[at[0] : at[-1]]))
            joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(at - at[0]), taken), pa.scalar(b";", texts.type))
            digests += [hashlib.sha256(x).hexdigest() if x else "" for x in joined.to_pylist()]
        links = sums["n_a"] + sums["n_b"] - sums["n_groups"]
        return pa.table([ids, *[pa.array(x) for x in (sums["n_a"], sums["n_b"], sums["n_groups"], links, sums["n_best"], sums["count_sum"])], pa.array(digests, pa.string())], names=[f.split()[0] for f in RESULT.split(", ")])

    return packs.groupBy("pack").cogroup(rare.groupBy("pack")).applyInArrow(run, RESULT)


def _bound(value: Column, body) -> Column:
    """body of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _ranks(of: Column, among: Column) -> Column:
    """For each entry of one rising array, how many entries of another are less; the two share none.

    The second copies of the entries in both put together and sorted, where each entry of the first comes twice, are found
    by looking at neighbours, so it takes one sort and one pass, whatever the lengths.
    """
    twice = lambda s: F.filter(F.sequence(F.lit(1), F.size(s) - 1), lambda p: F.get(s, p) == F.get(s, p - 1))
    counts = _bound(F.sort_array(F.concat(among, of, of)), lambda s: F.transform(twice(s), lambda p, k: p - 1 - 2 * k))
    return F.when(F.size(of) > 0, counts).otherwise(F.array().cast("array<int>"))


def _slices(array: Column, bounds: Column, body) -> Column:
    """body(array, from, to) of the stretches between bounds (rising places in the array); both are computed once."""

    def run(x: Column, at: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(at)), lambda k: body(x, F.get(at, k - 1), F.coalesce(F.get(at, k), F.size(x) - 1)))

    return _bound(array, lambda x: _bound(bounds, lambda at: run(x, at)))


def _stretched(ids: Column, inside: Column) -> Column:
    """ids with each one repeated once for each of the other side's ends inside it (its place in `inside`)."""
    return F.flatten(_slices(ids, inside, lambda x, low, high: F.slice(x, F.coalesce(low, F.lit(0)) + 1, high - F.coalesce(low, F.lit(0)) + 1)))


def _sides(ids: Column, inner: Column) -> Column:
    """One side of each group, as text: ids, a comma after those (their places in `inner`) that do not end a group."""
    whole = _slices(ids.cast("array<string>"), inner, lambda x, low, high: F.array_join(F.slice(x, F.coalesce(low, F.lit(-1)) + 2, high - F.coalesce(low, F.lit(-1))), ";"))
    return F.split(F.array_join(whole, ","), ";")


def _aligned(t: DataFrame) -> DataFrame:
    """a_only, groups and links beside a table with TOKENS; see `align`."""
    t = t.withColumn("common", F.array_intersect("a_ends", "b_ends"))
    t = t.withColumns({"a_only": F.array_except("a_ends", "common"), "b_only": F.array_except("b_ends", "common")})
    t = t.withColumns({"b_in_a": _ranks(F.col("b_only"), F.col("a_ends")), "a_in_b": _ranks(F.col("a_only"), F.col("b_ends")), "a_of_b": _ranks(F.col("a_only"), F.col("b_only")), "b_of_a": _ranks(F.col("b_only"), F.col("a_only"))})
    # The place of an own end among its side's: those of its kind before it, and the common ones before it.
    own = lambda inside, others: _bound(F.col(others), lambda o: F.transform(F.col(inside), lambda n, k: k + n - F.get(o, k)))
    t = t.withColumns({"a_inner": own("a_in_b", "a_of_b"), "b_inner": own("b_in_a", "b_of_a")})
    groups = F.zip_with(_sides(F.col("a_ids"), F.col("a_inner")), _sides(F.col("b_ids"), F.col("b_inner")), lambda x, y: F.concat(x, F.lit("|"), y))
    links = F.zip_with(_stretched(F.col("a_ids"), F.col("b_in_a")), _stretched(F.col("b_ids"), F.col("a_in_b")), pair_of)
    none = F.size("a_ids") == 0
    return t.withColumns({"groups": F.when(none, F.array().cast("array<string>")).otherwise(groups), "links": F.when(none, F.array().cast("array<bigint>")).otherwise(links)})


def align(docs: DataFrame, a: str, b: str, text_col: str = "text") -> DataFrame:
    """`row` (all columns of docs) with a_ids, b_ids, groups and links of each text's tokens by two tokenizers.

    a, b: files that all machines have; a byte-level tokenizers file is given space + text, a sentencepiece model the text,
    to which it adds the space. The byte offsets where tokens of both end cut them into groups, each written as its ids of a
    and of b, `a1,a2|b1`. links: a number pair_of(a id, b id) for each pair of tokens whose bytes overlap, in order.

    Python gives ids and end offsets; the rest is Spark's functions of arrays. Common ends are the intersection of the two
    end arrays; the few ends that only one side has are put in their places among the others (`_ranks`), and between these
    places groups and links are slices of the id arrays. Time goes as n log n with a text's tokens. Null and empty texts, and
    texts whose tokens' bytes are not those of space + text, have no tokens. Any columns, null ids and repeated rows stay.
    """
    return _aligned(tokenize(docs, a, b, text_col)).select("row", "a_ids", "b_ids", "groups", "links")


def pair_of(a: Column, b: Column) -> Column:
    return F.shiftleft(a.cast("long"), 32).bitwiseOR(b.cast("long"))


def link_counts(links: DataFrame) -> DataFrame:
    """(pair, n, best) of (pair, n): n added up over all links, and 1 for the pairs with their b id's largest n.

    Added up before anything is shuffled; the ids of b bound the rows that the maxima are joined by.
    """
    counts = materialize(links.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))
    most = counts.groupBy(b.alias("b")).agg(F.max("n").alias("most"))
    return counts.withColumn("b", b).join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).cast("long").alias("best"))


def unit_sums(units: DataFrame) -> DataFrame:
    """(unit, count_sum, n_best) of units with n and links: sums over a unit's links of their counts, and of those that are best.

    Frequent pairs (at most 1 / HOT_PAIR of them) go to all workers, the others are joined; a pair is in no more units than
    it has links, so none that is joined is hot.
    """
    links = units.select("n", F.explode("links").alias("pair"))
    pairs = materialize(link_counts(links), "pair-counts")
    least = hot_from(pairs.agg(F.sum("n")).first()[0] or 0, HOT_PAIR)
    found = units.select("unit", F.explode("links").alias("pair"))
    hot, rare = pairs.filter(F.col("n") >= least), pairs.filter(F.col("n") < least)
    sums = lambda rows: rows.groupBy("unit").agg(F.sum("n").alias("n"), F.sum("best").alias("best"))
    out = found.join(F.broadcast(hot), "pair").select("unit", "n", "best")
    if not rare.isEmpty():
        out = out.unionByName(found.join(F.broadcast(hot.select("pair")), "pair", "left_anti").join(rare, "pair").select("unit", "n", "best"))
    return sums(out).select("unit", F.col("n").alias("count_sum"), F.col("best").alias("n_best"))


def frequent_from(units: DataFrame) -> int:
    """Units that come more often than this are at most MOST_UNITS, but for a ten-thousandth of all units."""
    n = units.count()
    return 0 if n <= MOST_UNITS else units.agg(F.percentile_approx("n", 1 - MOST_UNITS / n)).first()[0]


def align_documents(docs: DataFrame, a: str, b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of each row's tokens by two tokenizers.

    See `align` for groups and links; here each distinct unit (words, mostly) of all texts is tokenised and aligned once. An
    id pair's count is the number of links that hold it in all of docs; n_best counts the links whose count is the largest
    of their b id, count_sum adds up the counts of all links.

    1. Units are counted, by worker first. Each is tokenised, aligned and written with its groups and links.
    2. Links of units, each as often as its unit comes, are counted by pair, and the counts added up by unit.
    3. Texts are written as codes of units, in packs of a few megabytes. What is known of frequent units (MOST_UNITS) goes to
       all workers; a pack asks for each of its other units once, and gets the answers where its codes go. No unit is asked
       for by more than all packs.

    Texts without tokens (see `align`) have zeros and an empty groups_sha256. Null ids of documents and repeated rows each
    give a row; other columns are ignored, whatever their names; an empty table gives none. a must be a tokenizers file.
    """
    spark = docs.sparkSession
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    aligned = _aligned(tokenize_units(count_units(d, a), a, b))
    sizes = [F.size(x).cast("long").alias(c) for x, c in (("a_ids", "n_a"), ("b_ids", "n_b"), ("groups", "n_groups"))]
    units = materialize(aligned.select(F.monotonically_increasing_id().alias("unit"), "entry", "n", *sizes, F.array_join("groups", ";").alias("groups"), "links"), "units")
    known = materialize(units.drop("links").join(unit_sums(units), "unit").select("entry", "n", *FACTS), "known-units")
    release(spark, units)
    least = frequent_from(known)
    frequent = known.filter(F.col("n") > least).toArrow().sort_by([("n", "descending")])
    names = spark.sparkContext.broadcast(frequent["entry"].cast(pa.large_string()).combine_chunks())
    facts = spark.sparkContext.broadcast(frequent.select(FACTS).combine_chunks())
    packs = materialize(code_packs(d, a, names).select(F.monotonically_increasing_id().alias("pack"), "*"), "packs")
    asked = packs.select("pack", F.posexplode("rare").alias("place", "entry"))
    rare = materialize(asked.join(known.filter(F.col("n") <= least), "entry").select("pack", "place", *FACTS), "rare-units")
    release(spark, known)
    return put_together(packs.drop("rare"), rare, facts)
