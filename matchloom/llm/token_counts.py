"""Token counts of documents by counting the pieces of each distinct pre-token once."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HashMap64, hash_strings, materialize, slices, text_offsets
from .lexicon import count_entries, hot_from

#: The tokenizer writes a space as this character; as text it is a space to it too.
SPACE_MARK = "▁"

#: Texts on which a tokenizer's pre-tokens are tried when it is loaded.
PROBES = ["", " ", "  two  spaces ", "line\nbreak\ttab\r\n", "it's 1,234.5% of <s> x</s>", "naïve ÉCOLE ﬁ e\u0301", "日本語のテキスト ▁ mark", "\u3000wide", "😀😀 a\x00b", "<|endoftext|>a <|startoftext|> b<|endoftext|>"]
_loaded: dict[str, "Tokenizer"] = {}


class PieceTokenizer:
    """A sentencepiece model: a pre-token is a run of spaces and the non-spaces after it."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        crossing = [p for p in map(self.sp.id_to_piece, range(self.sp.get_piece_size())) if SPACE_MARK in p.lstrip(SPACE_MARK)]
        if crossing:
            raise ValueError(f"pieces of {path} reach over spaces, e.g. {crossing[0]!r}: its texts have no pre-tokens")

    def split(self, column: pa.Array) -> tuple[pa.Array, np.ndarray]:
        return pretokens_of(column)

    def pieces(self, entries: list[str]) -> list[int]:
        """The tokenizer adds the first space of a pre-token itself (a lone space is one piece)."""
        return [max(1, len(ids)) for ids in self.sp.encode([e[1:] for e in entries], num_threads=1)]

    def whole(self, text: str) -> int:
        return len(self.sp.encode(text))


class JsonTokenizer:
    """A tokenizers file: added tokens are found first, what is between is normalised and split by its own pre-tokenizer."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added = re.compile("(" + "|".join(map(re.escape, added)) + ")") if added else None

    def split(self, column: pa.Array) -> tuple[pa.Array, np.ndarray]:
        normal, split = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        out, bounds = [], [0]
        for text in column.to_pylist():
            for i, part in enumerate(self.added.split(text or "") if self.added else [text or ""]):
                if i % 2:
                    out.append("\n" + part)  # no pre-token begins so
                elif part:
                    part = normal.normalize_str(part) if normal else part
                    out += [t for t, _ in split.pre_tokenize_str(part)] if split else [part]
            bounds.append(len(out))
        return pa.array(out, pa.large_string()), np.array(bounds, np.int64)

    def pieces(self, entries: list[str]) -> list[int]:
        return [1 if e.startswith("\n") else len(self.tokenizer.model.tokenize(e)) for e in entries]

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)


Tokenizer = PieceTokenizer | JsonTokenizer


def load(path: str) -> Tokenizer:
    """The tokenizer of a file (.model: sentencepiece, .json: tokenizers), tried: pre-tokens must add up to whole texts."""
    if path not in _loaded:
        if not path.endswith((".model", ".json")):
            raise ValueError(f"not a tokenizer file: {path}")
        found = (PieceTokenizer if path.endswith(".model") else JsonTokenizer)(path)
        for text in PROBES:
            if sum(found.pieces(found.split(pa.array([text]))[0].to_pylist())) != found.whole(text):
                raise ValueError(f"{path} counts {text!r} otherwise as a whole than by pre-tokens")
        _loaded[path] = found
    return _loaded[path]


def pretokens_of(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All pre-tokens of a column as one array, and for each row the number of pre-tokens before it.

    A pre-token is a run of spaces and the non-spaces after it; the tokenizer puts a space before a text, and none of its
    pieces has a space after another character, so pieces never reach over a pre-token's border.
    """
    column = column.fill_null("")
    filled = pc.if_else(pc.equal(pc.binary_length(column), 0), column, pc.binary_join_element_wise(pa.scalar(" ", column.type), pc.replace_substring(column, SPACE_MARK, " "), pa.scalar("", column.type)))
    at, raw = text_offsets(filled)
    space = raw == 0x20
    first = np.zeros(len(raw), bool)
    if len(raw):
        first[1:] = space[1:] & ~space[:-1]
        first[at[:-1][at[:-1] < at[1:]]] = True
    starts = np.flatnonzero(first)
    offsets = np.append(starts, len(raw)).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw)), np.searchsorted(starts, at)


def count_tokens(docs: DataFrame, model: str, over: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: the tokens of each whole text, without begin, end or added tokens.

    model: a sentencepiece (.model) or tokenizers (.json) file that all machines have. Strings of special tokens inside a
    text are what the library makes of them by default: ordinary text to the first, one token to the second.

    1. Every distinct pre-token of the corpus is found, with its frequency, and its pieces are counted once.
    2. Frequent pre-tokens (at most 1 / HOT_SHARE of them) go to all workers; a worker looks up those of its documents
       and hands on (document, pre-token, frequency) for the rest, which are joined to the counted pre-tokens.
    3. Sums by document. No token id leaves the tokenizer's call.

    Null text counts as empty: no bytes, no tokens. Null ids and repeated rows each give a row: sums are taken by id and
    text together, and a pair that came n times is returned n times. Other columns are ignored, whatever their names. A text of any length is one row's work. An empty table gives an empty result.
    """
    spark = docs.sparkSession

    def entries(batch):
        for part in slices([batch], "text"):
            yield load(model).split(part.column("text"))[0]

    def pieces(batches):
        count = load(model).pieces
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("entry"), batch.column("n"), pa.array(count(batch.column("entry").to_pylist()), pa.int64())], names=["entry", "n", "pieces"])

    lexicon = materialize(count_entries(docs, text_col, entries).mapInArrow(pieces, "entry string, n long, pieces long"), "pretokens")
    total = lexicon.agg(F.sum("n")).first()[0] or 0
    hot = lexicon.filter(F.col("n") >= hot_from(total)).select("entry", "pieces").toArrow()
    known = spark.sparkContext.broadcast((HashMap64(hash_strings(hot["entry"].combine_chunks())), hot["pieces"].to_numpy()))

    def look_up(batches):
        found, pieces_of = known.value
        for batch in slices(batches, "text"):
            text, ids = batch.column("text"), batch.column("doc_id")
            n_bytes = np.diff(text_offsets(text)[0])
            words, bounds = load(model).split(text)
            coded = words.dictionary_encode()
            at = found.find(hash_strings(coded.dictionary))
            codes = coded.indices.to_numpy()
            hot_at = at[codes]
            doc = np.repeat(np.arange(len(ids)), np.diff(bounds))
            known_here = hot_at >= 0
            sums = np.bincount(doc[known_here], pieces_of[hot_at[known_here]], len(ids)).astype(np.int64) if len(pieces_of) else np.zeros(len(ids), np.int64)
            rest, freq = np.unique(doc[~known_here] * len(coded.dictionary) + codes[~known_here], return_counts=True)
            rest_doc, rest_code = np.divmod(rest, max(1, len(coded.dictionary)))
            row = batch.column("row")
            alone = pc.binary_join_element_wise("\n#", row.cast(pa.string()), "")  # joins to no pre-token
            yield pa.RecordBatch.from_arrays([row, ids, pa.array(n_bytes), alone, pa.array(sums)], schema=PARTS)
            if len(rest):
                of = pa.array(rest_doc)
                yield pa.RecordBatch.from_arrays([row.take(of), ids.take(of), pa.nulls(len(rest), pa.int64()), coded.dictionary.take(pa.array(rest_code)).cast(pa.string()), pa.array(freq.astype(np.int64))], schema=PARTS)

    rows = docs.select(F.xxhash64(id_col, text_col).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(look_up, "row long, doc_id long, n_bytes long, entry string, n long")
    rare = lexicon.filter(F.col("n") < hot_from(total)).select("entry", "pieces")
    copies = F.count("n_bytes")
    return (
        rows.join(rare, "entry", "left")
        .groupBy("row", "doc_id")
        .agg(F.max("n_bytes").alias("n_bytes"), copies.alias("copies"), F.sum(F.col("n") * F.coalesce("pieces", F.lit(1))).alias("pieces"))
        .select("doc_id", "n_bytes", F.expr("pieces div copies").alias("n_tokens"), F.explode(F.expr("sequence(1, copies)")).alias("copy"))
        .select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > over).alias("over_limit"))
    )


PARTS = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("entry", pa.string()), ("n", pa.int64())])
