"""SentencePiece encoding by vectorised merge rounds over flat symbol arrays, and decoding."""

from __future__ import annotations

import codecs

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_rows, slices, text_offsets
from .token_counts import SPACE_MARK, pretokens_of

#: Text bytes of a slice, and ids decoded at a time; a distinct pre-token of a slice is encoded once.
SLICE, DECODED = 2_500_000, 500_000
#: Rank of a pair that no piece joins.
NEVER = np.iinfo(np.int32).max
_loaded: dict[str, "PieceModel"] = {}


def _fields(message: bytes):
    """(number, value) of each field of a serialized protocol buffer message: integers, and bytes for all else."""

    def varint(i):
        out = shift = 0
        while True:
            out |= (message[i] & 127) << shift
            i, shift = i + 1, shift + 7
            if message[i - 1] < 128:
                return out, i

    i = 0
    while i < len(message):
        key, i = varint(i)
        if key & 7 == 0:
            value, i = varint(i)
        else:
            size, i = varint(i) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], i)
            value, i = message[i : i + size], i + size
        yield key >> 3, value


def _each_byte(error: UnicodeError):
    return "�" * (error.end - error.start), error.end


codecs.register_error("matchloom-each-byte", _each_byte)


class Merges:
    """Pairs of symbols that become one symbol, by rank.

    pairs: (left, right) -> (rank, symbol); a lower rank is merged first, and no two symbols share one. n_symbols bounds all
    symbols, and the last one is in no pair.
    """

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]], n_symbols: int):
        self.n_symbols, self.unknown = n_symbols, n_symbols - 1
        keys = np.fromiter((x * n_symbols + y for x, y in pairs), np.int64, len(pairs))
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        found = np.array(list(pairs.values()), np.int32).reshape(-1, 2)[order]
        self.ranks, self.pieces = np.append(found[:, 0], NEVER), np.append(found[:, 1], -1)
        own = np.full(n_symbols, -1, np.int64)
        own[found[:, 1]] = found[:, 0]
        left, right = np.divmod(self.keys[:-1], n_symbols)
        self.risky = np.zeros(n_symbols, bool)  # symbols that are part of a pair of better rank than their own
        for part in (left, right):
            self.risky[part[self.ranks[:-1] < own[part]]] = True

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of pairs of symbols."""
        key = left.astype(np.int64) * self.n_symbols + right
        at = np.searchsorted(self.keys, key)
        known = self.keys[at] == key
        return np.where(known, self.ranks[at], NEVER), np.where(known, self.pieces[at], -1)

    def merge(self, symbols: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Merge symbols (changed in place) within words; returns which of them are left.

        A round finds, in each word, the best rank of its pairs and merges all pairs of that rank, leftmost first, at once.
        Where a merge makes a pair of better rank than its own, which the one-at-a-time order would take next, what lies to
        its right waits for the next round. Words without a pair leave; rounds end when no word is left.
        """
        alive = np.ones(len(symbols), bool)
        at = np.arange(len(symbols), dtype=np.int32)  # place of each symbol still looked at
        sym, of = symbols.copy(), word
        rank, piece = self._pairs(sym, of)
        while len(at):
            first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            size = np.diff(np.append(first, len(of)))
            best = np.minimum.reduceat(rank, first)
            if (done := best == NEVER).any():
                on = np.flatnonzero(np.repeat(~done, size))
                at, sym, of, rank, piece = at.take(on), sym.take(on), of.take(on), rank.take(on), piece.take(on)
                best, size = best[~done], size[~done]
                if not len(at):
                    break
            hit = np.flatnonzero(rank == np.repeat(best, size))
            apart = np.append(True, np.diff(hit) != 1)  # of pairs that overlap every other one counts
            start = hit[np.maximum.accumulate(np.where(apart, np.arange(len(hit)), 0))]
            hit = hit[(hit - start) % 2 == 0]
            hit = self._in_order(hit, sym, of, rank, piece)
            sym[hit] = piece[hit]
            symbols[at[hit]] = sym[hit]
            alive[at[hit + 1]] = False
            on = np.ones(len(at), bool)
            on[hit + 1] = False
            new = hit - np.arange(len(hit))  # a merge drops one symbol
            on = np.flatnonzero(on)
            at, sym, of, rank, piece = at.take(on), sym.take(on), of.take(on), rank.take(on), piece.take(on)
            fresh = np.zeros(len(at), bool)
            fresh[new] = True
            fresh[new[new > 0] - 1] = True
            stale = np.flatnonzero(fresh)
            rank[stale], piece[stale] = self._pairs(sym, of, stale)
        return alive

    def _pairs(self, sym: np.ndarray, of: np.ndarray, places: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rank and piece of each symbol (at places) with the one after it in its word."""
        places = np.arange(len(sym)) if places is None else places
        rank, piece = np.full(len(places), NEVER, np.int32), np.full(len(places), -1, np.int32)
        inner = np.flatnonzero(places + 1 < len(sym))
        inner = inner[of[places[inner]] == of[places[inner] + 1]]
        rank[inner], piece[inner] = self.look_up(sym[places[inner]], sym[places[inner] + 1])
        return rank, piece

    def _in_order(self, hit, sym, of, rank, piece) -> np.ndarray:
        """Those of the merges that come before any pair of better rank is made in their word."""
        made = piece[hit]
        risky = np.flatnonzero(self.risky[made])
        if not len(risky):
            return hit
        here = hit[risky]
        left, right = np.maximum(here - 1, 0), np.minimum(here + 2, len(sym) - 1)
        before = np.where((here > 0) & (of[left] == of[here]), sym[left], self.unknown)
        joined = (risky > 0) & (hit[risky - 1] == here - 2) & (of[here - 2] == of[here])  # with the one before, in this round
        before[joined] = made[risky[joined] - 1]
        after = np.where((here + 2 < len(sym)) & (of[right] == of[here]), sym[right], self.unknown)
        better = np.zeros(len(hit), bool)
        better[risky] = np.minimum(self.look_up(before, made[risky])[0], self.look_up(made[risky], after)[0]) < rank[here]
        if not better.any():
            return hit
        word = of[hit]
        stop = np.flatnonzero(better)
        words, first = np.unique(word[stop], return_index=True)
        place = np.searchsorted(words, word)
        place[place == len(words)] = 0
        return hit[(words[place] != word) | (np.arange(len(hit)) <= stop[first][place])]


class PieceModel:
    """The merge tables of a sentencepiece file.

    Its flags are read, and files whose texts these rounds would encode otherwise are refused: it must be a byte-pair model
    that falls back to bytes, leaves texts as they are but for a space mark before them, and has neither pieces over spaces
    nor pieces of the user. Scores must tell pieces apart, but for runs of space marks, which come last of all.
    """

    #: Numbers of the fields read, out of the published description of the format.
    PIECE, TRAINER, NORMALIZER = 1, 2, 3
    TEXT, KIND = 1, 3
    BYTE_PAIR = 2

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        message: dict[int, list[bytes]] = {}
        for number, value in _fields(sp.serialized_model_proto()):
            message.setdefault(number, []).append(value)
        trainer, normalizer = (dict(_fields(message[k][0])) for k in (self.TRAINER, self.NORMALIZER))
        flags = {"not byte-pair": trainer.get(3, 1) != self.BYTE_PAIR, "no byte fallback": not trainer.get(35, 0), "marks after words": trainer.get(24, 0), "a rewriting table": normalizer.get(2), "no mark before texts": not normalizer.get(3, 1), "spaces dropped": normalizer.get(4, 1), "spaces kept as such": not normalizer.get(5, 1)}
        kinds = [dict(_fields(x)).get(self.KIND, 1) for x in message[self.PIECE]]
        flags["pieces of the user or unused ones"] = 4 in kinds or 5 in kinds
        self.text = [sp.id_to_piece(i) for i in range(len(kinds))]
        self.plain = [i for i, k in enumerate(kinds) if k == 1]
        score = {self.text[i]: sp.get_score(i) for i in self.plain}
        self.runs = {len(p): i for i, p in ((i, self.text[i]) for i in self.plain) if not p.strip(SPACE_MARK)}
        flags["pieces over spaces"] = any(SPACE_MARK in p.lstrip(SPACE_MARK) or len(p) - len(p.lstrip(SPACE_MARK)) > 1 for p in score if p.strip(SPACE_MARK))
        longer = {p: s for p, s in score.items() if len(p) > 1}
        spaces = {s for p, s in longer.items() if not p.strip(SPACE_MARK)}
        others = [s for p, s in longer.items() if p.strip(SPACE_MARK)]
        flags["equal scores"] = len(others) != len(set(others))
        flags["runs of marks that do not come last"] = bool(spaces) and (len(spaces) > 1 or max(spaces) >= min(others))
        if found := [what for what, wrong in flags.items() if wrong]:
            raise ValueError(f"{path} cannot be encoded in merge rounds: {', '.join(found)}")
        self._tables(longer)

        def surface(i: int) -> bytes:
            return bytes([int(self.text[i][3:5], 16)]) if kinds[i] == 6 else b"" if kinds[i] == 3 else " ⁇ ".encode() if kinds[i] == 2 else self.text[i].replace(SPACE_MARK, " ").encode()

        self.bytes_of = [surface(i) for i in range(len(kinds))]
        self.is_byte = np.array([k == 6 for k in kinds])
        self.is_control = np.array([k == 3 for k in kinds])
        self.is_marked = np.array([k == 1 and t.startswith(SPACE_MARK) for k, t in zip(kinds, self.text, strict=True)])
        byte_ids = np.flatnonzero(self.is_byte)
        self.byte_id = np.zeros(256, np.int32)
        self.byte_id[[self.bytes_of[i][0] for i in byte_ids]] = byte_ids

    def _tables(self, longer: dict[str, float]) -> None:
        """Symbols of characters, and for each pair of symbols whose text is a piece, that piece and its rank."""
        ids = {self.text[i]: i for i in self.plain}
        extra = sorted({c for p in longer for c in p} - set(ids))  # characters that are no piece themselves
        symbols = ids | {c: len(self.text) + i for i, c in enumerate(extra)}
        self.symbol_of = np.full(0x110000, len(self.text) + len(extra), np.int32)
        for c, i in symbols.items():
            if len(c) == 1:
                self.symbol_of[ord(c)] = i
        rank = {p: r for r, p in enumerate(sorted((p for p in longer if p.strip(SPACE_MARK)), key=lambda p: -longer[p]))}
        self.merges = Merges({(symbols[p[:k]], symbols[p[k:]]): (r, ids[p]) for p, r in rank.items() for k in range(1, len(p)) if p[:k] in symbols and p[k:] in symbols}, len(self.text) + len(extra) + 1)

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens (see pretokens_of), as flat ids and the number of ids before each word (words + 1 entries)."""
        at, raw = text_offsets(words)
        begins = np.flatnonzero((raw & 0xC0) != 0x80)  # of characters
        ends = np.append(begins[1:], len(raw))
        points = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        points = np.where(points == 0x20, ord(SPACE_MARK), points)
        symbols = self.symbol_of[points]
        word = np.repeat(np.arange(len(words), dtype=np.int32), np.diff(np.searchsorted(begins, at)))
        left = self.merges.merge(symbols, word)
        symbols, word, begins, ends = symbols[left], word[left], begins[left], ends[left]
        symbols, left = self._space_runs(symbols, word)
        word, begins, ends = word[left], begins[left], ends[left]
        falls = symbols >= len(self.text)
        n = np.where(falls, ends - begins, 1)
        first = np.cumsum(n) - n
        ids = np.repeat(symbols, n)
        which = np.repeat(np.flatnonzero(falls), n[falls])
        inside = np.arange(len(which)) - np.repeat(np.cumsum(n[falls]) - n[falls], n[falls])
        ids[first[which] + inside] = self.byte_id[raw[begins[which] + inside]]
        counts = np.bincount(word, n, len(words)).astype(np.int64) if len(word) else np.zeros(len(words), np.int64)
        return ids, np.append(0, np.cumsum(counts))

    def run_pieces(self, size: int) -> list[int]:
        """Lengths of the pieces that a run of space marks becomes: of all pairs that a piece joins, the leftmost is next."""
        out: list[int] = []
        for _ in range(size):
            out.append(1)
            while len(out) > 1 and out[-2] + out[-1] in self.runs:
                out[-2:] = [out[-2] + out[-1]]
        return out

    def _space_runs(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Join the space marks that are left in runs; returns symbols, and which places are left."""
        mark = symbols == self.runs.get(1, -1)
        inner = np.append(False, mark[1:] & mark[:-1] & (word[1:] == word[:-1])) if len(mark) else mark
        keep = np.ones(len(symbols), bool)
        second = np.flatnonzero(inner & ~np.append(False, inner[:-1]))  # of each run of two marks or more
        after = np.flatnonzero(inner & ~np.append(inner[1:], False)) + 1
        known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for start, end in zip(second - 1, after, strict=True):
            if (size := int(end - start)) not in known:
                lengths = self.run_pieces(size)
                known[size] = np.cumsum([0, *lengths[:-1]]), np.array([self.runs[k] for k in lengths], np.int32)
            begins, pieces = known[size]
            keep[start:end] = False
            keep[start + begins] = True
            symbols[start + begins] = pieces
        return symbols[keep], keep

    def encode_column(self, column: pa.Array) -> pa.ListArray:
        """Ids of each text; a distinct pre-token of the column is encoded once."""
        words, bounds = pretokens_of(column)
        coded = words.dictionary_encode()
        ids, offsets = self.encode(coded.dictionary)
        code = coded.indices.to_numpy(zero_copy_only=False)
        size = np.diff(offsets)[code]
        upto = np.append(0, np.cumsum(size))
        flat = ids[np.arange(upto[-1]) + np.repeat(offsets[code] - upto[:-1], size)] if len(code) else ids
        return pa.ListArray.from_arrays(pa.array(upto[bounds].astype(np.int32)), pa.array(flat, pa.int32()))

    def decode_column(self, column: pa.Array) -> pa.Array:
        """Texts of lists of ids: pieces put together, without the space before a text; bytes that are no characters are U+FFFD."""
        offsets = column.offsets.to_numpy().astype(np.int64)
        ids = column.flatten().to_numpy(zero_copy_only=False)
        offsets = offsets - offsets[0]
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.text)):
            raise ValueError("ids that the vocabulary does not have")
        row = np.repeat(np.arange(len(column)), np.diff(offsets))
        # Runs of ids without a control id: bytes on its two sides make no character together.
        control = self.is_control[ids]
        run = row + np.cumsum(control)
        n_runs = len(column) + int(control.sum())
        upto = np.append(0, np.cumsum(np.bincount(run[~control], minlength=n_runs))).astype(np.int64)
        joined = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(upto), pa.array(self.bytes_of, pa.binary()).take(pa.array(ids[~control]))), b"").to_pylist()
        texts = [b.decode("utf-8", "matchloom-each-byte") for b in joined]
        last = np.arange(len(column)) + np.append(0, np.cumsum(control))[offsets[1:]]  # of each row's runs
        if n_runs > len(column):
            texts = ["".join(texts[a:b]) for a, b in zip(np.append(0, last[:-1] + 1), last + 1, strict=True)]
        return pa.array([t[1:] if d else t for t, d in zip(texts, self._marked_first(ids, row, control, len(column)), strict=True)], pa.string())

    def _marked_first(self, ids: np.ndarray, row: np.ndarray, control: np.ndarray, n: int) -> np.ndarray:
        """Whether the first id of each row that shows anything begins with the space mark."""
        ids, row = ids[~control], row[~control]
        first = np.append(True, row[1:] != row[:-1])[: len(row)]
        out = np.zeros(n, bool)
        out[row[first]] = self.is_marked[ids[first]]
        return out


def load_pieces(path: str) -> PieceModel:
    """The merge tables of a file, made once in a process."""
    if path not in _loaded:
        _loaded[path] = PieceModel(path)
    return _loaded[path]


def encode_pieces(docs: DataFrame, model: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """The rows of docs with the ids (array<int>) of each whole text beside all their columns, as the sentencepiece library
    gives them without begin and end; a column of docs named as ids_col goes.

    model: a sentencepiece file of the byte-pair kind that all machines have (see PieceModel for what is refused). Each
    task cuts its texts into slices of a few megabytes, and a slice into pre-tokens (spaces and the non-spaces after them,
    over whose borders no piece reaches); its distinct pre-tokens are merged together in rounds, and their ids scattered
    back to their places. No shuffle. A text longer than a slice is a slice of its own, so memory goes with the longest text.

    Null and empty texts have no ids. Null ids of documents and repeated rows are rows like others; no column's name can
    clash with names used inside; an empty table gives none. A pre-token of any length is one word of the rounds.
    """
    d = as_rows(docs, text=F.col(f"`{text_col}`").cast("string"))

    def run(batches):
        pieces = load_pieces(model)
        for batch in slices(batches, "text", SLICE):
            yield pa.RecordBatch.from_arrays([batch.column("row"), pieces.encode_column(batch.column("text"))], names=["row", "ids"])

    out = d.mapInArrow(run, d.select("row", F.lit(None).cast("array<int>").alias("ids")).schema)
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() != ids_col.lower()], F.col("ids").alias(ids_col))


def decode_pieces(rows: DataFrame, model: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """The rows with the text that each list of ids stands for beside all their columns; a column named as text_col goes.

    Begin, end and other control ids are dropped, the space before a text too; bytes that make no character are U+FFFD, and
    the unknown id is shown as the library shows it. Null lists are empty texts; ids out of range are an error. No shuffle.
    """
    d = as_rows(rows, ids=F.coalesce(F.filter(F.col(f"`{ids_col}`").cast("array<int>"), lambda x: x.isNotNull()), F.array().cast("array<int>")))

    def run(batches):
        pieces = load_pieces(model)
        for batch in batches:
            start, upto = 0, batch.column("ids").offsets.to_numpy()
            while start < batch.num_rows:
                end = max(start + 1, int(np.searchsorted(upto, upto[start] + DECODED, side="right")) - 1)
                part = batch.slice(start, min(end, batch.num_rows) - start)
                yield pa.RecordBatch.from_arrays([part.column("row"), pieces.decode_column(part.column("ids"))], names=["row", "decoded"])
                start += part.num_rows

    out = d.mapInArrow(run, d.select("row", F.lit("").cast("string").alias("decoded")).schema)
    return out.select(*[F.col("row").getField(c).alias(c) for c in rows.columns if c.lower() != text_col.lower()], F.col("decoded").alias(text_col))
