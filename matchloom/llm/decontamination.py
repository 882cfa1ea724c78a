"""Benchmark decontamination: exact hits of pigeonhole pieces, verified by Myers' bit-parallel edit distance."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filtered, materialize, release, slices

#: Errors allowed in an item, as a share of its characters (after normalising).
ERROR_RATE = 0.08
#: Characters of items that one pass takes to the workers; a larger benchmark takes more passes.
ITEM_BLOCK = 4_000_000


#: A run of what str.split takes for white space, as Java writes it.
WHITE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def normal(text: str | None) -> str:
    """Lower case, with each run of white space as one space."""
    return " ".join((text or "").lower().split())


def pieces(item: str, errors: int) -> list[tuple[int, int]]:
    """Bounds of errors + 1 pieces of near-equal length: whatever the errors are, one piece at least has none."""
    n = errors + 1
    return [(len(item) * i // n, len(item) * (i + 1) // n) for i in range(n)]


def masks(item: str) -> dict[str, int]:
    out: dict[str, int] = {}
    for i, c in enumerate(item):
        out[c] = out.get(c, 0) | 1 << i
    return out


def inside_word(text: str, at: int) -> int:
    """1 if a word goes on across this place of text, else 0."""
    return int(0 < at < len(text) and text[at - 1].isalnum() and text[at].isalnum())


def infix_distance(m: int, peq: dict[str, int], text: str, start: int = 0, end: int | None = None) -> int:
    """Least cost of a pattern (its length and bit masks) in text[start:end]: one word operation a character.

    The cost of a part of text is its edit distance to the pattern, and 1 for each of its ends that lies inside a word of
    the whole text. The cost of beginning at a place enters the bit vectors from below, as the first row's difference.
    """
    end = len(text) if end is None else end
    full, high = (1 << m) - 1, 1 << (m - 1)
    row = inside_word(text, start)  # cost of the empty pattern here
    pv, mv, score = full, 0, m + row
    best = score + inside_word(text, start)
    for at in range(start, end):
        below = inside_word(text, at + 1)
        step, row = below - row, below
        eq = peq.get(text[at], 0)
        xv = eq | mv
        if step < 0:
            eq |= 1
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        if score + below < best:
            best = score + below
        ph = (ph << 1) & full | (step > 0)
        mh = (mh << 1) & full | (step < 0)
        pv = mh | (full & ~(xv | ph))
        mv = ph & xv
    return best


class Matcher:
    """Finds texts of items: an automaton of all pieces, then verification around each hit."""

    def __init__(self, items: list[str], rate: float = ERROR_RATE):
        import ahocorasick

        self.names: dict[str, list[str]] = {}
        for x in sorted(set(items)):
            self.names.setdefault(normal(x), []).append(x)
        self.items = [(text, int(rate * len(text)), masks(text)) for text in sorted(self.names) if text]
        found: dict[str, list[tuple[int, int]]] = {}
        for i, (text, errors, _) in enumerate(self.items):
            for s, e in pieces(text, errors):
                found.setdefault(text[s:e], []).append((i, e))
        self.automaton = ahocorasick.Automaton()
        for piece, where in found.items():
            self.automaton.add_word(piece, where)
        if found:
            self.automaton.make_automaton()

    def leaks(self, text: str | None) -> dict[str, int]:
        """The items held, and the cost of the part of text that is nearest to each (see infix_distance)."""
        if not self.items or not text:
            return {}
        text = normal(text)
        starts: dict[int, set[int]] = {}
        for at, where in self.automaton.iter(text):
            for i, e in where:
                starts.setdefault(i, set()).add(at + 1 - e)
        out = {}
        for i, at in starts.items():
            item, errors, peq = self.items[i]
            if any(text.startswith(item, s) and not inside_word(text, s) and not inside_word(text, s + len(item)) for s in at if s >= 0):
                out |= dict.fromkeys(self.names[item], 0)
                continue
            windows: list[list[int]] = []
            for s in sorted(at) if errors else ():
                lo, hi = s - errors, s + len(item) + errors
                if windows and lo <= windows[-1][1] - len(item):  # windows that overlap are one
                    windows[-1][1] = hi
                else:
                    windows.append([lo, hi])
            best = min((infix_distance(len(item), peq, text, max(0, lo), min(len(text), hi)) for lo, hi in windows), default=errors + 1)
            if best <= errors:
                out |= dict.fromkeys(self.names[item], best)
        return out


def _normal(text):
    """`normal` as an expression: white space is what Python's str.split takes for it."""
    return F.btrim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), WHITE, " "))


def _blocks(docs: DataFrame, texts: DataFrame, rate: float):
    """Matchers of distinct texts of items, as functions that a task calls, block by block; a block is fetched when it is
    asked for."""
    total = texts.agg(F.sum(F.length("text"))).first()[0] or 0
    n_blocks = max(1, -(-total // ITEM_BLOCK))
    for block in range(n_blocks):
        mine = texts.filter(F.pmod(F.xxhash64("text"), F.lit(n_blocks)) == block).toArrow().column("text").to_pylist()
        shared = docs.sparkSession.sparkContext.broadcast(mine)
        yield block == n_blocks - 1, lambda shared=shared: Matcher(shared.value, rate)


def leaking_pairs(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, distance: one row for each row of docs and benchmark item found in its whole text.

    An item is held if some part of the text costs at most rate * length: the edits between them, both in lower case with
    single spaces, and 1 for each end of the part that lies inside a word. The rule is the same for all lengths; items so
    short that it allows no error are held where they stand as they are, between word borders.

    The benchmark is a stated query set. Its distinct texts are taken to the workers in blocks of about ITEM_BLOCK
    characters, each a pass of its own over docs, and docs are not shuffled; the texts found are joined to the items that
    have them, so equal items, however many, are all reported and one of them is looked for. Null or empty texts and items
    hold nothing; an empty benchmark leaks nothing; null ids and repeated rows are answered like others; of a text of any
    length the windows around hits are compared, so time goes with its length and hits. Other columns are ignored.
    """
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), _normal(F.col(item_text_col)).alias("item")).filter("item <> ''")
    out = None
    for last, matcher in _blocks(docs, items.select(F.col("item").alias("text")).distinct(), rate):

        def search(batches, matcher=matcher):
            m = matcher()
            for batch in slices(batches, "text"):
                found = [(i, item, cost) for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True) for item, cost in m.leaks(t).items()]
                yield pa.RecordBatch.from_pylist([dict(zip(PAIRS.names, x, strict=True)) for x in found], PAIRS)

        pairs = d.mapInArrow(search, "doc_id long, item string, distance int")
        pairs = pairs if last else materialize(pairs, "leaks")
        out = pairs if out is None else out.unionByName(pairs)
    return out.join(items, "item").select("doc_id", "item_id", "distance")


PAIRS = pa.schema([("doc_id", pa.int64()), ("item", pa.string()), ("distance", pa.int32())])


def decontaminate(docs: DataFrame, benchmark: DataFrame, rate: float = ERROR_RATE, text_col: str = "text") -> DataFrame:
    """The rows of docs that hold no benchmark item, as `leaking_pairs` finds them; all columns stay, whatever their names.

    Rows with null or empty text, and all rows where the benchmark is empty, stay. Rows with null ids and repeated rows go
    or stay by their texts. An empty table stays empty. Each block of the benchmark works on what the one before it kept.
    """
    out, written = docs, []
    texts = benchmark.select(_normal(F.col("text")).alias("text")).filter("text <> ''").distinct()
    for last, matcher in _blocks(docs, texts, rate):

        def clean(matcher=matcher):
            m = matcher()
            return lambda batch: np.array([not m.leaks(t) for t in batch.column("text").to_pylist()], bool)

        out = filtered(out, text_col, clean)
        if not last:
            out = materialize(out, "decontaminated")
            release(docs.sparkSession, *written)
            written = [out]
    return out
