"""Near-duplicate texts by a chosen-path join on word shingles, with exact verification."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_rows, from_rows, hash_strings, materialize, mix64, slices, words_of
from .graph import connected_components, local_roots

SHINGLE = 5
SIMILARITY = 0.8
#: Tokens that a set samples for each of its buckets, on average over its tokens: a path has so many children.
BRANCHING = 1 / SIMILARITY
#: Runs of one round, and levels of a path.
RUNS, LEVELS = 8, 3
#: Rounds whose sampled tokens are found in one pass over the texts.
FEATURE_ROUNDS = 2
#: Rounds are repeated until one finds no more than this share of all joins so far: what the rounds before it missed.
MISSED = 1e-3
#: Buckets up to this size are compared as they are; larger ones are split by another chosen token.
SMALL_BUCKET = 48
#: A child bucket with this share of its parent shows that the parent is one group of copies: it is compared in blocks.
DENSE = 0.5
#: Rows of a block when a large bucket or component is compared block by block.
BLOCK = 512
#: One-permutation sketch: bins of 8 bits. Pairs that agree in fewer than this share of bins (six deviations off) are dropped.
BINS, LEAST_AGREEMENT = 128, 0.58


def shingles_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, and row bounds. Texts under SHINGLE words have one shingle of all words."""
    words, bounds = words_of(column)
    if not len(words):
        return np.zeros(0, np.uint64), np.zeros(len(column) + 1, np.int64)
    coded = words.dictionary_encode()
    h = hash_strings(coded.dictionary)[coded.indices.to_numpy()]
    n = np.diff(bounds)
    rolled = np.zeros(len(h), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(SHINGLE):
            rolled[: len(h) - k] = rolled[: len(h) - k] * np.uint64(0x9E3779B97F4A7C15) + h[k:]
    rolled = mix64(rolled)
    count = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    out, at = np.empty(int(count.sum()), np.uint64), 0
    ends = np.zeros(len(column) + 1, np.int64)
    for i, (s, c, words_here) in enumerate(zip(bounds[:-1].tolist(), count.tolist(), n.tolist(), strict=True)):
        if c:
            if words_here >= SHINGLE:
                part = np.sort(rolled[s : s + c])
                part = part[np.concatenate(([True], part[1:] != part[:-1]))]
            else:
                with np.errstate(over="ignore"):
                    x = np.uint64(words_here)
                    for v in h[s : s + words_here]:
                        x = x * np.uint64(0x9E3779B97F4A7C15) + v
                part = mix64(np.array([x], np.uint64), 1)
            out[at : at + len(part)] = part
            at += len(part)
        ends[i + 1] = at
    return out[:at], ends


def sketches_of(tokens: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """rows x BINS bytes: of each bin (by a hash's leading bits) the low bits of its least hash; 0 for an empty bin."""
    out = np.zeros((len(ends) - 1, BINS), np.uint8)
    if len(tokens):
        row = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
        slot = row * BINS + (tokens >> np.uint64(64 - int(math.log2(BINS)))).astype(np.int64)
        first = np.concatenate(([True], slot[1:] != slot[:-1]))
        out.reshape(-1)[slot[first]] = (tokens[first] % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    return out


def agreement(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Share of the bins used by either sketch in which both are equal."""
    used = ((x | y) != 0).sum(axis=-1)
    return ((x == y) & (x != 0)).sum(axis=-1) / np.maximum(used, 1)


def chosen_tokens(tokens: np.ndarray, ends: np.ndarray, first: int, runs: int) -> pa.Array:
    """For each row a list for each level of each run: the tokens of the set that are sampled there, as 32-bit hashes.

    A token is sampled by a hash of run, level and itself below BRANCHING / (size of the set), so texts that share it sample
    it together (but for their sizes), and a set samples BRANCHING tokens on average: none, one or several.
    """
    rows, lists = len(ends) - 1, LEVELS * runs
    sizes = np.diff(ends)
    row = np.repeat(np.arange(rows), sizes)
    below = np.minimum(BRANCHING / np.maximum(sizes, 1), 1.0)
    below = (below * float(1 << 62)).astype(np.uint64)[row]
    salts = mix64(np.arange(2 * LEVELS * first, 2 * LEVELS * (first + runs), dtype=np.uint64), 7)
    hits = []
    with np.errstate(over="ignore"):
        for k in range(lists):
            hits.append(np.flatnonzero((((tokens ^ salts[2 * k]) * (salts[2 * k + 1] | np.uint64(1))) >> np.uint64(2)) < below))
    which = np.concatenate([row[h] * lists + k for k, h in enumerate(hits)]) if lists else np.zeros(0, np.int64)
    order = np.argsort(which, kind="stable")
    found = (tokens[np.concatenate(hits)][order] >> np.uint64(32)).astype(np.uint32).view(np.int32)
    inner = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=rows * lists))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * lists), pa.ListArray.from_arrays(pa.array(inner), pa.array(found)))


FEATURES = "node long, check long, doc long, size int, chosen array<array<int>>, sketch binary"


def _features(docs: DataFrame, first: int, runs: int) -> DataFrame:
    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            tokens, ends = shingles_of(batch.column("text"))
            sketch = pa.FixedSizeBinaryArray.from_buffers(pa.binary(BINS), batch.num_rows, [None, pa.py_buffer(sketches_of(tokens, ends))]).cast(pa.binary())
            ids = [batch.column(c) for c in ("node", "check", "doc")]
            out = pa.RecordBatch.from_arrays([*ids, pa.array(np.diff(ends).astype(np.int32)), chosen_tokens(tokens, ends, first, runs), sketch], names=["node", "check", "doc", "size", "chosen", "sketch"])
            yield out.filter(pa.array(np.diff(ends) > 0))

    return docs.mapInArrow(features, FEATURES)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), BINS)


def _bucket_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compare the rows of small buckets (sorted by path) by their sketches; edges from nodes to the least of their part."""
    held = None
    for batch in batches:
        t = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        path = t["path"].to_numpy()
        cut = int(np.searchsorted(path, path[-1]))  # the last bucket may go on in the next batch
        held = t.slice(cut)
        yield from _edges_within(t.slice(0, cut))
    if held is not None:
        yield from _edges_within(held)


EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _edges_within(t: pa.Table) -> Iterator[pa.RecordBatch]:
    if t.num_rows < 2:
        return
    path, node, sketch = t["path"].to_numpy(), t["node"].to_numpy(), _matrix(t["sketch"])
    left, right = [], []
    for k in range(1, SMALL_BUCKET + 1):
        at = np.flatnonzero(path[k:] == path[:-k]) if len(path) > k else np.zeros(0, np.int64)
        if not len(at):
            break
        for part in np.array_split(at, max(1, len(at) // 100_000)):
            near = part[agreement(sketch[part], sketch[part + k]) >= LEAST_AGREEMENT]
            left.append(node[near])
            right.append(node[near + k])
    yield from _stars(np.concatenate(left) if left else np.zeros(0, np.int64), np.concatenate(right) if right else np.zeros(0, np.int64))


def _stars(a: np.ndarray, b: np.ndarray) -> Iterator[pa.RecordBatch]:
    if len(a):
        nodes, roots = local_roots(a, b)
        differ = nodes != roots
        if differ.any():
            yield pa.RecordBatch.from_arrays([pa.array(nodes[differ]), pa.array(roots[differ])], schema=EDGES)


def _block_edges(t: pa.Table) -> pa.Table:
    """Compare two blocks of one large bucket by sketches; edges from nodes to the least of their part."""
    node, sketch, block = t["node"].to_numpy(), _matrix(t["sketch"]), t["block"].to_numpy()
    order = np.argsort(node, kind="stable")  # then the least index is the least node
    node, sketch, block = node[order], sketch[order], block[order]
    one, other = block == t["one"][0].as_py(), np.flatnonzero(block == t["other"][0].as_py())
    near = np.zeros((len(node), len(node)), bool)
    for i in np.flatnonzero(one):
        near[i, other] = agreement(sketch[i], sketch[other]) >= LEAST_AGREEMENT
    roots = node[_matrix_roots(near | near.T)]
    differ = roots != node
    return pa.Table.from_arrays([pa.array(node[differ]), pa.array(roots[differ])], schema=EDGES)


def _matrix_roots(near: np.ndarray) -> np.ndarray:
    """For each row of a symmetric matrix of links, the least row of its component; memory of a few rows at a time."""
    label = np.arange(len(near), dtype=np.int32)
    while True:
        new = label.copy()
        for s in range(0, len(near), 128):
            new[s : s + 128] = np.minimum(label[s : s + 128], np.where(near[s : s + 128], label, len(near)).min(axis=1, initial=len(near)))
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _in_blocks(rows: DataFrame, group: str, n: str) -> DataFrame:
    """Each row once for every pair of blocks of its group that it takes part in."""
    d = rows.withColumn("blocks", F.ceil(F.col(n) / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("node", F.lit("block")), "blocks").cast("int"))
    d = d.withColumn("with", F.explode(F.expr("sequence(0, blocks - 1)")))
    return d.withColumn("one", F.least("block", "with")).withColumn("other", F.greatest("block", "with"))


def candidate_edges(nodes: DataFrame, first: int, runs: int) -> DataFrame:
    """Edges (u, v) that join all nodes with a similar partner in some bucket of the chosen paths of some runs.

    nodes: node, chosen, sketch. Level by level, a bucket is one path of sampled tokens, with all sets that sampled it. It is
    left if it has one member, compared if it is small or dense, and else split: each member goes into one bucket for each
    token that it samples at the next level. After the last level, large buckets are compared in blocks.
    """
    sampled = lambda level: F.explode(F.expr(f"element_at(chosen, cast((run - {first}) * {LEVELS} + {level + 1} as int))")).alias("token")
    rows = nodes.select("node", "chosen", F.explode(F.expr(f"sequence({first}, {first + runs - 1})")).alias("run")).select("node", "run", sampled(0)).select("node", "run", F.xxhash64("run", "token").alias("path"))
    small, large = [], []
    for level in range(LEVELS):
        rows = materialize(rows, "paths")
        sizes = rows.groupBy("path").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        rows = materialize(rows.join(sizes, "path"), "buckets")
        small.append(rows.filter(F.col("n") <= SMALL_BUCKET).select("path", "node"))
        over = rows.filter(F.col("n") > SMALL_BUCKET)
        if level == LEVELS - 1 or over.isEmpty():
            large.append(over.select("path", "node", "n"))
            break
        deeper = over.join(nodes.select("node", "chosen"), "node").select("node", "run", "n", F.col("path").alias("parent"), sampled(level + 1))
        deeper = materialize(deeper.select("node", "run", "n", "parent", F.xxhash64("parent", "token").alias("path")), "paths")
        dense = deeper.groupBy("parent", "path").agg(F.count(F.lit(1)).alias("m"), F.max("n").alias("n")).filter(F.col("m") >= DENSE * F.col("n")).select(F.col("parent").alias("path")).distinct()
        dense = materialize(dense, "dense")
        large.append(over.join(dense, "path", "left_semi").select("path", "node", "n"))
        rows = deeper.join(dense.select(F.col("path").alias("parent")), "parent", "left_anti").select("node", "path", "run")
    sketches = nodes.select("node", "sketch")
    few = small[0]
    for part in small[1:]:
        few = few.unionByName(part)
    few = few.join(sketches, "node").repartition("path").sortWithinPartitions("path")
    edges = few.mapInArrow(_bucket_edges, "u long, v long")
    many = large[0]
    for part in large[1:]:
        many = many.unionByName(part)
    blocks = _in_blocks(many.join(sketches, "node"), "path", "n")
    return edges.unionByName(blocks.groupBy("path", "one", "other").applyInArrow(_block_edges, "u long, v long"))


LINKS = pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64()), ("whole", pa.bool_())])


def _similar(tokens: np.ndarray, ends: np.ndarray, rows: np.ndarray, similarity: float) -> np.ndarray:
    """Matrix: which of these rows have Jaccard similarity of at least `similarity` (exact, from shared token counts)."""
    sizes = np.diff(ends)[rows]
    which = np.repeat(np.arange(len(rows)), sizes)
    mine = np.concatenate([tokens[ends[r] : ends[r + 1]] for r in rows])
    values, code, df = np.unique(mine, return_inverse=True, return_counts=True)
    shared = df[code] > 1
    which, code = which[shared], code[shared]
    common = np.zeros((len(rows), len(rows)), np.float32)
    order = np.argsort(code, kind="stable")
    which, code = which[order], code[order]
    codes, start = np.unique(code, return_index=True)
    for s in range(0, len(codes), 4096):
        lo, hi = start[s], start[s + 4096] if s + 4096 < len(codes) else len(code)
        m = np.zeros((len(rows), min(4096, len(codes) - s)), np.float32)
        m[which[lo:hi], np.searchsorted(codes[s : s + 4096], code[lo:hi])] = 1
        common += m @ m.T
    union = sizes[:, None] + sizes[None, :] - common
    near = common >= similarity * union - 1e-6
    np.fill_diagonal(near, False)
    return near


def _verifier(similarity: float):
    def verify(t: pa.Table) -> pa.Table:
        node = t["node"].to_numpy()
        _, first = np.unique(node, return_index=True)  # repeated rows of one document bring its text again
        t = t.take(pa.array(np.sort(first)))
        node, comp, copies, block = (t[c].to_numpy() for c in ("node", "comp", "copies", "block"))
        text = t["text"].combine_chunks()
        one, other, whole = t["one"][0].as_py(), t["other"][0].as_py(), t["whole"][0].as_py()
        parts = [shingles_of(text.slice(i, 256)) for i in range(0, len(text), 256)]
        tokens = np.concatenate([p[0] for p in parts])
        ends = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(p[1]) for p in parts]))])
        out = []
        order = np.argsort(comp, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(comp[order])) + 1):
            rows = rows[np.argsort(node[rows], kind="stable")]  # then the least index is the least node
            near = _similar(tokens, ends, rows, similarity)
            if one != other:
                near &= block[rows][:, None] != block[rows][None, :]
            links = np.array([copies[rows][row].sum() for row in near], np.int64)
            has = links > 0
            out.append((node[rows][has], links[has], node[rows][_matrix_roots(near)][has]))
        columns = [np.concatenate([o[i] for o in out]) for i in range(3)]
        return pa.Table.from_arrays([*map(pa.array, columns), pa.array(np.full(len(columns[0]), whole))], schema=LINKS)

    return verify


def node_of(text: Column) -> Column:
    """The number that a text goes by."""
    return F.xxhash64(text)


def check_of(text: Column) -> Column:
    """A second hash: texts are told apart by both."""
    return F.xxhash64(F.lit("second"), text)


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(f"`{text_col}`")
    return docs.select(node_of(text).alias("node"), check_of(text).alias("check"), F.col(f"`{id_col}`").cast("long").alias("doc"), text.alias("text"))


def _told_apart(rows: DataFrame, shared: DataFrame | None) -> DataFrame:
    """rows (node, check, ...) with a number out of both hashes where different texts share the first."""
    if shared is None:
        return rows
    both = rows.join(shared.withColumn("is_shared", F.lit(True)), "node", "left")
    return both.withColumn("node", F.when(F.col("is_shared"), F.xxhash64("check", "node")).otherwise(F.col("node"))).select(rows.columns)


def _nodes(d: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """One row a text with a word, and the numbers that different texts share (among 10^11 texts a few hundred) or None."""

    def merged(rows: DataFrame) -> DataFrame:
        first = [F.first(c).alias(c) for c in ("size", "chosen", "sketch")]
        found = _features(rows, 0, FEATURE_ROUNDS * RUNS).groupBy("node").agg(F.min("check").alias("check"), F.max("check").alias("last_check"), F.min("doc").alias("doc"), F.count(F.lit(1)).alias("copies"), *first)
        return materialize(found, "nodes")

    nodes = merged(d)
    several = nodes.filter("check != last_check").select("node")
    if several.isEmpty():
        return nodes, None
    shared = materialize(several, "shared-nodes")
    again = merged(_told_apart(d.join(shared, "node", "left_semi"), shared))
    return nodes.filter("check = last_check").unionByName(again), shared


def _candidates(d: DataFrame, nodes: DataFrame, missed: float) -> DataFrame:
    """(node, root) of nodes that some path joined, by rounds of runs until a round finds hardly a new join.

    A round's edges are first brought to the components so far, so a later round is about what the earlier ones missed:
    its share of new joins is their measured loss, and its own are kept too.
    """
    parts, first, rounds, known = None, 0, 0, 0
    while True:
        edges = candidate_edges(nodes, first, RUNS)
        if parts is not None:
            to = lambda c: parts.select(F.col("node").alias(c), F.col("root").alias(f"{c}_root"))
            edges = edges.distinct().join(to("u"), "u", "left").join(to("v"), "v", "left").select(F.coalesce("u_root", "u").alias("u"), F.coalesce("v_root", "v").alias("v")).filter("u != v").distinct()
        edges = materialize(edges, "edges")
        new = connected_components(edges, "candidates")
        joins = new.filter("node != root").count()
        if parts is None:
            parts = new
        elif joins:
            moved = parts.join(new.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").select("node", F.coalesce("to", "root").alias("root"))
            parts = materialize(moved.unionByName(new.join(parts.select("node"), "node", "left_anti")), "joined")
        known, rounds, first = known + joins, rounds + 1, first + RUNS
        if rounds > 1 and joins <= missed * known:
            return parts
        if first % (FEATURE_ROUNDS * RUNS) == 0:
            nodes = materialize(_features(d, first, FEATURE_ROUNDS * RUNS).groupBy("node").agg(F.first("chosen").alias("chosen"), F.first("sketch").alias("sketch")), "nodes")


def _known(d: DataFrame, similarity: float, missed: float) -> tuple[DataFrame, DataFrame | None]:
    """(node, check, doc, copies, links, root) of every text with a word: its least id, links to other texts' rows, and class.

    Also the numbers shared by different texts, which `_told_apart` takes.
    """
    nodes, shared = _nodes(d)
    d = _told_apart(d, shared)
    parts = _candidates(d, nodes, missed)
    sizes = parts.groupBy("root").agg(F.count(F.lit(1)).alias("n"))
    parts = materialize(parts.join(sizes, "root").join(nodes.select("node", "check", "doc", "copies"), "node").select("node", "check", "doc", "copies", F.col("root").alias("comp"), "n"), "parts")
    n_small = parts.filter(F.col("n") <= BLOCK).count()
    packs = max(1, -(-n_small // (BLOCK // 2)))
    key = lambda c: F.coalesce(c, F.lit(-1))
    texts = d.withColumn("_doc", key(F.col("doc"))).join(parts.select("node", "check", key(F.col("doc")).alias("_doc"), "copies", "comp", "n").hint("merge"), ["node", "check", "_doc"])
    # One join of texts for components of every size: whole components are packed into tasks, large ones dealt by blocks.
    whole = F.col("n") <= BLOCK
    dealt = _in_blocks(texts, "comp", "n").select("node", "comp", "copies", "text", F.when(whole, F.pmod(F.xxhash64("comp"), F.lit(packs))).otherwise(F.xxhash64("comp", "one", "other")).alias("task"), "block", "one", "other", whole.alias("whole"))
    links = materialize(dealt.groupBy("task", "whole", "one", "other").applyInArrow(_verifier(similarity), "node long, links long, root long, whole boolean"), "links")
    across = connected_components(links.filter("not whole").select(F.col("node").alias("u"), F.col("root").alias("v")), "classes")
    linked = links.groupBy("node").agg(F.sum("links").alias("links"), F.min(F.when(F.col("whole"), F.col("root"))).alias("near_root"))
    linked = linked.join(across.withColumnRenamed("root", "far_root"), "node", "left").select("node", "links", F.coalesce("near_root", "far_root").alias("root"))
    known = nodes.select("node", "check", "doc", "copies").join(linked, "node", "left").select("node", "check", "doc", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root"))
    return materialize(known, "known"), shared


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY, missed: float = MISSED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: doc_id, class_id, n_links.

    Texts are sets of word 5-grams; two texts are linked if their Jaccard similarity is at least `similarity`. n_links is
    the number of other rows linked to a row, copies of its own text among them; class_id is the least id of all rows that
    links reach. Words are runs of other than space and \\x09-\\x0D; case counts.

    1. Equal texts are one node (pre-aggregated, so any number of copies is one row a task), told apart by 128 bits of hashes.
    2. Chosen-path runs: a set goes into a bucket for each token that it samples; buckets are split again by tokens sampled
       at the next level until they are small, and then compared, where sketches drop pairs far from similar. Rounds of
       runs are repeated until one finds at most `missed` of all joins anew.
    3. Components of the remaining pairs get their texts once, and all pairs within a component are compared exactly;
       components over BLOCK nodes are compared block by block, so memory is bounded. No list of pairs is ever made.
    4. Components of the verified links are the classes.

    A text without words is linked to nothing (class_id is its own id). Null text likewise. Null ids stay null rows.
    Repeated rows are copies. Texts of any length are taken whole, one at a time. An empty table gives an empty result. Other
    columns are ignored, whatever their names.
    """
    d = _rows(docs, id_col, text_col)
    known, shared = _known(d, similarity, missed)
    least = known.groupBy("root").agg(F.min("doc").alias("class_id"))
    of = known.join(least, "root").select("node", "check", "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    return _told_apart(d.select("node", "check", F.col("doc").alias("doc_id")), shared).join(of, ["node", "check"], "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def deduplicate(docs: DataFrame, similarity: float = SIMILARITY, missed: float = MISSED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each class (see `near_duplicates`): the one with the least id (null last), then the least text
    hash, once if it comes repeatedly; all columns stay, whatever their names.

    Rows without a word (null and empty texts among them) have no class and all stay; an empty table stays empty; texts of
    any length are taken whole.
    """
    known, shared = _known(_rows(docs, id_col, text_col), similarity, missed)
    last = F.lit((1 << 63) - 1)
    first = known.withColumn("_doc", F.coalesce("doc", last)).groupBy("root").agg(F.min(F.struct("_doc", "node")).alias("first"))
    keep = first.select(F.col("first._doc").alias("id"), F.col("first.node").alias("node"))
    text = F.col(f"`{text_col}`")
    rows = as_rows(docs, node=node_of(text), check=check_of(text), id=F.coalesce(F.col(f"`{id_col}`").cast("long"), last), has_word=F.coalesce(text.rlike(r"[^\x20\x09-\x0D]"), F.lit(False)))
    # equal rows of one id and text are brought down to one before they meet
    one = _told_apart(rows.filter("has_word"), shared).join(keep, ["node", "id"]).groupBy("node", "id").agg(F.first("row").alias("row"))
    return from_rows(one.select("row").unionByName(rows.filter("not has_word").select("row")), docs)


#: The same by brute force: every pair of texts that share a shingle, and classes by following links.
SQL = r"""
WITH RECURSIVE
t AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents),
w AS (SELECT r, doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM t),
n AS (SELECT text, any_value(words) AS words, min(doc_id) AS doc, count(*) AS copies, row_number() OVER () AS node FROM w WHERE len(words) > 0 GROUP BY text),
s AS (SELECT node, unnest(CASE WHEN len(words) < 5 THEN [array_to_string(words, ' ')] ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i+4], ' '))) END) AS shingle FROM n),
z AS (SELECT node, count(*) AS size FROM s GROUP BY node),
c AS (SELECT a.node AS u, b.node AS v, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.node < b.node GROUP BY ALL),
l AS (SELECT u, v FROM c JOIN z x ON u = x.node JOIN z y ON v = y.node WHERE common >= 0.8 * (x.size + y.size - common) - 1e-6),
e AS (SELECT u, v FROM l UNION ALL SELECT v, u FROM l),
g AS (SELECT node, node AS reached FROM n UNION SELECT g.node, e.v FROM g JOIN e ON g.reached = e.u),
k AS (SELECT g.node, min(n.doc) AS class_id FROM g JOIN n ON g.reached = n.node GROUP BY g.node),
m AS (SELECT e.u AS node, sum(n.copies) AS links FROM e JOIN n ON e.v = n.node GROUP BY e.u),
o AS (SELECT n.text, n.copies, k.class_id, coalesce(m.links, 0) AS links FROM n JOIN k USING (node) LEFT JOIN m USING (node))
SELECT w.doc_id, CASE WHEN o.text IS NULL THEN w.doc_id ELSE o.class_id END AS class_id, CAST(CASE WHEN o.text IS NULL THEN 0 ELSE o.links + o.copies - 1 END AS BIGINT) AS n_links FROM w LEFT JOIN o ON w.text = o.text
"""
