"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame operations only."""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_BREAK, as_rows, from_rows, hashable, materialize

#: Rows of one fold, on average; a fold is the work of one task at a time.
FOLD = 256
#: Size classes for each doubling of the size; mass moves between rows of one class before it moves between classes.
CLASSES = 8
#: A size class of a source with no more rows than this goes to the root as it is.
FEW = 8
#: The last rows of a source are rounded so often, each time in another order and with other random numbers, and the outcome is
#: mended by one exchange; the words nearest to the target win.
TRIALS = 64
#: Probabilities nearer to 0 or 1 than this are taken as 0 or 1.
EPS = 1e-9
#: Tables of sums with at most this many rows are broadcast; larger ones are joined by their key.
SMALL_ROWS = 100_000


def n_words(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_BREAK), "")).cast("long")


def join_sums(big: DataFrame, sums: DataFrame, keys: list[str]) -> DataFrame:
    """Null-safe inner join to a table of sums, broadcast if its counted rows allow."""
    b = sums.select(*[F.col(k).alias(f"_{k}") for k in keys], *[c for c in sums.columns if c not in keys])
    on = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return big.join(F.broadcast(b) if sums.count() <= SMALL_ROWS else b, on).drop(*[f"_{k}" for k in keys])


def _weighted(sizes: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """sizes with the weight of each source: weights in turn by code point, null last. Numbered range by range, not in one task."""
    order = F.col("source").asc_nulls_last()
    ranges = materialize(sizes.repartitionByRange(order).withColumn("range", F.spark_partition_id()), "mix-sources")
    before = Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # over a row for each range
    first = ranges.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    nth = F.row_number().over(Window.partitionBy("range").orderBy(order)) - 1 + F.col("first")
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (nth % len(weights) + 1).cast("int"))
    return ranges.join(F.broadcast(first), "range").select("source", "source_size", weight.alias("weight"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """(source, source_size, target): `share` of all sizes dealt by weight, no source above `most` times its size.

    A level is raised until sum(min(most * size, level * weight)) is the share: sources that a level fills are full, and the
    next level deals what they leave to the others, until no more are filled. Each step is one sum over the sources, however
    many they are; the targets are those of resharing the excess by weight again and again. sizes: (source, source_size),
    one row a source.
    """
    full_at = F.col("source_size") * float(most) / F.col("weight")
    ranked = materialize(_weighted(sizes, weights).withColumn("full_at", full_at), "mix-weights")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, n_full = 0.0, -1
    while True:
        full = F.col("full_at") <= level
        filled, open_, n = ranked.agg(F.sum(F.when(full, F.col("source_size"))), F.sum(F.when(~full, F.col("weight"))), F.count_if(full)).first()
        if n == n_full or not open_:
            break
        n_full, level = n, max(level, (total * share - (filled or 0) * most) / open_)
    target = F.when((F.col("full_at") <= level) | F.lit(not open_), F.col("source_size") * float(most)).otherwise(F.lit(level) * F.col("weight"))
    return ranked.select("source", "source_size", target.alias("target"))


def _uniform(*cols: str) -> str:
    return f"(shiftrightunsigned(xxhash64({', '.join(cols)}), 11) * {2.0**-53!r}D)"


#: What tells rows apart and how often equal ones come: carried along, never looked at.
REF = "struct<doc_id:bigint,h1:bigint,h2:bigint,repeats:bigint>"


def _fold(salt: str, ref: str = REF) -> Column:
    """Fold an array of (size, key, ref, whole, p) by the pivotal rule into decided rows and at most one undecided.

    salt: SQL of what the random numbers depend on besides the two rows. ref: the type of what tells rows apart.
    """
    item = f"struct<size:bigint,key:bigint,ref:{ref},whole:bigint,p:double>"
    done = f"array<struct<size:bigint,ref:{ref},copies:bigint>>"
    decide = lambda x, up: f"named_struct('size', {x}.size, 'ref', {x}.ref, 'copies', {x}.whole + cast({up} as bigint))"
    move = lambda x, p: f"if({p} > {EPS!r}D and {p} < {1 - EPS!r}D, named_struct('size', {x}.size, 'key', {x}.key, 'ref', {x}.ref, 'whole', {x}.whole, 'p', {p}), cast(null as {item}))"
    over = lambda x, p: f"if({p} <= {EPS!r}D or {p} >= {1 - EPS!r}D, array({decide(x, f'round({p})')}), cast(array() as {done}))"

    def settle(stays: str, gone: str, up: int, p: str) -> str:
        return f"named_struct('left', {move(stays, p)}, 'done', concat(a.done, array({decide(gone, up)}), {over(stays, p)}))"

    u = _uniform("a.left.key", "x.key", salt)
    low, high = "(a.left.p + x.p)", "(a.left.p + x.p - 1D)"
    return F.expr(
        f"aggregate(items, named_struct('left', cast(null as {item}), 'done', cast(array() as {done})), (a, x) -> "
        f"if(a.left is null, named_struct('left', x, 'done', a.done), "
        f"if(a.left.p + x.p < 1D, "
        f"if({u} * {low} < x.p, {settle('x', 'a.left', 0, low)}, {settle('a.left', 'x', 0, low)}), "
        f"if({u} * (2D - {low}) < 1D - x.p, {settle('x', 'a.left', 1, high)}, {settle('a.left', 'x', 1, high)}))))"
    )


def _exchange() -> Column:
    """(off, down, up): of all ways to take one copy from a row rounded up, or none, and to give one to a row rounded down, or
    none, that which comes nearest to `missing` words; the rows are named by their places, -1 for none. Needs `done` and `miss`,
    the words that are missing after it."""
    side = lambda copies: F.concat(F.array(F.struct(F.lit(0).cast("long").alias("size"), F.lit(-1).alias("ref"))), F.transform(F.filter("done", lambda x: x["copies"] == copies), lambda x: F.struct(x["size"].alias("size"), x["ref"].alias("ref"))))
    best = lambda up: F.array_min(F.transform(side(0), lambda x: F.struct(F.abs(F.col("miss") - x["size"] + up["size"]).alias("off"), up["ref"].alias("down"), x["ref"].alias("up"))))
    return F.array_min(F.transform(side(1), best))


def _rooted(roots: DataFrame, seed: int, trials: int) -> DataFrame:
    """(source, size, ref, copies) of the last rows of each source: (source, items, missing), one row a source.

    Places stand for rows here, so that what is drawn `trials` times is numbers alone. With one trial the outcome stays as
    it is drawn, and every row keeps its probability.
    """
    place = F.transform("items", lambda x, i: F.struct(x["size"].alias("size"), x["key"].alias("key"), i.alias("ref"), F.lit(0).cast("long").alias("whole"), x["p"].alias("p")))
    fixed = F.aggregate("items", F.lit(0).cast("long"), lambda n, x: n + x["whole"] * x["size"])
    drawn = roots.select("source", place.alias("items"), (F.col("missing") - fixed).alias("missing"), F.explode(F.sequence(F.lit(1), F.lit(trials))).alias("trial"))
    drawn = drawn.repartition(min(10_000, max(trials, roots.count())), "source", "trial")  # few rows, much to try with each
    order = F.transform("items", lambda x: F.struct(F.xxhash64(x["key"], F.lit(seed), "trial").alias("order"), x.alias("x")))
    drawn = drawn.withColumn("items", F.transform(F.sort_array(order), lambda x: x["x"])).select("source", "missing", "trial", _fold(f"{seed}, -trial", "int").alias("r"))
    last = F.expr(f"array(named_struct('size', r.left.size, 'ref', r.left.ref, 'copies', cast({_uniform('r.left.key', str(seed), '-trial')} < r.left.p as bigint)))")
    drawn = drawn.withColumn("done", F.when(F.col("r.left").isNull(), F.col("r.done")).otherwise(F.concat("r.done", last)))
    drawn = drawn.withColumn("miss", F.col("missing") - F.aggregate("done", F.lit(0).cast("long"), lambda n, x: n + x["copies"] * x["size"]))
    drawn = drawn.withColumn("swap", _exchange() if trials > 1 else F.struct(F.abs("miss").alias("off"), F.lit(-1).alias("down"), F.lit(-1).alias("up")))
    best = drawn.groupBy("source").agg(F.min_by(F.struct("done", "swap"), F.struct("swap.off", "trial")).alias("best"))
    best = best.select(F.col("source").alias("_source"), F.inline("best.done"), F.col("best.swap").alias("swap"))
    copies = F.col("copies") + F.when(F.col("ref") == F.col("swap.up"), 1).when(F.col("ref") == F.col("swap.down"), -1).otherwise(0)
    best = best.select("_source", F.col("ref").alias("place"), copies.alias("more"))
    rows = roots.select("source", F.posexplode("items").alias("place", "x"))
    same = F.col("source").eqNullSafe(F.col("_source"))
    return rows.join(best, [same, rows["place"] == best["place"]]).select("source", F.col("x.size").alias("size"), F.col("x.ref").alias("ref"), (F.col("x.whole") + F.col("more")).cast("long").alias("copies"))


def _missing(targets: DataFrame, decided: DataFrame) -> DataFrame:
    """(source, missing): the words that a source still lacks."""
    both = targets.select("source", F.col("target").alias("words")).unionByName(decided.select("source", (-F.col("copies") * F.col("size")).cast("double").alias("words")))
    return both.groupBy("source").agg(F.sum("words").alias("missing"))


def _decided(docs: DataFrame, identity: list[Column], weights, share, most, seed, few, trials, id_col, text_col, source_col) -> tuple[DataFrame, DataFrame]:
    """(source, size, ref, copies) of each group of rows that `identity` does not tell apart, and the targets of sources."""
    d = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).alias("source"),
        n_words(F.col(text_col)).alias("size"),
        F.xxhash64(F.col(id_col), F.col(text_col), F.lit(seed)).alias("key"),
        F.xxhash64(*identity).alias("h1"),
        F.xxhash64(F.lit("second"), *identity).alias("h2"),
    )
    # Equal rows are one item: pivots among them would end with the same number of them taken, and one left in between.
    d = d.groupBy(*d.columns).agg(F.count(F.lit(1)).alias("repeats"))
    d = materialize(d.withColumn("class", F.when(F.col("size") > 0, F.floor(F.log2("size") * CLASSES).cast("int"))), "mix-sizes")
    classes = materialize(d.groupBy("source", "class").agg(F.sum(F.col("size") * F.col("repeats")).alias("size"), F.count(F.lit(1)).alias("n")), "mix-classes")
    targets = materialize(source_targets(classes.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most), "mix-targets")
    chunks = F.ceil(F.col("n") / FOLD)
    deepest = classes.agg(F.max(chunks)).first()[0] or 1

    rate = F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))
    plan = join_sums(classes.select("source", "class", "n", chunks.alias("chunks")), targets.select("source", rate.alias("rate")), ["source"])
    rows = join_sums(d, plan, ["source", "class"])
    whole = F.floor(F.col("rate") + EPS)
    rows = rows.withColumn("whole", whole.cast("long")).withColumn("p", F.greatest(F.col("rate") - whole, F.lit(0.0)) * F.col("repeats"))
    rows = rows.withColumn("up", F.floor(F.col("p") + EPS)).withColumn("whole", F.col("whole") * F.col("repeats") + F.col("up")).withColumn("p", F.greatest(F.col("p") - F.col("up"), F.lit(0.0)))
    rows = rows.withColumn("ref", F.struct("doc_id", "h1", "h2", "repeats"))
    sure = (F.col("p") <= EPS) | (F.col("size") == 0)
    decided = [rows.filter(sure).select("source", "size", "ref", F.when(F.col("size") == 0, 0).otherwise(F.col("whole")).cast("long").alias("copies"))]

    items = rows.filter(~sure).select("source", "class", F.pmod(F.xxhash64("key", "h1", F.lit("chunk")), "chunks").alias("chunk"), "n", F.struct("size", "key", "ref", "whole", "p").alias("item"))
    # Largest first: what is left over in the end is of the smallest rows.
    in_order = F.sort_array(F.collect_list("item"), asc=False).alias("items")
    few_items = items.filter(F.col("n") <= few).select("source", "item")
    items = items.filter(F.col("n") > few)
    for level in itertools.count():
        folded = materialize(items.groupBy("source", "class", "chunk").agg(in_order).select("source", "class", "chunk", _fold(f"{seed}, {level}").alias("r")).select("source", "class", "chunk", "r.*"), "mix-fold")
        decided.append(folded.select("source", F.inline("done")).select("source", "size", "ref", "copies"))
        left = folded.filter("left is not null").select("source", "class", F.expr(f"chunk div {FOLD}").alias("chunk"), F.col("left").alias("item"))
        if deepest <= 1:
            break
        deepest, items = -(-deepest // FOLD), left
    missing = _missing(targets, reduce(DataFrame.unionByName, decided))
    roots = left.select("source", "item").unionByName(few_items).groupBy("source").agg(in_order)
    decided.append(_rooted(materialize(join_sums(roots, missing, ["source"]), "mix-roots"), seed, trials))
    return reduce(DataFrame.unionByName, decided), targets


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 17, few: int = FEW, trials: int = TRIALS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, size, source, source_size, target, copies, taken: how often each row goes into the mix.

    Sources, by code point and null last, take the weights in turn. A source's copy rate is target / source_size; every
    row gets its whole part, and the fractional parts are rounded by the pivotal method: two rows at a time, one hands
    its probability to the other at random until one of them is 0 or 1. Rows are folded in chunks of about FOLD rows of
    one source and size class; what is left of each chunk (one row at most) goes up a tree: FOLD chunks to one, then the
    classes of a source, with those of `few` rows at most as they are (a few hundred rows), whose last row is drawn. At the
    root this is done `trials` times, the rows in other orders; each outcome may be mended by taking one copy from a row and
    giving one to another, and the one nearest to the source's target counts. So there nearness to the target goes before
    the rows' own probabilities; trials=1 keeps them exactly. The copies of a size class stay within one of their
    expectation, and the words taken near the target. A source of any share is dealt over many chunks.

    Random numbers are hashes of the rows met, so reruns agree. Null text has size 0; a row of size 0 takes nothing. Null
    ids and null sources are rows like others. Equal rows are counted before anything is gathered, and each is given back,
    as many of them taken once more as their rates add up to. Texts of any length are one row's work. Other columns are
    ignored, whatever their names; an empty table gives none.
    """
    identity = [F.col(c) for c in (id_col, text_col, source_col)]
    out, targets = _decided(docs, identity, weights, share, most, seed, few, trials, id_col, text_col, source_col)
    nth = F.explode(F.sequence(F.lit(1).cast("long"), F.col("ref.repeats"))).alias("nth")
    out = out.select("source", "size", F.col("ref.doc_id").alias("doc_id"), F.col("ref.repeats").alias("repeats"), F.col("copies").alias("all"), nth)
    copies = F.expr("all div repeats + cast(nth <= all % repeats as int)").cast("int")
    out = out.select("source", "size", "doc_id", copies.alias("copies"))
    return join_sums(out, targets, ["source"]).select("doc_id", "size", "source", "source_size", "target", "copies", (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def apply_mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 17, few: int = FEW, trials: int = TRIALS, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of docs, each as often as the mix takes it (see `mix`); all columns stay, whatever their names.

    Rows are told apart by all their columns. Equal rows are interchangeable, so one stands for all of them and comes as
    often as they do together. Rows without a word go; null ids and sources are rows like others; an empty table stays empty.
    """
    identity = [hashable(docs, c) for c in docs.columns]
    decided, _ = _decided(docs, identity, weights, share, most, seed, few, trials, id_col, text_col, source_col)
    copies = materialize(decided.filter("copies > 0").select("ref.h1", "ref.h2", "ref.repeats", "copies"), "mix-copies")
    rows = as_rows(docs, h1=F.xxhash64(*identity), h2=F.xxhash64(F.lit("second"), *identity))
    out = rows.join(copies.filter("repeats = 1"), ["h1", "h2"]).select("row", "copies")
    repeated = copies.filter("repeats > 1")
    if not repeated.isEmpty():
        out = out.unionByName(rows.join(repeated, ["h1", "h2"]).groupBy("h1", "h2").agg(F.first("row").alias("row"), F.first("copies").alias("copies")).select("row", "copies"))
    return from_rows(out.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))), docs)
