"""Sharding by Karmarkar-Karp differencing: shards of near-equal bytes out of groups that stay whole."""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import as_rows, hashable, materialize

#: A unit over this part of a shard's fair share is placed before all others.
HEAVY = 256


def difference(parts: list[list[int]], n_bins: int) -> list[list[int]]:
    """Karmarkar-Karp: place the bins of many partial partitions into n_bins bins.

    parts[i] is a list of n_bins sums (one bin each; a single weight is [w, 0, ...]). The two partial partitions with the
    largest spread are combined again and again, the largest bin of one with the smallest of the other. Returns, for each
    part, the final bin of each of its bins. Ties go by position, so equal input gives equal output.
    """
    heap, bins, tree = [], {}, {}
    for i, sums in enumerate(parts):
        order = sorted(range(n_bins), key=lambda b: (-sums[b], b))
        bins[i] = [(sums[b], (i, b)) for b in order]
        heap.append((-(sums[order[0]] - sums[order[-1]]), i))
    heapq.heapify(heap)
    new = len(parts)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        joined = []
        for (x, left), (y, right) in zip(bins.pop(a), reversed(bins.pop(b)), strict=True):
            node = (new, len(joined))
            tree[node] = (left, right)
            joined.append((x + y, node))
        joined.sort(key=lambda e: -e[0])
        bins[new] = joined
        heapq.heappush(heap, (-(joined[0][0] - joined[-1][0]), new))
        new += 1
    out = [[0] * n_bins for _ in parts]
    for _, root in heap:
        for final, (_, node) in enumerate(bins[root]):
            stack = [node]
            while stack:
                at = stack.pop()
                if at in tree:
                    stack.extend(tree[at])
                else:
                    out[at[0]][at[1]] = final
    return out


def _level(units: DataFrame, n_bins: int, fan_in: int) -> DataFrame:
    """Combine partial partitions (part, bin, bytes), fan_in parts to a task, into (part, bin, up, up_bin, bytes)."""

    def combine(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["part", "bin"], kind="stable")
        ids = list(dict.fromkeys(rows["part"]))
        where = {p: i for i, p in enumerate(ids)}
        sums = [[0] * n_bins for _ in ids]
        for p, b, w in zip(rows["part"], rows["bin"], rows["bytes"], strict=True):
            sums[where[p]][int(b)] += int(w)
        final = difference(sums, n_bins)
        rows["up_bin"] = [final[where[p]][int(b)] for p, b in zip(rows["part"], rows["bin"], strict=True)]
        return rows[["part", "bin", "up", "up_bin", "bytes"]]

    up = units.withColumn("up", F.floor(F.col("part") / fan_in).cast("long"))
    return up.groupBy("up").applyInPandas(combine, "part long, bin int, up long, up_bin int, bytes long")


def shard_documents(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text", chunk_groups: int = 4096, fan_in: int = 1024, slot_block: int = 20_000) -> DataFrame:
    """Place every row into one of n_shards shards of near-equal bytes; rows of equal text stay together.

    Size is the UTF-8 bytes of the text plus 1 (null text: 1). Groups are hashed into chunks of about chunk_groups; each
    chunk is differenced by one task into n_shards partial bins, and the bins of fan_in chunks at a time are differenced
    again up to the root, so no task sees more than a bounded number of groups. A group is never torn apart, however large:
    one of more than a fair share fills a shard alone, and the others share the rest as evenly as if it were not there.
    slot numbers the rows of a shard from 0 without gaps, by prefix sums over blocks of rows, in the order of a hash, then
    of id and text, so reruns agree.

    Null text is a group of its own and differs from empty text. Null ids and repeated rows are kept, each with a slot.
    A text of any length is one unit of its size. An empty table gives an empty result. Other columns are ignored, whatever
    their names.
    """
    return _sharded(docs, {}, n_shards, id_col, text_col, chunk_groups, fan_in, slot_block)


def apply_shards(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text", chunk_groups: int = 4096, fan_in: int = 1024, slot_block: int = 20_000) -> DataFrame:
    """The rows of docs with all their columns, and beside them size, text_crc32, law, shard, slot and grown_shard of
    `shard_documents`, in whose place a column of docs of the same name goes.

    Places are found without the texts, which are moved once, to meet their place. Rows are told apart by all their columns;
    equal ones are brought down to one before they meet, and come back once for each of their slots. An empty table stays
    empty.
    """
    identity = [hashable(docs, c) for c in docs.columns]
    keys = {"r1": F.xxhash64(*identity), "r2": F.xxhash64(F.lit("second"), *identity)}
    dealt = materialize(_sharded(docs, keys, n_shards, id_col, text_col, chunk_groups, fan_in, slot_block), "shard-dealt")
    added = ["size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    counts = materialize(dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "shard-repeated")
    rows = as_rows(docs, **keys)
    dealt = dealt.select(*keys, *added)
    out = rows.join(dealt.join(counts, [*keys], "left_anti"), [*keys]).select("row", *added)
    if not counts.isEmpty():
        one = rows.join(counts, [*keys], "left_semi").groupBy(*keys).agg(F.first("row").alias("row"))
        out = out.unionByName(one.join(dealt.join(counts, [*keys], "left_semi"), [*keys]).select("row", *added))
    return out.select(*[F.col("row").getField(c).alias(c) for c in docs.columns if c.lower() not in added], *added)


def _sharded(docs: DataFrame, carried: dict[str, Column], n_shards: int, id_col: str, text_col: str, chunk_groups: int, fan_in: int, slot_block: int) -> DataFrame:
    """`shard_documents`, with narrow columns of docs carried along; rows equal in id and text are in their order."""
    size = F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long") + 1
    base = materialize(
        docs.select(
            F.col(id_col).alias("doc_id"),
            size.alias("size"),
            F.crc32(F.encode(F.coalesce(F.col(text_col), F.lit("")), "UTF-8")).alias("text_crc32"),
            F.xxhash64(text_col).alias("h1"),
            F.xxhash64(F.lit("second"), F.col(text_col)).alias("h2"),
            *[v.alias(k) for k, v in carried.items()],
        ),
        "shard-base",
    )
    share = max(1, (base.agg(F.sum("size")).first()[0] or 0) // n_shards)
    units = materialize(base.groupBy("h1", "h2").agg(F.sum("size").alias("bytes")), "shard-units")
    # Units over share / HEAVY, at most n_shards * HEAVY of them, are placed first, by one task; each chunk of others then
    # starts from those shards' sums, in proportion to its bytes, so that small units make up for uneven large ones.
    heavy = units.filter(F.col("bytes") > share // HEAVY)
    light = units.filter(F.col("bytes") <= share // HEAVY)
    n_light, light_bytes = light.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    n_chunks = max(1, -(-n_light // chunk_groups))
    chunk = F.pmod(F.xxhash64("h2", "h1"), F.lit(n_chunks)).alias("part")

    def place(start: list[int]):
        def run(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["bytes", "h1", "h2"], ascending=False, kind="stable")
            mine = int(rows["bytes"].sum())
            given = [x * mine // max(1, light_bytes) for x in start]
            final = difference([given, *([int(w)] + [0] * (n_shards - 1) for w in rows["bytes"])], n_shards)
            return rows.assign(bin=[f[0] for f in final[1:]])[["h1", "h2", "part", "bin", "bytes"]]

        return run

    out = "h1 long, h2 long, part long, bin int, bytes long"
    first = materialize(heavy.select("*", F.lit(n_chunks).cast("long").alias("part")).groupBy("part").applyInPandas(place([0] * n_shards), out), "shard-heavy")
    sums = {r["bin"]: r["bytes"] for r in first.groupBy("bin").agg(F.sum("bytes").alias("bytes")).collect()}
    start = sorted((sums.get(b, 0) for b in range(n_shards)), reverse=True)
    rest = materialize(light.select("*", chunk).groupBy("part").applyInPandas(place(start), out), "shard-light")
    placed = first.unionByName(rest)

    level = placed.groupBy("part", "bin").agg(F.sum("bytes").alias("bytes"))
    route = None  # (part, bin) of the first level -> (up, up_bin) of the level reached so far
    parts = n_chunks + 1
    while True:
        step = materialize(_level(level, n_shards, fan_in), "shard-level")
        here = step.select("part", "bin", "up", "up_bin")
        if route is None:
            route = here
        else:
            route = route.join(here.select(F.col("part").alias("up"), F.col("bin").alias("up_bin"), F.col("up").alias("up2"), F.col("up_bin").alias("bin2")), ["up", "up_bin"]).select("part", "bin", F.col("up2").alias("up"), F.col("bin2").alias("up_bin"))
        parts = -(-parts // fan_in)
        if parts <= 1:
            break
        level = step.groupBy(F.col("up").alias("part"), F.col("up_bin").alias("bin")).agg(F.sum("bytes").alias("bytes"))

    where = placed.join(route, ["part", "bin"]).select("h1", "h2", "part", F.col("up_bin").alias("shard"))
    # Heavy units are few, and their places go to the rows wherever these are; the rows of a light one are few.
    few = materialize(where.filter(F.col("part") == n_chunks).drop("part"), "shard-heavy-places")
    light_rows = base.join(F.broadcast(few.select("h1", "h2")), ["h1", "h2"], "left_anti").join(where.filter(F.col("part") < n_chunks).drop("part"), ["h1", "h2"])
    placed_rows = base.join(F.broadcast(few), ["h1", "h2"]).unionByName(light_rows)
    n_blocks = max(1, -(-base.count() // (slot_block * n_shards)))
    block = F.pmod(F.xxhash64("doc_id", "h1", F.lit("slot")), F.lit(n_blocks)).alias("block")
    rows = materialize(placed_rows.select("doc_id", "size", "text_crc32", "shard", block, "h1", "h2", *carried), "shard-rows")
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n")).select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = F.row_number().over(Window.partitionBy("shard", "block").orderBy("doc_id", "h1", "h2", *carried))
    return (
        rows.withColumn("within", within)
        .join(offsets, ["shard", "block"])
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("offset") + F.col("within") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), *carried)
    )
