"""Exact dense retrieval by products of matrix blocks: Arrow batches of vectors times a broadcast block of queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Numbers of a block of queries that is broadcast (rows x dimension), and cells of one product.
QUERY_VALUES, CELLS = 4_000_000, 2_000_000

#: Cosines (rows x queries) and the batch they are of, to scores.
Score = Callable[[np.ndarray, pa.RecordBatch], np.ndarray]


def rounded(x: np.ndarray) -> np.ndarray:
    """Six places, halves away from zero."""
    return np.copysign(np.floor(np.abs(x) * 1e6 + 0.5), x) / 1e6 + 0.0


def unit_rows(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A column of vectors as a matrix of rows of length 1, in double, and which rows these are; a zero vector stays, a null
    one is left out."""
    there = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    column = column.take(pa.array(there))
    if not len(column):
        return np.zeros((0, 0)), there
    matrix = column.flatten().fill_null(0).to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    length = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return matrix / np.where(length == 0, 1, length), there


def cosines(rows: np.ndarray, queries: np.ndarray) -> np.ndarray:
    return rounded(np.clip(rows @ queries.T, -1.0, 1.0))


def best_of(score: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best of each row by (score down, doc up): scores and docs, k to a row, -inf where there are fewer.

    score: rows x candidates, doc: the same shape. Only what reaches a row's k-th score is sorted.
    """
    if score.shape[1] > k:
        least = np.partition(score, score.shape[1] - k, axis=1)[:, score.shape[1] - k]
    else:
        least = np.full(len(score), -np.inf)
    row, at = np.nonzero((score >= least[:, None]) & (score > -np.inf))
    s, d = score[row, at], doc[row, at]
    order = np.lexsort((d, -s, row))
    row, s, d = row[order], s[order], d[order]
    nth = np.arange(len(row)) - np.searchsorted(row, row)
    row, s, d, nth = (x[nth < k] for x in (row, s, d, nth))
    out, docs = np.full((len(score), k), -np.inf), np.zeros((len(score), k), np.int64)
    out[row, nth], docs[row, nth] = s, d
    return out, docs


def query_blocks(queries: DataFrame, id_col: str, vector_col: str) -> Iterator[DataFrame]:
    """A stated query set in parts of at most about QUERY_VALUES numbers: its rows are counted first."""
    first = queries.filter(F.col(vector_col).isNotNull()).select(F.size(vector_col)).first()
    n = max(1, -(-queries.count() * (first[0] if first else 1) // QUERY_VALUES))
    for i in range(n):
        yield queries if n == 1 else queries.filter(F.pmod(F.xxhash64(id_col), F.lit(n)) == i)


def _products(vectors: DataFrame, queries: DataFrame, id_col: str, vector_col: str, extra: tuple[str, ...], schema: str, run) -> DataFrame:
    """run(pieces, query ids, query table) over (cosines, ids, batch) of all rows, for each block of queries."""
    out = None
    for block in query_blocks(queries, id_col, vector_col):
        found = block.toArrow().combine_chunks()
        matrix, there = unit_rows(found[vector_col].combine_chunks())
        found = found.take(pa.array(there))
        shared = vectors.sparkSession.sparkContext.broadcast((matrix, found.drop_columns([vector_col])))

        def pieces(batches, shared=shared):
            matrix, _ = shared.value
            step = max(1, CELLS // max(1, len(matrix)))
            for batch in batches:
                for start in range(0, batch.num_rows, step):
                    part = batch.slice(start, step)
                    rows, there = unit_rows(part.column(vector_col))
                    if len(rows) and len(matrix):
                        part = part.take(pa.array(there))
                        yield cosines(rows, matrix), part.column(id_col).to_numpy(), part

        def task(batches, shared=shared, pieces=pieces):
            table = shared.value[1]
            yield from run(pieces(batches), table[id_col].to_numpy(), table)

        mine = vectors.select(F.col(id_col).cast("long").alias(id_col), vector_col, *extra).mapInArrow(task, schema)
        out = mine if out is None else out.unionByName(mine)
    return out


def nearest(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", others: bool = True, score: Score | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """(query, doc, score): the k rows of vectors that are best for each query, from each task; a top k over them is exact.

    queries: a stated set, counted and broadcast in blocks of a bounded number of values. Each Arrow batch is one matrix
    product with a block; a task carries k rows a query from batch to batch, and hands on k x queries rows at its end,
    whatever it read. Scores are cosines rounded to six places, or what `score` makes of them and of the `extra` columns; ties
    go to the smaller id. others: queries are rows of the same table and do not meet themselves. Ids are whole numbers. Rows
    without a vector are not found, and queries without one find nothing; vectors of zero have cosine 0.
    """

    def run(pieces, ids, _table):
        best, docs = np.full((len(ids), k), -np.inf), np.zeros((len(ids), k), np.int64)
        for cos, rows, batch in pieces:
            found = cos if score is None else rounded(score(cos, batch))
            if others:
                found = np.where(rows[:, None] == ids[None, :], -np.inf, found)
            best, docs = best_of(np.concatenate([best, found.T], axis=1), np.concatenate([docs, np.broadcast_to(rows, (len(ids), len(rows)))], axis=1), k)
        row, at = np.nonzero(best > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(ids[row], pa.int64()), pa.array(docs[row, at], pa.int64()), pa.array(best[row, at])], names=["query", "doc", "score"])

    q = queries.select(F.col(id_col).cast("long").alias(id_col), vector_col)
    return _products(vectors, q, id_col, vector_col, extra, "query long, doc long, score double", run)


def similar_pairs(vectors: DataFrame, queries: DataFrame, least: float, same: str, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query, doc, cos) of all other rows with at least a cosine and the query's value in column `same`; see `nearest`."""

    def run(pieces, ids, table):
        # Values of both sides as codes; what no query has matches none.
        codes = {v: i for i, v in enumerate(dict.fromkeys(table[same].to_pylist()))}
        mine = np.array([codes[v] for v in table[same].to_pylist()], np.int64)
        for cos, rows, batch in pieces:
            theirs = np.array([-1 if v is None else codes.get(v, -1) for v in batch.column(same).to_pylist()], np.int64)
            row, at = np.nonzero((cos >= least) & (rows[:, None] != ids[None, :]) & (theirs[:, None] == mine[None, :]))
            yield pa.RecordBatch.from_arrays([pa.array(ids[at], pa.int64()), pa.array(rows[row], pa.int64()), pa.array(cos[row, at])], names=["query", "doc", "cos"])

    q = queries.select(F.col(id_col).cast("long").alias(id_col), vector_col, same)
    return _products(vectors, q, id_col, vector_col, (same,), "query long, doc long, cos double", run)
