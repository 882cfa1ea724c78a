"""Lexical and dense retrieval, their union, and re-ranking."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vectors as V
from ..functions.arrays import counted
from ..sources.scratch import materialize
from .dense import Score, nearest
from .ranges import largest

#: Saturation and length normalisation of the lexical score.
K1, B = 1.5, 0.75
LEAST_DF, MOST_TERMS = 2, 400_000
#: Candidates of each arm of a hybrid query, and those that are re-ranked and scored.
MOST_LEXICAL, MOST_DENSE, MOST_RERANKED = 1500, 1500, 200
#: Rows of a block of queries that is broadcast: (query, term), and vectors.
BLOCK_ROWS, VECTOR_ROWS = 200_000, 20_000


def top_k(df: DataFrame, key: str, k: int, *order: Column, rank: str = "rank") -> DataFrame:
    """The first k rows of each key with their rank; Spark prunes each partition to k rows a key before the shuffle."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


@dataclass(frozen=True)
class Index:
    """lists: (doc, terms array<struct<term, n>>), one row a document; terms: (term, df, cf) kept; lengths: (doc, dl, norm) of
    kept terms; stats: one row (n_docs, avgdl). All are written tables."""

    lists: DataFrame
    terms: DataFrame
    lengths: DataFrame
    stats: DataFrame


def smooth_idf() -> Column:
    return F.log((1.0 + F.col("n_docs")) / (1 + F.col("df"))) + 1


def build_index(docs: DataFrame, id_col: str, text_col: str, least_df: int = LEAST_DF, most_terms: int = MOST_TERMS) -> Index:
    """The terms kept are those in least_df documents or more, the most frequent most_terms of them.

    A document is one row, so its terms are counted where it is, and written once for all that follows. Only counts by term
    and sums by document are shuffled; the terms kept, a bounded number, are broadcast. The arms of one query read the same
    tables. Corpus statistics are those of `docs` as given: filter before, and they are the filtered corpus's.
    """
    lists = materialize(docs.select(F.col(id_col).alias("doc"), counted(T.tokens(F.col(text_col))).alias("terms")), "lists")
    tf = lists.select("doc", F.explode("terms").alias("t")).select("doc", "t.term", F.col("t.n").cast("long").alias("tf"))
    found = materialize(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf")).filter(F.col("df") >= least_df), "terms")
    terms = materialize(largest(found, most_terms, "cf", "term"), "terms-kept")
    n_docs = docs.agg(F.count(F.lit(1)).alias("n_docs"))
    total = terms.agg(F.sum("cf").alias("total"))
    avgdl = F.coalesce(F.nullif(F.col("total") / F.col("n_docs"), F.lit(0.0)), F.lit(1.0))
    stats = materialize(n_docs.crossJoin(total).select("n_docs", avgdl.alias("avgdl")), "corpus")
    weight = F.col("tf") * smooth_idf()
    kept = tf.join(F.broadcast(terms.select("term", "df")), "term").crossJoin(F.broadcast(stats.select("n_docs")))
    lengths = materialize(kept.groupBy("doc").agg(F.sum("tf").alias("dl"), F.sqrt(F.sum(weight * weight)).alias("norm")), "lengths")
    return Index(lists, terms, lengths, stats)


def query_terms(queries: DataFrame, q_id: str, q_text: str) -> DataFrame:
    """(query, term, qtf)"""
    return queries.select(F.col(q_id).alias("query"), F.explode(counted(T.tokens(F.col(q_text)))).alias("t")).select("query", "t.term", F.col("t.n").alias("qtf"))


def matched(terms: DataFrame, index: Index) -> DataFrame:
    """(doc, term, tf, df, dl, norm) of the documents' terms that any of the queries' terms is.

    The queries' vocabulary meets the lists where they are; only pairs that hit move, to meet their document's length. A
    vocabulary too large to broadcast is taken in blocks, each a pass over the lists.
    """
    vocabulary = materialize(index.terms.select("term", "df").join(terms.select("term").distinct(), "term", "left_semi"), "vocabulary")
    out = []
    for mine in in_blocks(vocabulary, "term"):
        hits = index.lists.select("doc", F.explode("terms").alias("t")).select("doc", "t.term", F.col("t.n").cast("long").alias("tf")).join(F.broadcast(mine), "term")
        out.append(hits)
    return reduce(DataFrame.unionByName, out).join(index.lengths, "doc")


def in_blocks(queries: DataFrame, key: str, most_rows: int = BLOCK_ROWS) -> list[DataFrame]:
    """A stated query set in parts that are each small enough to broadcast: its rows are counted first."""
    n = max(1, -(-queries.count() // most_rows))
    return [queries if n == 1 else queries.filter(F.pmod(F.xxhash64(key), F.lit(n)) == i) for i in range(n)]


def _each(blocks: list[DataFrame], score: Callable[[DataFrame], DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [score(b) for b in blocks])


def bm25_scores(queries: DataFrame, index: Index, q_id: str, q_text: str, hits: DataFrame | None = None) -> DataFrame:
    """(query, doc, score) of all documents that share a kept term with a query.

    hits: what `matched` gives for these queries, where several arms use it. Pairs that hit are dealt by document, and meet
    the queries there, so sums by query and document need no further shuffle. A top k after this moves k rows a query out of
    each partition.
    """
    terms = query_terms(queries, q_id, q_text).select("query", "term")
    hits = matched(terms, index) if hits is None else hits
    idf = F.log(1 + (F.col("n_docs") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("dl") / F.col("avgdl")))
    # One row of statistics: the only cross joins here are with it.
    weighed = hits.crossJoin(F.broadcast(index.stats)).select("doc", "term", weight.alias("w"))

    def score(mine: DataFrame) -> DataFrame:
        return weighed.join(F.broadcast(mine), "term").groupBy("query", "doc").agg(F.sum("w").alias("score"))

    return _each(in_blocks(terms, "query"), score)


def tfidf_cosine(queries: DataFrame, index: Index, q_id: str, q_text: str, hits: DataFrame | None = None) -> DataFrame:
    """(query, doc, score): cosine of tf-idf vectors over the terms kept, a dense arm that needs no encoder. hits: see
    `bm25_scores`."""
    terms = query_terms(queries, q_id, q_text)
    hits = matched(terms, index) if hits is None else hits
    one = F.broadcast(index.stats.select("n_docs"))
    q = terms.join(index.terms.select("term", "df"), "term").crossJoin(one).select("query", "term", (F.col("qtf") * smooth_idf()).alias("qw"))
    q = materialize(q.withColumn("qnorm", F.sqrt(F.sum(F.col("qw") * F.col("qw")).over(Window.partitionBy("query")))), "query-weights")
    weighed = hits.crossJoin(one).select("doc", "term", (F.col("tf") * smooth_idf()).alias("w"), "norm")
    score = (F.sum(F.col("qw") * F.col("w")) / F.max(F.col("qnorm") * F.col("norm"))).alias("score")
    return _each(in_blocks(q, "query"), lambda mine: weighed.join(F.broadcast(mine), "term").groupBy("query", "doc").agg(score))


def dice_pairs(queries: DataFrame, docs: DataFrame, q_id: str, q_text: str, d_id: str, d_text: str) -> DataFrame:
    """(query, doc, dice): Dice coefficient of distinct tokens for all pairs that share one, counted where the document is."""
    q = queries.select(F.col(q_id).alias("query"), F.array_distinct(T.tokens(F.col(q_text))).alias("a"))
    d = docs.select(F.col(d_id).alias("doc"), F.array_distinct(T.tokens(F.col(d_text))).alias("b")).repartition("doc")
    qi = q.select("query", F.size("a").alias("la"), F.explode("a").alias("t"))
    di = d.select("doc", F.size("b").alias("lb"), F.explode("b").alias("t"))
    n = F.count(F.lit(1))
    return _each(in_blocks(qi, "query"), lambda mine: di.join(F.broadcast(mine), "t").groupBy("query", "doc").agg((2.0 * n / (F.max("la") + F.max("lb"))).alias("dice")))


def cosine_scores(vectors: DataFrame, queries: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", keep: tuple[str, ...] = (), on: Column | None = None, others: bool = True) -> DataFrame:
    """(query, doc, cos, keep ...): cosine of a stated query set with all other rows, a counted block of queries at a time.

    on: a further condition on columns of both, those of the queries with the prefix q_. others: queries are rows of the
    same table and do not meet themselves.
    """
    base = vectors.select(F.col(id_col).alias("doc"), V.l2_normalize(F.col(vector_col)).alias("d"), *keep)
    q = queries.select(F.col(id_col).alias("query"), V.l2_normalize(F.col(vector_col)).alias("q"), *[F.col(c).alias(f"q_{c}") for c in queries.columns if c not in (id_col, vector_col)])
    other = F.col("query") != F.col("doc") if others else F.lit(True)
    cos = F.round(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), V.dot(F.col("q"), F.col("d")))), 6).alias("cos")
    return _each(in_blocks(q, "query", VECTOR_ROWS), lambda mine: base.join(F.broadcast(mine), other if on is None else on & other).select("query", "doc", cos, *keep))


def cosine_top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding", others: bool = True, score: Score | None = None, extra: tuple[str, ...] = ()) -> DataFrame:
    """(query, doc, score, rank): exact nearest vectors of a stated query set, by matrix products (see dense.nearest).

    Each task hands on its k best of each query.
    """
    return top_k(nearest(vectors, queries, k, id_col, vector_col, others, score, extra), "query", k, F.desc("score"), F.col("doc"))


def union_candidates(*arms: DataFrame) -> DataFrame:
    """(query, doc) found by any arm."""
    out = arms[0].select("query", "doc")
    for arm in arms[1:]:
        out = out.unionByName(arm.select("query", "doc"))
    return out.distinct()


def dice(a: Column, b: Column) -> Column:
    return 2.0 * F.size(F.array_intersect(a, b)) / F.greatest(F.size(a) + F.size(b), F.lit(1))


def dice_score(a: Column, b: Column) -> Column:
    """0..100: Dice coefficient times 145, rounded half to even."""
    return F.greatest(F.lit(0), F.least(F.lit(100), F.bround(F.least(F.lit(100.0), dice(a, b) * 145)).cast("int")))


Scorer = Callable[[Column, Column], Column]


def rerank_tokens(text: Column, chars: int) -> Column:
    """Distinct tokens of the first `chars` characters, as hashes: what the default re-ranker compares. For once a text,
    before texts are joined to pairs. The cut is that of a cross-encoder's input."""
    return F.transform(F.array_distinct(T.simple_tokens(F.lower(F.left(text, F.lit(chars))))), lambda t: F.xxhash64(t))


def rerank(candidates: DataFrame, k: int, query: Column, document: Column, scorer: Scorer = dice) -> DataFrame:
    """The k best candidates of each query by a scorer of (query, document), with position pos.

    The default scorer is the Dice coefficient of rerank_tokens; a model goes in as a pandas UDF of two text columns.
    """
    scored = candidates.withColumn("rerank", F.round(scorer(query, document), 9))
    return top_k(scored, "query", k, F.desc("rerank"), F.col("doc"), rank="pos")


#: Characters of a query and of a document that a re-ranker is given.
QUERY_CHARS, DOCUMENT_CHARS = 300, 800


def blended(cosine: Column, promise: Column) -> Column:
    """0.6 cosine + 0.4 promise (0..100), both within [0, 1]."""
    unit = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    return 0.6 * unit(cosine) + 0.4 * unit(F.coalesce(promise, F.lit(0)) / 100.0)
