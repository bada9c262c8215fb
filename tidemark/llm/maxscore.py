"""Exact top-k search by MaxScore over inverted postings.

A vector is a bag of weighted terms (its dimensions), a score the inner product. Candidates are dealt into shards, queries
into blocks; a task holds one shard and one block and keeps the postings of each term. For a query, a term's bound is the
most it can add within a part of the shard. Terms in ascending order of their bounds are non-essential while their bounds
together stay below the k-th best score so far: a candidate found under none of the other, essential terms cannot enter.
Postings of the essential terms are traversed; candidates that the open bounds still let in are probed in the
non-essential terms, largest bound first, and dropped once they fall behind. Shards are merged by rank.

Weights may be negative: a bound is then the larger of zero and what the ends of the weights' range give.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialise

#: Candidates whose postings are traversed together; the k-th best score is carried from one part to the next.
PART = 2048
#: Scores are 64-bit integers; vectors of which a score could come near their end are refused.
MOST_SCORE = 2.0**62
FOUND = "query_id long, vec_id long, score long"


class Postings:
    """Inverted lists of some vectors: for every term the rows that hold it, ascending, and their weights."""

    def __init__(self, matrix: np.ndarray):
        self.n = len(matrix)
        columns = [np.flatnonzero(c) for c in matrix.T]
        self.rows = columns
        self.weights = [c[r] for c, r in zip(matrix.T, columns, strict=True)]
        self.high = np.array([w.max(initial=0) for w in self.weights], np.int64)
        self.low = np.array([w.min(initial=0) for w in self.weights], np.int64)

    def add(self, scores: np.ndarray, term: int, weight: int) -> None:
        rows = self.rows[term]
        if len(rows) == self.n:
            scores += weight * self.weights[term]
        else:
            scores[rows] += weight * self.weights[term]

    def probe(self, candidates: np.ndarray, term: int) -> np.ndarray:
        """Weights of a term in the candidates, zero where it is absent."""
        rows, weights = self.rows[term], self.weights[term]
        if len(rows) == self.n:
            return weights[candidates]
        at = np.minimum(np.searchsorted(rows, candidates), max(len(rows) - 1, 0))
        return np.where(rows[at] == candidates, weights[at], 0) if len(rows) else np.zeros(len(candidates), np.int64)


def competitive(postings: Postings, query: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows that score ``least`` or more, and their scores."""
    terms = np.flatnonzero(query)
    bounds = np.maximum(query[terms] * postings.high[terms], query[terms] * postings.low[terms])
    order = np.argsort(bounds, kind="stable")
    terms, bounds = terms[order], bounds[order]
    open_bounds = np.cumsum(bounds)
    split = int(np.searchsorted(open_bounds, least))  # terms before it add up to less than the score needed
    scores = np.zeros(postings.n, np.int64)
    touched = np.zeros(postings.n, bool)
    for term in terms[split:][::-1]:
        postings.add(scores, term, query[term])
        touched[postings.rows[term]] = True
    rest = open_bounds[split - 1] if split else 0
    if rest >= least:  # what no list holds may still get in
        touched[:] = True
    rows = np.flatnonzero(touched & (scores + rest >= least))
    scores = scores[rows]
    for term, bound in zip(terms[:split][::-1], bounds[:split][::-1], strict=True):
        scores += query[term] * postings.probe(rows, term)
        rest -= bound
        stay = scores + rest >= least
        rows, scores = rows[stay], scores[stay]
    return rows, scores


def search(queries: pa.Table, shard: pa.Table, k: int):
    """The k best candidates of a shard for every query of a block; ties go to the smaller id."""
    if not queries.num_rows or not shard.num_rows:
        return
    ids, vectors = _matrix(shard)
    query_ids, weights = _matrix(queries)
    terms = max(vectors.shape[1], weights.shape[1])
    vectors, weights = (np.pad(m, ((0, 0), (0, terms - m.shape[1]))) for m in (vectors, weights))
    largest = [np.abs(m.astype(np.float64)).max(axis=0) for m in (vectors, weights)]
    if largest[0] @ largest[1] >= MOST_SCORE:
        raise OverflowError("inner products of these vectors may pass 64 bits; scale them down")
    best_ids = [np.zeros(0, np.int64)] * len(query_ids)
    best_scores = [np.zeros(0, np.int64)] * len(query_ids)
    for at in range(0, len(ids), PART):
        postings, own = Postings(vectors[at : at + PART]), ids[at : at + PART]
        for q in range(len(query_ids)):
            least = best_scores[q][k - 1] if len(best_scores[q]) == k else -math.inf
            rows, scores = competitive(postings, weights[q], least)
            other = own[rows] != query_ids[q]
            found, scores = np.r_[best_ids[q], own[rows[other]]], np.r_[best_scores[q], scores[other]]
            top = np.lexsort((found, -scores))[:k]
            best_ids[q], best_scores[q] = found[top], scores[top]
    counts = [len(x) for x in best_ids]
    columns = [np.repeat(query_ids, counts), np.concatenate(best_ids), np.concatenate(best_scores)]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])


def _matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and integer vectors, padded with zeros to the longest."""
    lists = table.column("vector").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), max(1, int(sizes.max(initial=0)))), np.int64)
    flat = lists.flatten().to_numpy()
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return table.column("vec_id").to_numpy(), out


def quantised(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 1024) -> DataFrame:
    """(vec_id, vector): floor(scale * x) of every component, row by row.

    Rows with a null id or vector, or a null or non-finite component, are left out.
    """
    x = F.col(vector_column)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    numbers = F.transform(x, lambda v: F.floor(v.cast("double") * scale))
    rows = vectors.where(F.col(id_column).isNotNull() & x.isNotNull() & finite)
    return rows.select(F.col(id_column).cast("long").alias("vec_id"), numbers.alias("vector"))


def top_k(
    candidates: DataFrame, queries: DataFrame, k: int = 10, shard_rows: int = 8192, block_queries: int = 1024
) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: the k best candidates by inner product for every query, exactly.

    Both sides are (vec_id, vector) with long components; a query's own id is no candidate of it. Every row counts: rows
    that repeat an id are candidates one by one, and query rows of one id share one list of k, the best of all their
    pairs with candidate rows. Rows are dealt by a number that is written first. Vectors of
    different lengths count missing components as zero. Ties go to the smaller id. Fewer candidates than k: all of them.
    Empty sides give none. Vectors so large that a score could reach 2**62 are an error, never a wrong score: floors that
    pass 64 bits are saturated and refused with them. Every query meets every candidate once, in shards and blocks of bounded size: candidates
    travel once per block of queries, queries once per shard.
    """
    number = F.monotonically_increasing_id().alias("number")
    sides = [materialise(s.select("vec_id", "vector", number), "numbered") for s in (candidates, queries)]
    shards, blocks = (max(1, math.ceil(s.count() / n)) for s, n in zip(sides, (shard_rows, block_queries), strict=True))

    def dealt(rows: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(other)
        return rows.select("*", F.pmod(F.xxhash64("number"), F.lit(n)).cast("int").alias(own), every)

    left = dealt(sides[1], "block", blocks, "shard", shards).groupBy("block", "shard")
    right = dealt(sides[0], "shard", shards, "block", blocks).groupBy("block", "shard")
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])
    found = left.cogroup(right).applyInArrow(lambda q, c: pa.Table.from_batches(search(q, c, k), schema), FOUND)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
