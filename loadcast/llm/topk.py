"""Exact top-k search by exhaustive term-at-a-time accumulation.

Rows are sparse vectors: the terms they hold and an integer weight for each. The
score of a candidate for a query is the integer inner product. Every task turns a
block of candidates into postings, a list of (row, weight) per term; each query
walks its own terms and scatters its weight times the posting into a dense array
with a score for every row of the block. The best ``k`` of a block come from a
partition selection (no sort of the block), are merged with the task's best so
far, and the tasks' lists are merged by a window that keeps ``k`` rows a query.

Plan and bounds. Candidates are read where they lie and are not shuffled; a task
holds one block of ``BLOCK`` rows and ``k`` rows for each query. Queries are a
stated set, dealt by hash to as many waves as hold ``WAVE_BYTES`` each; a wave is
broadcast, so its size is bounded whatever the number of queries. All rows of all
blocks are scored: nothing is skipped.

Rows: a null vector, or one with null or non-finite components, takes no part; a
zero or empty vector scores 0 with all. Components beyond a long count as the
nearest long, and so do scores. Vectors of different lengths meet in the terms
both have. A row is no candidate for queries of its own id. Rows without an id ask
nothing and are candidates like any other, behind the others in ties. Repeated
rows are candidates each; equal queries are asked once, different ones of one id
one by one. No rows, or no queries, give an empty result. Extra columns are not
looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadcast.llm.store import cut

K = 10
SCALE = 1024
ASKED = 100
#: Candidates that are scored together.
BLOCK = 8192
#: Terms and weights of the queries that are broadcast together.
WAVE_BYTES = 32 * 1024 * 1024
_LEAST = np.iinfo(np.int64).min
_MOST = np.iinfo(np.int64).max


def sparse_rows(rows: DataFrame, key: str, vector: str, scale: float = SCALE) -> DataFrame:
    """(id, terms, weights): the non-zero ``floor(scale * x)`` of each vector."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    held = F.filter(F.transform(vector, lambda x, i: F.struct(
        i.cast("int").alias("t"), F.floor(F.lit(float(scale)) * x.cast("double")).cast("long").alias("w"))),
        lambda s: s["w"] != 0)
    return (rows.where(F.col(vector).isNotNull() & fine)
            .select(F.col(key).cast("long").alias("id"), held.alias("s"))
            .select("id", F.col("s.t").alias("terms"), F.col("s.w").alias("weights")))


class Sparse:
    """Sparse rows of one Arrow batch as flat arrays."""

    def __init__(self, batch):
        ids = batch.column("id")
        self.null = np.asarray(ids.is_null())
        self.ids = np.asarray(pc.fill_null(ids, 0), np.int64)
        self.sizes = np.asarray(pc.list_value_length(batch.column("terms")), np.int64)
        self.terms = np.asarray(pc.list_flatten(batch.column("terms")), np.int64)
        self.weights = np.asarray(pc.list_flatten(batch.column("weights")), np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])

    def most(self) -> int:
        """The largest weight, without its sign."""
        return max((abs(int(f(self.weights))) for f in (np.min, np.max)), default=0) if len(self.weights) else 0

    def row(self, at: int) -> tuple[list[int], list[int]]:
        part = slice(self.starts[at], self.starts[at + 1])
        return self.terms[part].tolist(), self.weights[part].tolist()


def postings(block: Sparse, place: np.ndarray, kind) -> dict[int, tuple]:
    """Per term the places of the rows that hold it, and its weights there; a
    list of more than half of the rows is dense, with no places."""
    n = len(place)
    order = np.argsort(block.terms, kind="stable")
    rows = np.repeat(place, block.sizes)[order]
    weights = block.weights[order].astype(kind)
    names, first = np.unique(block.terms[order], return_index=True)
    out = {}
    for t, lo, hi in zip(names.tolist(), first, [*first[1:], len(order)]):
        if 2 * (hi - lo) > n:
            dense = np.zeros(n, kind)
            dense[rows[lo:hi]] = weights[lo:hi]
            out[t] = (None, dense)
        else:
            out[t] = (rows[lo:hi], weights[lo:hi])
    return out


def accumulate(lists: dict[int, tuple], terms: list[int], weights: list[int], n: int, kind) -> np.ndarray:
    """The scores of a block's rows for one query, term after term."""
    scores = np.zeros(n, kind)
    for t, w in zip(terms, weights):
        if t in lists:
            rows, held = lists[t]
            if rows is None:
                scores += held * w
            else:
                scores[rows] += held * w
    return scores


def select(scores: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores without ``own``; of equal ones the first."""
    left = np.ones(len(scores), bool)
    left[own] = False
    at = np.flatnonzero(left)
    if len(at) > k:
        x = scores[at]
        least = np.partition(x, len(x) - k)[len(x) - k]
        above = at[x > least]
        at = np.concatenate([above, at[x == least][:k - len(above)]])
    return at


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Sparse]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            yield Sparse(batch.slice(at, BLOCK))


def _search(wave, k: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: Sparse = wave.value
        most, longest = asked.most(), int(asked.sizes.max(initial=0))
        asked_rows = [asked.row(q) for q in range(len(asked.ids))]
        best = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))] * len(asked_rows)
        for block in _blocks(batches):
            n = len(block.ids)
            order = np.lexsort((block.ids, block.null))  # the order of ties
            place = np.empty(n, np.int64)
            place[order] = np.arange(n)
            ids, null = block.ids[order], block.null[order]
            named = int((~null).sum())
            bound = most * block.most() * longest
            kind = np.int32 if bound < 2**31 else np.int64 if bound < 2**63 else object
            lists = postings(block, place, kind)
            lo, hi = (np.searchsorted(ids[:named], asked.ids, side) for side in ("left", "right"))
            for q, (terms, weights) in enumerate(asked_rows):
                scores = accumulate(lists, terms, weights, n, kind)
                if kind is object:
                    scores = np.array([min(max(int(s), _LEAST), _MOST) for s in scores], np.int64)
                top = select(scores, np.arange(lo[q], hi[q]), k)
                got = [np.concatenate(x) for x in zip(best[q], (ids[top], null[top], scores[top].astype(np.int64)))]
                # Descending without a change of sign: the least long has no opposite.
                keep = np.lexsort((got[0], got[1], ~got[2]))[:k]
                best[q] = tuple(x[keep] for x in got)
        sizes = [len(b[0]) for b in best]
        if sum(sizes):
            ids, null, scores = (np.concatenate([b[c] for b in best]) for c in range(3))
            q = np.repeat(np.arange(len(best)), sizes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(q, pa.int32()), pa.array(asked.ids[q]), pa.array(ids, pa.int64(), mask=null), pa.array(scores)],
                ["q", "query_id", "vec_id", "score"])

    return task


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best candidates of each query.
    Both sides are sparse rows (``id``, distinct ``terms``, ``weights``)."""
    spark = queries.sparkSession
    asked = cut(queries.where(F.col("id").isNotNull()).distinct())
    size = asked.agg(F.sum(12 * F.size("terms") + 16).alias("b")).first()["b"] or 0
    waves = -(-int(size) // WAVE_BYTES)
    found = []
    for w in range(waves):
        part = asked.where(F.pmod(F.xxhash64("id", "terms", "weights"), F.lit(waves)) == w).toArrow().combine_chunks()
        if not part.num_rows:
            continue
        wave = spark.sparkContext.broadcast(Sparse(part.to_batches()[0]))
        got = candidates.select("id", "terms", "weights").mapInArrow(
            _search(wave, k), "q int, query_id long, vec_id long, score long")
        order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
        ranked = got.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
            "query_id", "rank", "vec_id", "score")
        found.append(ranked if waves == 1 else cut(ranked))
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return reduce(DataFrame.unionByName, found)


def asks(key: Column | str = "vec_id", every: int = ASKED) -> Column:
    """Whether a row is a query: its id is divisible by ``every``."""
    return F.pmod(F.col(key) if isinstance(key, str) else key, F.lit(every)) == 0


def search_vectors(vectors: DataFrame, k: int = K, every: int = ASKED, scale: float = SCALE) -> DataFrame:
    """The ``k`` best rows of ``vectors`` (vec_id, embedding) for each of its
    rows whose id is divisible by ``every``."""
    return top_k(sparse_rows(vectors.where(asks(every=every)), "vec_id", "embedding", scale),
                 sparse_rows(vectors, "vec_id", "embedding", scale), k)
