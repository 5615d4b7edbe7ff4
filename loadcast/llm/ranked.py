"""Ranked lexical search by NRA over impact-sorted lists.

A document scores, for each term of an item, the term's weight times a saturated
term frequency, in whole numbers. Documents are dealt in blocks of bounded size; a
block keeps, for every term some item asks for, a list of (document, impact) in
descending impact. For an item the lists of its terms are read in step, and only
forward. A document's score lies between what it was read with (lower) and that
plus the last impact read from each list it has not been met in (upper; 0 for a
list at its end). Documents whose upper bound cannot reach the k-th lower bound,
ties by id included, are out, read or not. Reading goes on until no more than ``k``
documents are left and the bounds of each are equal: membership, ties and scores
are then settled. The k-th result of a task's earlier blocks is a bound as well, so
that most later blocks stop early.

Plan. One pass counts documents, terms and the documents that hold each asked
term (partial sums, at most a row per asked term and task); a second one runs the
blocks and returns at most ``k`` rows an item and task; a window merges them.
Documents are not shuffled. Items are dealt by hash to waves of ``WAVE_BYTES`` of
text, each broadcast, with as many passes as waves; a list of a frequent term is
cut by the blocks, so no task holds it whole.

Rows: null text, or text without terms, matches nothing and does not count. Rows
repeated under one ``doc_id`` are documents each; a null ``doc_id`` stands behind
the others in ties. Equal items are answered once, different ones of one id one by
one; an item without terms, or whose terms no document holds, has no rows. Empty
tables give an empty result. Extra columns are not looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadcast.llm.store import cut

K = 20
#: Documents and terms of a block.
BLOCK_DOCS = 8192
BLOCK_TERMS = 4_000_000
#: Documents times lists that are read together.
CELLS = 32_000_000
#: First step of a read; it doubles from read to read.
STEP = 256
#: Text of the items that are broadcast together.
WAVE_BYTES = 8 * 1024 * 1024

# ASCII other than letters and digits parts terms; every other byte belongs to one.
_PARTS = bytes(ord(chr(b).lower()) if chr(b).isalnum() else 32 for b in range(128)) + bytes(range(128, 256))

Lists = list[tuple[np.ndarray, np.ndarray]]


def terms_of(text: bytes | None) -> list[bytes]:
    """Terms of a UTF-8 text, A-Z lower-cased."""
    return text.translate(_PARTS).split() if text else []


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Wave:
    """Items asked together: their ids, terms with repeats, and all terms."""

    def __init__(self, items: list[tuple[int | None, bytes]]):
        self.ids, self.terms, self.known = [], [], {}
        for item, text in items:
            counts = Counter(terms_of(text))
            if counts:
                self.ids.append(item)
                self.terms.append([(self.known.setdefault(t, len(self.known)), c) for t, c in counts.items()])

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the asked terms among ``words``, and how often each is there."""
        x = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        return np.unique(x[x >= 0], return_counts=True)


# --- one block ------------------------------------------------------------------

def nra(lists: Lists, n: int, k: int, floor: tuple[int, int] = (0, 0)) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of the ``k`` best of ``n`` documents, exact, unordered.

    ``lists``: places and impacts in descending impact. A document counts if its
    score is above ``floor[0]``, or equal to it at a place before ``floor[1]``.
    """
    if len(lists) * n > CELLS and n > 1:
        half = n // 2
        low = [(p[p < half], x[p < half]) for p, x in lists]
        high = [(p[p >= half] - half, x[p >= half]) for p, x in lists]
        a = nra([x for x in low if len(x[0])], half, k, floor)
        b = nra([x for x in high if len(x[0])], n - half, k, (floor[0], floor[1] - half))
        places, scores = np.concatenate([a[0], b[0] + half]), np.concatenate([a[1], b[1]])
        top = np.lexsort((places, -scores))[:k]
        return places[top], scores[top]
    lower = np.zeros(n, np.int64)
    met = np.zeros((len(lists), n), bool)
    front = np.array([x[0] for _, x in lists], np.int64)  # no impact is above the first
    left, upper = np.arange(n), np.full(n, front.sum())
    depth, step = 0, STEP
    while True:
        low = lower[left]
        bound = floor
        if len(left) >= k:
            kth = int(np.partition(low, len(low) - k)[len(low) - k])
            if kth > bound[0] or kth == bound[0] > 0:
                place = int(left[low == kth][k - 1 - int((low > kth).sum())]) + 1
                bound = (kth, min(place, bound[1]) if kth == bound[0] else place)
        stay = (upper > bound[0]) | ((upper == bound[0]) & (left < bound[1]) & (upper > 0))
        left, low, upper = left[stay], low[stay], upper[stay]
        if len(left) <= k and (low == upper).all():
            return left, low
        for t, (places, impacts) in enumerate(lists):
            part = places[depth:depth + step]
            if len(part):
                lower[part] += impacts[depth:depth + step]
                met[t, part] = True
                front[t] = impacts[depth + len(part) - 1] if depth + len(part) < len(impacts) else 0
        depth, step = depth + step, 2 * step
        upper = lower[left] + front.sum() - front @ met[:, left]


class Block:
    """Impact-sorted lists of some documents."""

    def __init__(self, docs: list, sizes: list[int], hits: list, weights: np.ndarray, n_docs: int, n_terms: int):
        self.null = np.array([d is None for d in docs])
        self.ids = np.array([d or 0 for d in docs], np.int64)
        order = np.lexsort((self.ids, self.null))  # the order of ties
        self.ids, self.null = self.ids[order], self.null[order]
        self.named = int((~self.null).sum())
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        m = np.array([75 + 25 * n * n_docs // n_terms for n in sizes], np.int64)
        of = np.repeat(np.arange(len(sizes)), [len(t) for t, _ in hits])
        term, tf = (np.concatenate(x) for x in zip(*hits))
        impact = weights[term] * (1_000_000_000 * tf // (1000 * tf + 12 * m[of]))
        some = impact > 0
        term, impact, at = term[some], impact[some], place[of[some]]
        sort = np.lexsort((at, -impact, term))
        self.at, self.impact = at[sort], impact[sort]
        names, first = np.unique(term[sort], return_index=True)
        self.part = {t: slice(lo, hi) for t, lo, hi in zip(names.tolist(), first, [*first[1:], len(sort)])}

    def best(self, terms: list[tuple[int, int]], k: int, known: list[tuple]) -> list[tuple]:
        """The ``k`` best of ``known`` and this block as (-score, null, id)."""
        lists = [(self.at[self.part[t]], self.impact[self.part[t]] * c) for t, c in terms if t in self.part]
        if not lists:
            return known
        floor = (0, 0)
        if len(known) == k:
            score, null, doc = known[-1]
            floor = (-score, len(self.ids) if null else int(np.searchsorted(self.ids[:self.named], doc)))
        places, scores = nra(lists, len(self.ids), k, floor)
        found = zip((-scores).tolist(), self.null[places].tolist(), self.ids[places].tolist())
        return sorted([*known, *found])[:k]


# --- tasks ----------------------------------------------------------------------

_DOCUMENTS, _TERMS = -1, -2


def _count(wave):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: Wave = wave.value
        holds = np.zeros(len(asked.known), np.int64)
        docs = terms = 0
        for batch in batches:
            for text in batch.column("text"):
                words = terms_of(text.as_py())
                if words:
                    docs += 1
                    terms += len(words)
                    holds[asked.hits(words)[0]] += 1
        some = np.flatnonzero(holds)
        yield pa.RecordBatch.from_arrays([pa.array([_DOCUMENTS, _TERMS, *some.tolist()], pa.int64()),
                                          pa.array([docs, terms, *holds[some].tolist()], pa.int64())], ["key", "n"])

    return task


def _rank(wave, weights, n_docs: int, n_terms: int, k: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked: Wave = wave.value
        best: list[list[tuple]] = [[] for _ in asked.ids]
        docs, sizes, hits, held = [], [], [], 0

        def settle() -> None:
            block = Block(docs, sizes, hits, weights.value, n_docs, n_terms)
            for q, terms in enumerate(asked.terms):
                best[q] = block.best(terms, k, best[q])

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                words = terms_of(text.as_py())
                if not words:
                    continue
                docs.append(doc)
                sizes.append(len(words))
                hits.append(asked.hits(words))
                held += len(words)
                if len(docs) >= BLOCK_DOCS or held >= BLOCK_TERMS:
                    settle()
                    docs, sizes, hits, held = [], [], [], 0
        if docs:
            settle()
        rows = [(q, asked.ids[q], None if null else doc, -score) for q, found in enumerate(best) for score, null, doc in found]
        if rows:
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], ["q", "item_id", "doc_id", "score"])

    return task


# --- the search -----------------------------------------------------------------

def search(items: DataFrame, docs: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each item with
    a score above 0. ``items``: item_id, text; ``docs``: doc_id, text."""
    spark = items.sparkSession
    sc = spark.sparkContext
    asked = cut(items.select(F.col("item_id").cast("long").alias("item_id"), F.encode("text", "UTF-8").alias("text"))
                .where("text is not null").distinct())
    size = asked.agg(F.sum(F.octet_length("text") + 16).alias("b")).first()["b"] or 0
    waves = -(-int(size) // WAVE_BYTES)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode("text", "UTF-8").alias("text")).where("text is not null")
    found = []
    for w in range(waves):
        part = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(waves)) == w).collect()
        wave = Wave([(r.item_id, bytes(r.text)) for r in part])
        if not wave.ids:
            continue
        shared = sc.broadcast(wave)
        counts = {r.key: r.n for r in texts.select("text").mapInArrow(_count(shared), "key long, n long")
                  .groupBy("key").agg(F.sum("n").alias("n")).collect()}  # a row per asked term
        n_docs, n_terms = counts.get(_DOCUMENTS, 0), counts.get(_TERMS, 0)
        if not n_docs:
            continue
        weights = np.array([weight(n_docs, counts.get(t, 0)) for t in range(len(wave.known))], np.int64)
        got = texts.mapInArrow(_rank(shared, sc.broadcast(weights), n_docs, n_terms, k),
                               "q int, item_id long, doc_id long, score long")
        order = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = got.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
            "item_id", "rank", "doc_id", "score")
        found.append(ranked if waves == 1 else cut(ranked))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)
