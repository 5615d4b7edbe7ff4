"""Embedding near-dedup by an epsilon grid order join.

Vectors link when their labels are equal and their cosine, in double precision,
is at least ``cosine``. On unit vectors that is a distance of at most
``eps = sqrt(2 - 2 * cosine)``.

1. Equal vectors of a label become one point with a multiplicity, summed before
   the shuffle, so thousands of copies are one point.
2. The leading principal directions come from the summed moments of all points
   (one small matrix). Points are sorted by label and by their grid cells of side
   ``eps`` along those directions, and cut into blocks of a bounded number of
   points: intervals of the grid order.
3. Blocks meet on the label and the cells of the first direction, next cells
   included; pairs whose bounding boxes along the directions lie further apart than ``eps`` are
   provably distant and skipped. Projection never lengthens a distance, so nothing
   is lost.
4. A block pair is joined recursively: intervals are halved while their boxes are
   within ``eps``, and small ones are compared by a matrix product. A pair returns
   a count per point and at most one edge per point, never its links.

Rows: a null label or ``vec_id``, a null, empty or zero vector, or one with null
or non-finite components links with nothing. Vectors of different length are not
compared. Repeated rows are vectors of their own for ``n_links``; rows with one
``vec_id`` are one node. Ties at the threshold link. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.graph import components
from loadcast.llm.store import cut, shuffle_partitions
from loadcast.llm.text import digest

COSINE = 0.98
DIRECTIONS = 6
BLOCK = 256
LEAF = 64
#: Allowance for rounding in the projections; only widens what is compared.
SLACK = 1e-9


def valid(embedding) -> F.Column:
    """A vector that has a direction."""
    inf = F.lit(float("inf"))
    fine = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < inf))
    return F.coalesce(fine & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _units(column: pa.Array) -> np.ndarray:
    """Unit vectors (rows) of a column of equally long vectors."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = flat.reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares stay in range
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per vector length: count, sum and sum of outer products of a task."""
    from pyspark import TaskContext

    sums: dict[int, list] = {}
    for batch in batches:
        dims = batch.column("dim").to_numpy()
        for d in np.unique(dims).tolist():
            u = _units(batch.column("embedding").filter(pa.array(dims == d)))
            own = sums.setdefault(d, [0, np.zeros(d), np.zeros((d, d))])
            own[0] += len(u)
            own[1] += u.sum(axis=0)
            own[2] += u.T @ u
    yield _as_moments(sums, TaskContext.get().partitionId())


def _as_moments(sums: dict[int, list], lane: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(sums), pa.int32()), pa.array([lane % 32] * len(sums), pa.int32()),
         pa.array([s[0] for s in sums.values()], pa.int64()),
         pa.array([s[1].tobytes() for s in sums.values()], pa.binary()),
         pa.array([s[2].tobytes() for s in sums.values()], pa.binary())], ["dim", "lane", "n", "first", "second"])


def _add_moments(group: pa.Table) -> pa.Table:
    d = group.column("dim")[0].as_py()
    total = [0, np.zeros(d), np.zeros((d, d))]
    for n, a, b in zip(*(group.column(c) for c in ("n", "first", "second"))):
        total[0] += n.as_py()
        total[1] += np.frombuffer(a.as_py())
        total[2] += np.frombuffer(b.as_py()).reshape(d, d)
    return pa.Table.from_batches([_as_moments({d: total}, group.column("lane")[0].as_py())])


def directions(points: DataFrame, count: int = DIRECTIONS) -> dict[int, np.ndarray]:
    """Vector length → its leading principal directions (as columns). At most 32
    small matrices per length reach the driver."""
    parts = (points.mapInArrow(_moments, "dim int, lane int, n long, first binary, second binary")
             .groupBy("dim", "lane").applyInArrow(_add_moments, "dim int, lane int, n long, first binary, second binary"))
    sums: dict[int, list] = {}
    for r in parts.toLocalIterator():
        own = sums.setdefault(r.dim, [0, np.zeros(r.dim), np.zeros((r.dim, r.dim))])
        own[0] += r.n
        own[1] += np.frombuffer(bytes(r.first))
        own[2] += np.frombuffer(bytes(r.second)).reshape(r.dim, r.dim)
    out = {}
    for d, (n, first, second) in sums.items():
        mean = first / n
        _, vectors = np.linalg.eigh(second / n - np.outer(mean, mean))
        out[d] = vectors[:, ::-1][:, :count]
    return out


def _cells(axes: dict[int, np.ndarray], eps: float):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cells = np.zeros((len(dims), DIRECTIONS), np.int32)
            for d in np.unique(dims).tolist():
                at = dims == d
                seen = _units(batch.column("embedding").filter(pa.array(at))) @ axes[d]
                cells[at, :seen.shape[1]] = np.floor(seen / eps)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(cells[:, k]) for k in range(DIRECTIONS)]],
                [*batch.schema.names, *[f"c{k}" for k in range(DIRECTIONS)]])

    return task


_BLOCKS = ("block long, label string, dim int, lo array<double>, hi array<double>, first int, last int, "
           "units binary, h1 binary, h2 binary, times binary, rep binary")


def _pack(axes: dict[int, np.ndarray], eps: float):
    """Runs of sorted points as blocks that hold one label and vector length."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            labels, dims = batch.column("label").to_pylist(), batch.column("dim").to_pylist()
            start = 0
            while start < len(labels):
                stop = start + 1
                while stop < len(labels) and stop - start < BLOCK and labels[stop] == labels[start] and dims[stop] == dims[start]:
                    stop += 1
                part = batch.slice(start, stop - start)
                u = _units(part.column("embedding"))
                seen = u @ axes[dims[start]]
                cell = np.floor(seen[:, 0] / eps).astype(int)
                as_long = lambda c: part.column(c).to_numpy().astype("<i8").tobytes()  # noqa: E731, B023
                row = (number, labels[start], dims[start], seen.min(axis=0).tolist(), seen.max(axis=0).tolist(),
                       int(cell.min()), int(cell.max()), u.tobytes(), as_long("h1"), as_long("h2"), as_long("times"), as_long("rep"))
                kinds = (pa.int64(), pa.string(), pa.int32(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.int32(), pa.int32(),
                         *[pa.binary()] * 5)
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)],
                                                 [x.split()[0] for x in _BLOCKS.split(", ")])
                number += 1
                start = stop

    return task


class Interval:
    """A run of a block in grid order, with the box of its projections."""

    def __init__(self, units: np.ndarray, seen: np.ndarray, start: int):
        self.units, self.seen, self.start = units, seen, start
        self.lo, self.hi = seen.min(axis=0), seen.max(axis=0)
        self._halves: tuple[Interval, Interval] | None = None

    def halves(self) -> tuple[Interval, Interval]:
        if self._halves is None:
            m = len(self.units) // 2
            self._halves = (Interval(self.units[:m], self.seen[:m], self.start),
                            Interval(self.units[m:], self.seen[m:], self.start + m))
        return self._halves


def join_intervals(a: Interval, b: Interval, eps: float, cosine: float, hits: np.ndarray) -> None:
    """Marks in ``hits`` the pairs of ``a`` and ``b`` that link."""
    gap = np.maximum(0, np.maximum(b.lo - a.hi, a.lo - b.hi))
    if gap @ gap > (eps + SLACK) ** 2:
        return
    if len(a.units) <= LEAF and len(b.units) <= LEAF:
        hits[a.start:a.start + len(a.units), b.start:b.start + len(b.units)] = a.units @ b.units.T >= cosine
    elif len(a.units) >= len(b.units):
        for half in a.halves():
            join_intervals(half, b, eps, cosine, hits)
    else:
        for half in b.halves():
            join_intervals(a, half, eps, cosine, hits)


def _spanning(hits: np.ndarray, reps_a: np.ndarray, reps_b: np.ndarray) -> list[tuple[int, int]]:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(hits)):
        a, b = int(reps_a[i]), int(reps_b[j])
        p, q = root(a), root(b)
        if p != q:
            parent[p] = q
            out.append((a, b))
    return out


def _join_blocks(axes: dict[int, np.ndarray], eps: float, cosine: float):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                sides = []
                for s in ("a", "b"):
                    units = np.frombuffer(r[f"units_{s}"]).reshape(-1, r["dim"])
                    columns = {c: np.frombuffer(r[f"{c}_{s}"], "<i8") for c in ("h1", "h2", "times", "rep")}
                    sides.append((units, columns))
                (ua, a), (ub, b) = sides
                own = r["block_a"] == r["block_b"]
                axis = axes[r["dim"]]
                hits = np.zeros((len(ua), len(ub)), bool)
                join_intervals(Interval(ua, ua @ axis, 0), Interval(ub, ub @ axis, 0), eps, cosine, hits)
                if own:
                    np.fill_diagonal(hits, False)
                add = hits @ b["times"]
                h1, h2, counts = a["h1"], a["h2"], add
                if not own:
                    h1, h2 = np.concatenate([h1, b["h1"]]), np.concatenate([h2, b["h2"]])
                    counts = np.concatenate([add, hits.T @ a["times"]])
                some = counts > 0
                edges = _spanning(hits, a["rep"], b["rep"])
                # Counts and edges share the rows: an edge row has no digest.
                n, e = int(some.sum()), len(edges)
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([*h1[some].tolist(), *[None] * e], pa.int64()), pa.array([*h2[some].tolist(), *[None] * e], pa.int64()),
                         pa.array([*counts[some].tolist(), *[None] * e], pa.int64()),
                         pa.array([*[None] * n, *[x for x, _ in edges]], pa.int64()),
                         pa.array([*[None] * n, *[y for _, y in edges]], pa.int64())], ["h1", "h2", "links", "a", "b"])

    return task


def near_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row per row of ``vectors``."""
    eps = math.sqrt(2 - 2 * cosine)
    h1, h2 = digest("label", "embedding")
    ok = valid(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", "embedding", h1.alias("h1"), h2.alias("h2"),
                          F.coalesce(ok, F.lit(False)).alias("ok"))
    points = cut(rows.where("ok").groupBy("h1", "h2").agg(
        F.count("*").alias("times"), F.min("vec_id").alias("rep"), F.first("label").cast("string").alias("label"),
        F.first("embedding").alias("embedding")).withColumn("dim", F.size("embedding")))
    axes = directions(points)
    keys = ["label", "dim", *[f"c{k}" for k in range(DIRECTIONS)], "h1"]
    celled = points.mapInArrow(_cells(axes, eps), points.schema.simpleString()[len("struct<"):-1]
                               + "".join(f", c{k} int" for k in range(DIRECTIONS)))
    ordered = celled.repartitionByRange(shuffle_partitions(vectors.sparkSession), *keys).sortWithinPartitions(*keys)
    blocks = cut(ordered.mapInArrow(_pack(axes, eps), _BLOCKS))
    heads = blocks.select("block", "label", "dim", "lo", "hi", "first", "last")
    x = heads.select(*[F.col(c).alias(f"{c}_a") for c in heads.columns], F.explode(F.sequence("first", "last")).alias("cell_a"))
    y = heads.select(*[F.col(c).alias(f"{c}_b") for c in heads.columns],
                     F.explode(F.sequence(F.col("first") - 1, F.col("last") + 1)).alias("cell_b"))
    gaps = F.aggregate(F.zip_with(F.zip_with("lo_a", "hi_b", lambda p, q: p - q), F.zip_with("lo_b", "hi_a", lambda p, q: p - q),
                                  lambda p, q: F.greatest(p, q, F.lit(0.0))), F.lit(0.0), lambda s, g: s + g * g)
    pairs = cut(x.join(y, (F.col("label_a") == F.col("label_b")) & (F.col("dim_a") == F.col("dim_b"))
                       & (F.col("cell_a") == F.col("cell_b")))
                .where((F.col("block_a") <= F.col("block_b")) & (gaps <= (eps + SLACK) ** 2))
                .select("block_a", "block_b").distinct())
    load = lambda s: blocks.select("block", "dim", "units", "h1", "h2", "times", "rep").select(
        F.col("block").alias(f"block_{s}"), *([F.col("dim")] if s == "a" else []),
        *[F.col(c).alias(f"{c}_{s}") for c in ("units", "h1", "h2", "times", "rep")])
    found = cut(pairs.join(load("a"), "block_a").join(load("b"), "block_b").mapInArrow(
        _join_blocks(axes, eps, cosine), "h1 long, h2 long, links long, a long, b long"))
    links = found.where("links is not null").groupBy("h1", "h2").agg(F.sum("links").alias("links"))
    per_class = points.select("h1", "h2", "times", "rep").join(links, ["h1", "h2"], "left").select(
        F.col("h1").alias("g1"), F.col("h2").alias("g2"), "rep", (F.coalesce("links", F.lit(0)) + F.col("times") - 1).alias("n"))
    named = cut(rows.select("vec_id", F.when(F.col("ok"), F.col("h1")).alias("h1"), F.when(F.col("ok"), F.col("h2")).alias("h2"))
                .join(per_class, (F.col("h1") == F.col("g1")) & (F.col("h2") == F.col("g2")), "left")
                .select("vec_id", "rep", "n"))
    edges = found.where("a is not null").select("a", "b").unionByName(
        named.where("rep != vec_id").select(F.col("vec_id").alias("a"), F.col("rep").alias("b")))
    comp = components(edges)
    return (named.join(comp, named["vec_id"] == comp["id"], "left")
            .select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component", "vec_id").alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
