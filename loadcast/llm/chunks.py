"""Substring dedup by content-defined chunking.

A gear rolling hash runs over the bytes of every text; a chunk ends on a
character's border where the hash meets a mask, so cuts depend on the last 32 bytes
alone and fall at the same places after an insertion, in any script. Chunks are
identified by digest; the first holder of a digest, by (doc_id, row digest, offset),
keeps it, and every other occurrence is a duplicate. A passage seldom starts and
ends with a chunk: with ``to_ends`` both ends of a run of neighbouring duplicate
chunks grow as far as the bytes beyond equal the first holder's: ``BEFORE`` bytes at
most in front, where the cuts of two texts may take some chunks to fall together, and
the next chunk behind, since from a common cut on they part where the texts part. Runs of ``MIN_RUN`` bytes or more are removed from the text; shorter
ones stay, so a stock phrase does not cut a document up. Every byte removed stands
at an earlier place too.

Plan: one pass cuts and digests. Each task first reduces its chunks to one holder
per digest (what is not the first in its task is a duplicate for certain and goes
straight to its document), so a passage that every document holds sends one
holder per task. Holders travel in packed columns, a row per (task, bucket of
digests), and each bucket is settled in numpy. The chunks of repeated digests are
collected per document and joined to the texts. For the ends, each run sends the
bytes beyond it, keyed by the digest of its end chunk, and the first holders of the
digests so asked for send the bytes around them; these joins are Spark's own, which
splits a digest that many documents hold. The texts are shuffled once for all reads.

Rows: null or empty text has no chunks and stays null or empty. Rows equal in
``doc_id`` and text count as one holder and are treated alike; a null ``doc_id``
comes last in the order of holders. Where no hash meets the mask, text is cut at
``MAX_CHUNK`` bytes, on a character's border. Extra columns pass in ``dedup``.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadcast.llm.store import cut, shuffle_partitions
from loadcast.llm.text import digest, fresh

MIN_CHUNK = 24
MAX_CHUNK = 256
#: One in ``MASK + 1`` character borders ends a chunk.
MASK = 15
MIN_RUN = 100
#: Bytes a run can grow in front.
BEFORE = 2 * MAX_CHUNK
#: Chunks a task holds before it sends its holders on.
HELD_CHUNKS = 400_000
NO_ID = np.iinfo(np.int64).max

_GEAR = np.random.Generator(np.random.PCG64(0x6EA4)).integers(0, 2**32, 256, dtype=np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """The rolling hash at each byte: sum of gear[b[i - j]] << j, modulo 2**32.

    Doubling the reach five times covers the 32 bytes that can matter.
    """
    h = _GEAR[data]
    for reach in (1, 2, 4, 8, 16):
        if len(h) > reach:
            h[reach:] = h[reach:] + (h[:-reach] << np.uint32(reach))
    return h


def cut_points(data: bytes) -> list[int]:
    """Ends of the chunks of ``data``; the last one is its length."""
    n = len(data)
    if not n:
        return []
    raw = np.frombuffer(data, np.uint8)
    marked = (gear(raw) >> np.uint32(24)) & np.uint32(MASK) == 0
    marked[:-1] &= raw[1:] & 0xC0 != 0x80
    ends, start = [], 0
    for stop in [*(np.flatnonzero(marked) + 1).tolist(), n]:
        while stop - start > MAX_CHUNK:
            near = start + MAX_CHUNK
            while data[near] & 0xC0 == 0x80:  # inside a character
                near -= 1
            ends.append(near)
            start = near
        if stop - start >= MIN_CHUNK or (stop == n and stop > start):
            ends.append(stop)
            start = stop
    return ends


_PACKED = "bucket int, known boolean, hi binary, lo binary, doc binary, row binary, at binary, size binary, twice binary"
_COLUMNS = (("hi", "<u8"), ("lo", "<u4"), ("doc", "<i8"), ("row", "<i8"), ("at", "<u4"),
            ("size", "u1"), ("twice", "?"))
_MARKS = "doc long, row long, at int, stop int, hi long, lo int, first boolean"


def _pack(bucket: np.ndarray, columns: list[np.ndarray], duplicate: bool) -> pa.RecordBatch:
    """A row per bucket, its columns as bytes; ``duplicate`` if known to be duplicates."""
    order = np.argsort(bucket, kind="stable")
    names, first = np.unique(bucket[order], return_index=True)
    edges = [*first.tolist(), len(bucket)]
    arrays = [pa.array(names, pa.int32()), pa.array([duplicate] * len(names), pa.bool_())]
    for column in columns:
        sorted_column = column[order]
        arrays.append(pa.array([sorted_column[a:b].tobytes() for a, b in zip(edges, edges[1:])], pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, ["bucket", "known", *[c for c, _ in _COLUMNS]])


def _settle(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Indices of the first holder of each digest, and of all others; for each first
    holder whether its digest is met at another place."""
    hi, lo, doc, row, at, _, twice = columns
    order = np.lexsort((at, row, doc, lo, hi))
    h, low, d, r, a = (c[order] for c in (hi, lo, doc, row, at))
    new = np.ones(len(order), bool)
    new[1:] = (h[1:] != h[:-1]) | (low[1:] != low[:-1])
    # The same row met twice (a repeated row) is not a second occurrence.
    same = np.zeros(len(order), bool)
    same[1:] = ~new[1:] & (d[1:] == d[:-1]) & (r[1:] == r[:-1]) & (a[1:] == a[:-1])
    group = np.cumsum(new) - 1
    begin = np.flatnonzero(new)[group]
    as_first = (d == d[begin]) & (r == r[begin]) & (a == a[begin])
    others = ~new & ~same & ~as_first
    repeated = np.zeros(int(new.sum()), bool)
    repeated[group[others | twice[order]]] = True
    return order[new], order[others], repeated


def _holders(buckets: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        held: list[list] = [[], [], [], [], []]
        digests: list[bytes] = []

        def send() -> Iterator[pa.RecordBatch]:
            both = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
            columns = [both[:, 0], (both[:, 1] & 0xFFFFFFFF).astype("<u4"),
                       np.repeat(np.array(held[0], "<i8"), held[2]),
                       np.repeat(np.array(held[1], "<i8"), held[2]), np.array(held[3], "<u4"),
                       np.array(held[4], "u1"), np.zeros(len(both), bool)]
            first, rest, repeated = _settle(columns)
            yield _pack((columns[0][first] % buckets).astype(np.int32),
                        [*[c[first] for c in columns[:-1]], repeated], False)
            if len(rest):
                yield _pack((columns[3][rest] % buckets).astype(np.int32), [c[rest] for c in columns], True)
            digests.clear()
            for x in held:
                x.clear()

        for batch in batches:
            for doc, row, text in zip(batch.column("doc_id").to_pylist(), batch.column("_r1").to_pylist(),
                                      batch.column("text")):
                data = text.as_py()
                if not data:
                    continue
                start, n, seen = 0, 0, len(digests)
                for stop in cut_points(data):
                    digests.append(xxhash.xxh3_128_digest(data[start:stop]))
                    held[3].append(start)
                    held[4].append(stop - start - 1)  # up to 255
                    start = stop
                n = len(digests) - seen
                held[0].append(NO_ID if doc is None else doc)
                held[1].append(row)
                held[2].append(n)
                if len(digests) >= HELD_CHUNKS:
                    yield from send()
        if digests:
            yield from send()

    return task


def _repeated(group: pa.Table) -> pa.Table:
    """The chunks of one bucket whose digest is met at several places."""
    def joined(name: str, kind: str, known: bool) -> np.ndarray:
        parts = [x.as_py() for x, k in zip(group.column(name), group.column("known")) if k.as_py() == known]
        return np.frombuffer(b"".join(parts), kind)

    columns = [joined(c, kind, False) for c, kind in _COLUMNS]
    first, rest, repeated = _settle(columns) if len(columns[0]) else (np.zeros(0, np.int64),) * 2 + (np.zeros(0, bool),)
    first = first[repeated]
    hi, lo, doc, row, at, size = (np.concatenate([c[first], c[rest], joined(name, kind, True)])
                            for (name, kind), c in list(zip(_COLUMNS, columns))[:6])
    return pa.table({"doc": doc, "row": row, "at": at.astype(np.int32),
                     "stop": (at + size + np.uint32(1)).astype(np.int32), "hi": hi.view(np.int64),
                     "lo": lo.view(np.int32), "first": np.arange(len(hi)) < len(first)})


def repeated_chunks(rows: DataFrame) -> DataFrame:
    """(doc, row, marks): for each document its chunks whose digest is met at several
    places, by byte offsets and digest, and whether it is the first holder.
    ``rows``: doc_id long, _r1 long, text as bytes."""
    buckets = 4 * shuffle_partitions(rows.sparkSession)
    packed = rows.mapInArrow(_holders(buckets), _PACKED)
    found = packed.groupBy("bucket").applyInArrow(_repeated, _MARKS)
    return found.groupBy("doc", "row").agg(F.collect_set(F.struct("at", "stop", "hi", "lo", "first")).alias("marks"))


_RUN = "start int, stop int, hi1 long, lo1 int, hi2 long, lo2 int"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The runs of neighbouring duplicate chunks, with the digests of their first and
    last chunk, in order."""
    kind = pa.list_(pa.struct([(n, pa.int64() if n[:2] == "hi" else pa.int32())
                               for n, _ in (f.split() for f in _RUN.split(", "))]))
    for batch in batches:
        out = []
        for marks in batch.column("marks"):
            runs: list[dict] = []
            dup = sorted((m["at"], m["stop"], m["hi"], m["lo"]) for m in marks.as_py() if not m["first"])
            for at, stop, hi, lo in dup:
                if runs and runs[-1]["stop"] == at:
                    runs[-1].update(stop=stop, hi2=hi, lo2=lo)
                else:
                    runs.append(dict(start=at, stop=stop, hi1=hi, lo1=lo, hi2=hi, lo2=lo))
            out.append(runs)
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("row"), pa.array(out, kind)], ["doc", "row", "runs"])


_AROUND = "hi long, lo int, left binary, right binary"
_BEYOND = f"{_AROUND}, doc long, row long, start int, stop int"


def _around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes before and behind each first holder of a digest asked for."""
    for batch in batches:
        out: list[tuple] = []
        for text, asked in zip(batch.column("_bytes"), batch.column("asked")):
            data = text.as_py() if asked.is_valid else b""
            for m in asked.as_py() or []:
                out.append((m["hi"], m["lo"], data[max(m["at"] - BEFORE, 0):m["at"]] if m["left"] else None,
                            data[m["stop"]:m["stop"] + MAX_CHUNK] if m["right"] else None))
        yield _rows(out, _AROUND)


def _beyond(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes beyond each end of each run, by the digest of its end chunk."""
    for batch in batches:
        out: list[tuple] = []
        for text, doc, row, runs in zip(*(batch.column(c) for c in ("_bytes", "doc", "row", "runs"))):
            own = runs.as_py() or []
            data = text.as_py() if own else b""
            for r, before, after in zip(own, [0, *[x["stop"] for x in own]], [*[x["start"] for x in own[1:]], len(data)]):
                place = (doc.as_py(), row.as_py(), r["start"], r["stop"])
                left = data[max(r["start"] - BEFORE, before):r["start"]]
                right = data[r["stop"]:min(r["stop"] + MAX_CHUNK, after)]
                out += [(r["hi1"], r["lo1"], left, None, *place)] if left else []
                out += [(r["hi2"], r["lo2"], None, right, *place)] if right else []
        yield _rows(out, _BEYOND)


def _rows(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields)],
                                      [name for name, _ in fields])


def _alike(a: bytes, b: bytes) -> int:
    """Bytes that ``a`` and ``b`` have in common from the start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return int(np.argmax(np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)))


def _grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes beyond each end that the holder has as well."""
    for batch in batches:
        out: list[tuple] = []
        doc, row, start, stop, left, right, h_left, h_right = (
            batch.column(c).to_pylist() for c in ("doc", "row", "start", "stop", "left", "right", "h_left", "h_right"))
        for i in range(batch.num_rows):
            if left[i] is not None:
                grown = (start[i] - _alike(left[i][::-1], h_left[i][::-1]), start[i])
            else:
                grown = (stop[i], stop[i] + _alike(right[i], h_right[i]))
            if grown[1] > grown[0]:
                out.append((doc[i], row[i], *grown))
        yield _rows(out, "doc long, row long, a int, b int")


def _asked(marked: DataFrame, runs: DataFrame) -> DataFrame:
    """(doc, row, asked): the first holders of the digests at which runs end."""
    run = runs.select(F.explode("runs").alias("r"))
    ends = run.select(F.explode(F.array(
        F.struct(F.col("r.hi1").alias("hi"), F.col("r.lo1").alias("lo"), F.lit(True).alias("left")),
        F.struct(F.col("r.hi2").alias("hi"), F.col("r.lo2").alias("lo"), F.lit(False).alias("left")))).alias("e")).select("e.*")
    wanted = ends.groupBy("hi", "lo").agg(F.max("left").alias("left"), F.max(~F.col("left")).alias("right"))
    first = marked.select("doc", "row", F.explode(F.filter("marks", lambda m: m["first"])).alias("m")).select("doc", "row", "m.*")
    return first.join(wanted, ["hi", "lo"]).groupBy("doc", "row").agg(
        F.collect_set(F.struct("at", "stop", "hi", "lo", "left", "right")).alias("asked"))


def _grown(met: DataFrame) -> DataFrame:
    """(doc, row, grown): per document the spans by which its runs grow."""
    around = met.mapInArrow(_around, _AROUND).groupBy("hi", "lo").agg(
        F.max("left").alias("h_left"), F.max("right").alias("h_right"))
    both = met.mapInArrow(_beyond, _BEYOND).join(around, ["hi", "lo"])
    grown = both.mapInArrow(_grow, "doc long, row long, a int, b int")
    return grown.groupBy("doc", "row").agg(F.collect_set(F.struct("a", "b")).alias("grown"))


def _spans(data: bytes, pieces) -> list[tuple[int, int]]:
    """The byte spans to remove, from runs and what they grow by."""
    spans: list[list[int]] = []
    for a, b in sorted(pieces):
        while a < b and data[a] & 0xC0 == 0x80:  # inside a character
            a += 1
        while a < b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if spans and a <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], b)
        elif a < b:
            spans.append([a, b])
    return [(a, b) for a, b in spans if b - a >= MIN_RUN]


def _without(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[], [], [], [], []]
        for text, runs, grown in zip(*(batch.column(c) for c in ("_bytes", "runs", "grown"))):
            data = text.as_py()
            borders = [0, *cut_points(data or b"")]
            spans = _spans(data, [*[(r["start"], r["stop"]) for r in runs.as_py() or []],
                                  *[(g["a"], g["b"]) for g in grown.as_py() or []]])
            left, at, n_removed = [], 0, 0
            for a, b in spans:
                left.append(data[at:a])
                at = b
                n_removed += max(0, bisect_right(borders, b) - 1 - bisect_left(borders, a))
            kept = None if data is None else b"".join([*left, data[at:]]).decode()
            for x, v in zip(out, (len(borders) - 1, n_removed, sum(b - a for a, b in spans),
                                  [{"start": a, "end": b} for a, b in spans], kept)):
                x.append(v)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_doc"),
             pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
             pa.array(out[3], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
             pa.array(out[4], pa.string())],
            ["_doc", "_n", "_n_removed", "_gone", "_spans", "_left"])


def dedup(docs: DataFrame, to_ends: bool = False) -> DataFrame:
    """``docs`` without the repeated passages in ``text``, plus ``n_chunks``,
    ``n_removed_chunks`` (those wholly in removed spans), ``removed_bytes`` and
    ``removed`` (byte spans of the text as it was), under free names. ``to_ends``: whole passages, not only whole chunks."""
    r1, _ = digest("doc_id", "text")
    as_bytes = F.encode(F.col("text"), "UTF-8")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), r1.alias("_r1"), as_bytes.alias("text"))
    found = repeated_chunks(rows)
    whole = docs.select(
        F.struct(*[c for c in docs.columns if c != "text"]).alias("_doc"), as_bytes.alias("_bytes"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(int(NO_ID))).alias("doc"), r1.alias("row"))
    if to_ends:
        found = cut(found)
    runs = found.mapInArrow(_runs, f"doc long, row long, runs array<struct<{_RUN.replace(' ', ':').replace(',:', ',')}>>")
    if to_ends:
        marks = runs.join(_asked(found, runs), ["doc", "row"], "left")
        met = whole.join(marks, ["doc", "row"], "left").select("_doc", "_bytes", "doc", "row", "runs", "asked")
        met = met.join(_grown(met), ["doc", "row"], "left")
    else:
        met = whole.join(runs, ["doc", "row"], "left").withColumn(
            "grown", F.lit(None).cast("array<struct<a:int,b:int>>"))
    met = met.select("_doc", "_bytes", "runs", "grown")
    out = met.mapInArrow(_without, f"_doc {met.schema['_doc'].dataType.simpleString()}, _n long, _n_removed long, "
                                   "_gone long, _spans array<struct<start:int,end:int>>, _left string")
    names = {n: fresh(docs.columns, n) for n in ("n_chunks", "n_removed_chunks", "removed_bytes", "removed")}
    return out.select(
        *[F.col("_left").alias("text") if c == "text" else F.col("_doc")[c].alias(c) for c in docs.columns],
        F.col("_n").alias(names["n_chunks"]), F.col("_n_removed").alias(names["n_removed_chunks"]),
        F.col("_gone").alias(names["removed_bytes"]), F.col("_spans").alias(names["removed"]))
