import math
import pathlib
import tempfile
import tracemalloc
import uuid
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from loadcast.llm import graph, jaccard, nearvec, store

from .fixtures import awkward, awkward_rows, clashing, empty, prose
from .test_rules_lines_chunks import FOLD, WORD


class Groups:
    def __init__(self):
        self.parent = {}

    def root(self, x):
        while self.parent.setdefault(x, x) != x:
            x = self.parent[x]
        return x

    def link(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.parent[b] = a


def word_sets(text):
    w = WORD.findall((text or "").translate(FOLD))
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute_join(rows):
    sets = [(i, word_sets(t)) for i, t, *_ in rows]
    groups = Groups()
    for k, (i, x) in enumerate(sets):
        if i is not None:
            groups.root(i)
            for j, y in sets[:k]:
                if x and y and j is not None and 100 * len(x & y) >= 75 * len(x | y):
                    groups.link(i, j)
    return Counter((i, len(s), None if i is None else groups.root(i)) for i, s in sets)


def near_copies(base, n, edits, seed):
    rng = np.random.default_rng(seed)
    out = []
    for k in range(n):
        w = base.split()
        for at in rng.choice(len(w), int(rng.integers(0, edits + 1)), replace=False):
            w[at] = f"new{seed}x{k}x{at}"
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("partitions", [1, 4])
def test_jaccard_join_matches_all_pairs(spark, partitions):
    rows = awkward_rows()
    texts = near_copies(prose(500, 150), 90, 8, 1) + near_copies(prose(501, 40), 20, 3, 2) + [prose(600 + k, k) for k in range(12)]
    texts += [" ".join("abcdefghij"[:k]) for k in range(1, 11)] * 2
    rows += [(1000 + k, t, "en", "s0", len(t)) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, awkward(spark).schema).repartition(partitions)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.join_documents(df).collect())
    assert got == brute_join(rows)


def test_large_groups_go_through_blocks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "PAIRED", 4)
    monkeypatch.setattr(jaccard, "BLOCK_SETS", 10)
    texts = near_copies(prose(700, 120), 60, 7, 3)
    rows = [(k, t, "en", "s0", len(t)) for k, t in enumerate(texts)]
    got = Counter((r.doc_id, r.n_shingles, r.component_id)
                  for r in jaccard.join_documents(spark.createDataFrame(rows, awkward(spark).schema)).collect())
    assert got == brute_join(rows)


def shipped(monkeypatch, name):
    """What goes through a function of the join that makes a group's task: rows in, rows out."""
    made = getattr(jaccard, name)
    folder = tempfile.mkdtemp(prefix="loadcast-test-")

    def counted(percent):
        task = made(percent)

        def group(table):
            out = task(table)
            with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                f.write(f"{table.num_rows} {out.num_rows}")
            return out

        return group

    monkeypatch.setattr(jaccard, name, counted)
    return lambda: [tuple(map(int, p.read_text().split())) for p in pathlib.Path(folder).iterdir()]


@pytest.mark.parametrize("blocks", [10, 256])
def test_only_sets_that_may_link_are_shipped_to_be_compared(spark, monkeypatch, blocks):
    """Two texts' near copies with much in common, but too little for a link: told
    apart by sketches, and blocks of one component never meet."""
    monkeypatch.setattr(jaccard, "BLOCK_SETS", blocks)
    sketched = shipped(monkeypatch, "_able")
    compared = [shipped(monkeypatch, name) for name in ("_settle", "_settle_set")]
    w = prose(900, 200).split()
    other = w[:150] + prose(901, 50).split()
    texts = near_copies(" ".join(w), 40, 1, 5) + near_copies(" ".join(other), 40, 1, 6)
    rows = [(k, t, "en", "s0", len(t)) for k, t in enumerate(texts)]
    got = Counter((r.doc_id, r.n_shingles, r.component_id)
                  for r in jaccard.join_documents(spark.createDataFrame(rows, awkward(spark).schema)).collect())
    assert got == brute_join(rows)
    assert len({c for *_, c in got}) == 2 and sketched()
    assert not any(f() for f in compared)


def test_sketches_lose_no_link():
    rng = np.random.default_rng(11)
    for _ in range(40):
        base = rng.integers(0, 2**63, 80, dtype=np.uint64)
        sets = [np.unique(np.concatenate([rng.permutation(base)[:int(rng.integers(50, 81))],
                                          rng.integers(0, 2**63, int(rng.integers(0, 9)), dtype=np.uint64)])) for _ in range(14)]
        comp, left = rng.integers(0, 5, 14), int(rng.choice([6, 14]))
        able = jaccard.may_link(comp, np.array([len(s) for s in sets]), [jaccard.sketch(s) for s in sets], left)
        for a in range(left):
            for b in range(14) if left == 14 else range(left, 14):
                if comp[a] != comp[b] and jaccard.similar(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b])):
                    assert able[a] and able[b]


def test_most_rows_that_did_not_pass_are_left_out_before_the_shuffle(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") % 7).alias("_r1"), F.lit(b"x").alias("text"))
    passed = rows.where("doc_id % 10 = 3").select("doc_id", F.col("_r1").alias("row"))
    got = {(r.doc_id, r._r1) for r in jaccard.likely(rows, passed).collect()}
    assert got >= {(k, k % 7) for k in range(3, 20_000, 10)} and len(got) < 5_000
    assert jaccard.likely(rows, passed.limit(0)).count() == 0


@pytest.mark.parametrize("held,bytes_", [(400, 2_000), (2_000_000, 64 * 1024 * 1024)])
def test_screen_counts_what_others_hold(spark, monkeypatch, held, bytes_):
    monkeypatch.setattr(jaccard, "HELD_SHINGLES", held)
    monkeypatch.setattr(jaccard, "BUCKET_BYTES", bytes_)
    passage = prose(800, 30)
    texts = [prose(810 + k, 20) + " " + passage * (k % 3 > 0) for k in range(40)] + [passage, passage, "one two", "one two", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.total, r.shared) for r in jaccard.shared_counts(jaccard._rows(df)).collect()}
    sets = [word_sets(t) for t in texts]
    times = Counter(x for s in sets for x in s)
    assert got == {k: (len(s), sum(times[x] > 1 for x in s)) for k, s in enumerate(sets)}


def test_links_of_a_few_sets_join_what_is_similar():
    rng = np.random.default_rng(7)
    for _ in range(30):
        base = rng.integers(0, 2**63, 60, dtype=np.uint64)
        sets = [np.unique(np.concatenate([rng.permutation(base)[:int(rng.integers(40, 61))],
                                          rng.integers(0, 2**63, int(rng.integers(0, 8)), dtype=np.uint64)])) for _ in range(12)]
        comp = rng.integers(0, 4, 12)
        got, want = Groups(), Groups()
        for k in range(12):
            for g in (got, want):
                g.link(("c", int(comp[k])), ("d", k))
        links = jaccard.set_links(np.arange(12), comp, sets)
        for a, b in links:
            assert jaccard.similar(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b]))
            got.link(("d", a), ("d", b))
        for a in range(12):
            for b in range(a):
                if jaccard.similar(len(np.intersect1d(sets[a], sets[b])), len(sets[a]), len(sets[b])):
                    want.link(("d", a), ("d", b))
        assert len(links) < 12 and {k: got.root(("d", k)) for k in range(12)} == {k: want.root(("d", k)) for k in range(12)}


@settings(max_examples=60, deadline=None)
@given(st.integers(3, 400), st.integers(0, 10**6))
def test_similar_sets_share_a_signature(size, seed):
    rng = np.random.default_rng(seed)
    pool = rng.integers(0, 2**63, 2 * size + 2, dtype=np.uint64)
    x = np.unique(pool[:size])
    # As many differences as the threshold allows, split at random between both.
    gone = int(rng.integers(0, size // 4 + 1))
    y = x[rng.permutation(len(x))[gone:]]
    room = max(0, int(len(y) / 0.75) - len(x))
    y = np.unique(np.concatenate([y, pool[size:size + int(rng.integers(0, room + 1))]]))
    if jaccard.similar(len(np.intersect1d(x, y)), len(x), len(y)) and len(np.setxor1d(x, y)):
        assert len(np.intersect1d(jaccard.signatures(x), jaccard.signatures(y)))


def test_keep_one_and_clashing_columns(spark):
    df = clashing(spark)
    out = jaccard.keep_one(df)
    assert out.columns == df.columns
    want = {i for i, _, c in brute_join(awkward_rows()) if i is None or i == c}
    assert {r.doc_id for r in out.collect()} == want
    assert jaccard.join_documents(empty(spark)).count() == 0


def test_components(spark):
    rng = np.random.default_rng(5)
    edges = [(k, k + 1) for k in range(100, 160)] + [(200, 300 + k) for k in range(50)]
    edges += [tuple(map(int, rng.integers(1000, 1100, 2))) for _ in range(70)] + [(7, 7)]
    order = rng.permutation(2000)
    edges = [(int(order[a]), int(order[b])) for a, b in edges]
    groups = Groups()
    for a, b in edges:
        groups.link(a, b)
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: groups.root(x) for e in edges for x in e}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute_vectors(rows):
    groups, links = Groups(), defaultdict(int)
    ok = lambda v, e, g: (v is not None and g is not None and bool(e) and all(x is not None and math.isfinite(x) for x in e)
                          and any(x != 0 for x in e))
    for k, (v, e, g) in enumerate(rows):
        if v is not None:
            groups.root(v)
        for j, (w, f, h) in enumerate(rows):
            if j != k and g == h and ok(v, e, g) and ok(w, f, h) and len(e) == len(f):
                a, b = np.array(e, float), np.array(f, float)
                if a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= 0.98:
                    links[k] += 1
                    groups.link(v, w)
    return Counter((v, links[k], None if v is None else groups.root(v)) for k, (v, e, g) in enumerate(rows))


@pytest.mark.parametrize("block", [256, 7])
def test_near_vectors_match_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(nearvec, "BLOCK", block)
    monkeypatch.setattr(nearvec, "LEAF", 4)
    rng = np.random.default_rng(block)
    centres = rng.standard_normal((12, 16))
    rows = []
    for k in range(160):
        x = centres[k % 12] + rng.standard_normal(16) * rng.choice([0.02, 0.15, 0.5])
        rows.append((k, [float(np.float32(v)) for v in x * rng.uniform(0.1, 9)], int(k % 3)))
    rows += [(500 + k, rows[0][1], rows[0][2]) for k in range(9)] + [(500, rows[0][1], rows[0][2])]
    nan, inf = float("nan"), float("inf")
    rows += [(600, None, 0), (601, [], 0), (602, [0.0] * 16, 0), (603, [nan] + [1.0] * 15, 0), (604, [inf] + [1.0] * 15, 0),
             (605, [None] + [1.0] * 15, 0), (606, rows[0][1], None), (None, rows[0][1], 0), (607, [1.0, 2.0], 0), (608, [2.0, 4.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    out = nearvec.near_vectors(df.selectExpr("*", "1 as rep", "'x' as h1")).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in out) == brute_vectors(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    assert nearvec.near_vectors(df.limit(0)).count() == 0


def _batch_bytes(batches):
    for b in batches:
        yield pa.RecordBatch.from_arrays([pa.array([b.nbytes])], ["bytes"])


def test_batches_for_python_tasks_are_bounded_by_bytes(spark):
    """Long texts reach a worker a few MB at a time, also through nested jobs, and
    the session's own setting is back afterwards."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    docs = spark.range(0, 60, 1, 1).select(F.repeat(F.lit("x"), 500_000).alias("text"))
    seen = docs.mapInArrow(_batch_bytes, "bytes long")
    with store.small_batches(spark):
        found = [r.bytes for df in (store.cut(seen), store.land(seen)) for r in df.collect()]
    assert sum(found) >= 2 * 60 * 500_000
    assert max(found) <= store.BATCH_BYTES + 600_000  # the row that fills it may stand over
    assert spark.conf.get(name) == before


@pytest.mark.parametrize("own, used", [("1m", 1 << 20), ("256mb", store.BATCH_BYTES), ("300000", 300_000)])
def test_batches_keep_a_smaller_setting(spark, own, used):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, own)
    try:
        with store.small_batches(spark):
            assert int(spark.conf.get(name)) == used
        assert spark.conf.get(name) == own
    finally:
        spark.conf.set(name, before)


def test_a_bucket_of_the_screen_takes_little_more_than_its_hashes():
    """One bucket of 64 MB of text is some 10 M hashes: a task may hold a few times
    their 4 bytes, not twenty times."""
    rng = np.random.default_rng(5)
    many, docs = 400_000, 1000
    rows = []
    for flush in range(3):
        h = rng.integers(0, 1 << 22, many, dtype=np.uint32)
        times = np.full(docs, many // docs, "<u4")
        rows.append((0, flush, np.arange(docs, dtype="<u4").tobytes(), times.tobytes(), h.astype("<u4").tobytes(), b"", b""))
    rows.append((0, 0, b"", np.full(docs, 400, "<u4").tobytes(), b"", np.arange(docs, dtype="<i8").tobytes(), np.arange(docs, dtype="<i8").tobytes()))
    kinds = (pa.int32(), pa.int64(), *[pa.binary()] * 5)
    group = pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [x.split()[0] for x in jaccard._PACKED.split(", ")])
    every = np.concatenate([np.frombuffer(r[4], "<u4") for r in rows[:3]])
    names, times = np.unique(every, return_counts=True)
    twice = np.isin(every, names[times > 1]).reshape(3, docs, many // docs).sum(axis=2)
    tracemalloc.start()
    try:
        got = jaccard._mark_shared(group)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 7 * every.nbytes
    found = {r["flush"]: r for r in got.to_pylist() if not r["doc"]}
    for flush in range(3):
        i, n = (np.frombuffer(found[flush][c], "<u4") for c in ("idx", "counts"))
        assert dict(zip(i.tolist(), n.tolist())) == {k: int(x) for k, x in enumerate(twice[flush]) if x}
    assert [r["row"] for r in got.to_pylist() if r["doc"]] == [rows[3][6]]


def test_shingles_take_few_passes_and_tell_texts_apart():
    rng = np.random.default_rng(9)
    for words in (1, 2, 5):
        for n in (1, 2, 4, 5, 6, 300):
            own = [b"W%d" % k for k in rng.integers(0, 12, n)]
            text = b" \t".join(own) + b"\x0b\x0c\r\n"
            got = jaccard.shingles(text, words)
            low = [w.lower() for w in own]
            want = {tuple(low[k:k + words]) for k in range(max(1, n - words + 1))}
            assert len(got) == len(want) and (got[1:] > got[:-1]).all()
            assert (got == jaccard.shingles(b" ".join(low), words)).all()
    # Order, place and length tell shingles apart.
    texts = [b"a b c d e", b"b a c d e", b"a c b d e", b"a b c e d", b"e d c b a", b"a b c d", b"a a a a a", b"a", b"a a"]
    assert len({int(jaccard.shingles(t)[0]) for t in texts}) == len(texts)
    assert jaccard.shingles(None).size == jaccard.shingles(b" \n").size == 0
    passes, mix = [], jaccard._mix
    try:
        jaccard._mix = lambda x: passes.append(1) or mix(x)
        jaccard.shingles(b"a b c d e f g")
    finally:
        jaccard._mix = mix
    assert len(passes) == 1
