"""Operators 11 to 13 against brute force, and their awkward rows."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadcast.llm import ranked, topk, variants
from tests.llm import fixtures

SF = "/root/testdata/sf0.001"


def rows_of(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))


# --- op11 -------------------------------------------------------------------------

def brute_top(vectors, k=10, every=100):
    def fine(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    held = [(i, [min(max(math.floor(1024.0 * x), -2**63), 2**63 - 1) for x in v]) for i, v in vectors if fine(v)]
    out = []
    for q, a in {(i, tuple(v)) for i, v in held if i is not None and i % every == 0}:
        got = [(-min(max(sum(x * y for x, y in zip(a, b)), -2**63), 2**63 - 1), i is None, i or 0) for i, b in held if i != q]
        out += [(q, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(got)[:k], 1)]
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


@pytest.mark.parametrize("parts,block", [(1, 8192), (5, 7)])
def test_topk_equals_brute_force(spark, monkeypatch, parts, block):
    monkeypatch.setattr(topk, "BLOCK", block)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.choice([-0.5, 0.0, 0.0009, 0.25, 1.0], 6)]) for i in range(250)]
    rows += [(None, [1.0] * 6), (300, None), (400, [float("nan")] * 6), (500, [None] * 6), (600, []), (700, [0.0] * 6),
             (800, [1.0, 2.0]), (800, [1.0, 2.0]), (900, [1e30, -1e30, 1.0, 0.0, 0.0, 0.0]), (901, [1e30, 1.0, 1.0, 0.0, 0.0, 0.0]),
             (0, [0.5] * 6), (7, [0.25] * 6), (7, [0.25] * 6), (1000, [float("inf"), 0.0])]
    df = vectors(spark, rows).repartition(parts).withColumns({c: F.lit("x") for c in ("id", "terms", "weights", "score", "q", "rank")})
    assert rows_of(topk.search_vectors(df), "query_id", "rank", "vec_id", "score") == brute_top(rows)


def test_topk_in_waves_and_few_rows(spark, monkeypatch):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(0, 900, 9)]
    monkeypatch.setattr(topk, "WAVE_BYTES", 100)
    got = rows_of(topk.search_vectors(vectors(spark, rows)), "query_id", "rank", "vec_id", "score")
    assert got == brute_top(rows)
    assert rows_of(topk.search_vectors(vectors(spark, rows[:4])), "query_id", "rank", "vec_id", "score") == brute_top(rows[:4])


def test_topk_empty_tables(spark):
    assert topk.search_vectors(vectors(spark, [])).collect() == []
    assert topk.search_vectors(vectors(spark, [(1, [1.0])])).collect() == []
    assert topk.search_vectors(vectors(spark, [(100, [1.0])])).collect() == []


def test_topk_takes_sparse_rows(spark):
    schema = "id long, terms array<int>, weights array<long>"
    docs = spark.createDataFrame([(1, [5], [2]), (2, [5, 900000], [1, 3]), (3, [], [])], schema)
    asked = spark.createDataFrame([(9, [900000, 5], [2, -1])], schema)
    assert rows_of(topk.top_k(asked, docs, 2), "query_id", "rank", "vec_id", "score") == [(9, 1, 2, 5), (9, 2, 3, 0)]


# --- op12 -------------------------------------------------------------------------

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_ranked(items, docs, k=20):
    def terms(text):
        return _TERM.findall(text.translate(_FOLD)) if text else []

    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n_docs, n_terms = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in dict.fromkeys(items):
        found = []
        for doc, c in held:
            m = 100 - 25 + (25 * sum(c.values()) * n_docs) // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
                    for t in terms(text) if t in c)
            if s > 0:
                found.append((-s, doc is None, doc or 0))
        out += [(item, r, None if null else doc, -s) for r, (s, null, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=lambda r: tuple((x is None, x) for x in r))


def test_terms_follow_the_pattern():
    text = "Ab_c9 é日×÷ \x00x\x7f~Ünder'K z  q"
    assert [t.decode() for t in ranked.terms_of(text.encode())] == _TERM.findall(text.translate(_FOLD))


@pytest.mark.parametrize("docs_a_block,cells", [(8192, 10**7), (4, 10**7), (8192, 9)])
def test_ranked_equals_brute_force(spark, monkeypatch, docs_a_block, cells):
    monkeypatch.setattr(ranked, "BLOCK_DOCS", docs_a_block)
    monkeypatch.setattr(ranked, "CELLS", cells)
    monkeypatch.setattr(ranked, "STEP", 2)
    docs = [(r[0], r[1]) for r in fixtures.awkward_rows()]
    items = [(1, "River stone, RIVER window"), (2, "é日本😀 <s>"), (2, "the of"), (3, None), (4, ""), (5, "nothingofthis"),
             (None, "edit1 edit2 the"), (6, "the the the"), (6, "the the the"), (7, fixtures.prose(200, 120))]
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("score", F.lit(1))
    got = ranked.search(asked, fixtures.clashing(spark).repartition(3))
    assert rows_of(got, "item_id", "rank", "doc_id", "score") == brute_ranked(items, docs)


def test_ranked_ties_and_waves(spark, monkeypatch):
    monkeypatch.setattr(ranked, "WAVE_BYTES", 30)
    rng = random.Random(8)
    docs = [(i, " ".join(rng.choice("ab cd ef gh ij".split()) for _ in range(rng.randrange(1, 5)))) for i in range(400)]
    items = [(i, t) for i, t in enumerate(("ab", "cd ef", "gh ab ab ij", "zz"))]
    got = ranked.search(spark.createDataFrame(items, "item_id long, text string"),
                        spark.createDataFrame(docs, "doc_id long, text string").repartition(4))
    assert rows_of(got, "item_id", "rank", "doc_id", "score") == brute_ranked(items, docs)


def test_ranked_empty_tables(spark):
    items = spark.createDataFrame([(1, "the")], "item_id long, text string")
    assert ranked.search(items, fixtures.empty(spark)).collect() == []
    assert ranked.search(items.limit(0), fixtures.awkward(spark)).collect() == []


def test_nra_on_random_lists():
    rng = np.random.default_rng(9)
    for case in range(60):
        n, k = int(rng.integers(1, 300)), int(rng.integers(1, 8))
        grid = rng.integers(0, 6, (int(rng.integers(1, 7)), n)) * (rng.random((1, n)) < 0.7)
        lists = []
        for row in grid:
            at = np.flatnonzero(row)
            if len(at):
                at = at[np.argsort(-row[at], kind="stable")]
                lists.append((at, row[at].astype(np.int64)))
        if not lists:
            continue
        total = grid.sum(axis=0)
        floor = (int(rng.integers(0, 12)), int(rng.integers(0, n + 1))) if case % 2 else (0, 0)
        want = sorted((-int(s), p) for p, s in enumerate(total)
                      if s > 0 and (s > floor[0] or s == floor[0] and p < floor[1]))[:k]
        places, scores = ranked.nra(lists, n, k, floor)
        assert sorted((-int(s), int(p)) for p, s in zip(places, scores)) == want


# --- op13 -------------------------------------------------------------------------

def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(docs, least=3):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(_FOLD)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= least}
    by_size = defaultdict(list)
    for w in words:
        by_size[len(w)].append(w)
    found = {}
    for w, n in words.items():
        close = [x for s in (-1, 0, 1) for x in by_size[len(w) + s] if near(w, x)]
        best = min(close, key=lambda x: (-words[x], x), default=None)
        found[w] = (best if best and words[best] >= 2 * n else None, len(close))
    out = []
    for w, n in words.items():
        form, close = found[w]
        root = w
        while found[root][0]:
            root = found[root][0]
        out.append((w, form, root, n, close, words[form] if form else None))
    return sorted(out)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def test_variants_equal_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = brute_variants([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert any(r[1] for r in want) and any(r[4] > 1 for r in want)
    assert sorted(tuple(r) for r in variants.group_variants(docs).select(*COLUMNS).collect()) == want


def test_variants_of_close_words(spark):
    rng = random.Random(3)
    rows = [(i, " ".join("".join(rng.choice("aábÿ") for _ in range(rng.randrange(4, 8))) for _ in range(300))) for i in range(12)]
    rows += [(90, "letter " * 40 + "leter " * 9 + "lettter " * 5 + "lettar " * 20 + "lettars " * 4)] * 2
    rows += [(r[0], r[1]) for r in fixtures.awkward_rows()]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5).withColumns(
        {c: F.lit("x") for c in ("word", "n", "prefix", "kind", "best", "root", "form")})
    assert sorted(tuple(r) for r in variants.group_variants(df).select(*COLUMNS).collect()) == brute_variants(rows)


def test_variants_in_small_batches_and_flushes(spark, monkeypatch):
    monkeypatch.setattr(variants, "HELD_WORDS", 3)
    rows = [(i, "water waters watar wader watter later hater Water wateré") for i in range(9)]
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        got = variants.group_variants(spark.createDataFrame(rows, "doc_id long, text string"))
        assert sorted(tuple(r) for r in got.select(*COLUMNS).collect()) == brute_variants(rows)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)


def test_variants_empty(spark):
    assert variants.group_variants(fixtures.empty(spark)).collect() == []


def test_runs_follow_the_pattern():
    text = "Ab'c ÀÿÖx×÷ āb Ĳ日Z-9é \u0085q ſK"
    want = [r.translate(_FOLD) for r in re.findall("[A-Za-zÀ-ÿ]+", text)]
    assert [r.decode("latin-1") for r in variants.runs_of(text)] == want
