import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadcast.llm import chunks, lines, quality

from .fixtures import CLASHING, awkward, awkward_rows, clashing, empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_quality(text):
    t = text or ""
    w = WORD.findall(t)
    runs = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {i + o for i in range(len(w) - 7) if runs[tuple(w[i:i + 8])] > 1 for o in range(8)}
    own = [x for x in t.split("\n") if WORD.search(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t),
            "n_dup_lines": len(own) - len(set(own)), "n_repeat_words": len(covered),
            "base_failed": len(w) < 20 or 100 * len(covered) > 30 * len(w)}


def test_quality_metrics_match_brute_force(spark):
    rows = awkward_rows() + [(900, "a b c d e f g h " * 4, "en", "s", 1), (901, "same line here\n" * 9, "en", "s", 1),
                             (902, "1 2 3 4 5 6 7 8 x 1 2 3 4 5 6 7 8 9 y 2 3 4 5 6 7 8 9", "en", "s", 1)]
    df = spark.createDataFrame(rows, awkward(spark).schema)
    got = Counter(tuple(sorted({k: r[k] for k in brute_quality("")}.items())) for r in quality.judge(df).collect())
    assert got == Counter(tuple(sorted(brute_quality(r[1]).items())) for r in rows)


def test_quality_accept_keeps_columns_and_base_failures_go(spark):
    df = clashing(spark)
    out = quality.accept(df)
    assert out.columns == df.columns
    assert all(not brute_quality(r.text)["base_failed"] for r in out.collect())
    assert quality.accept(empty(spark)).count() == 0


def test_judge_keeps_columns_of_its_helpers_names(spark):
    df = awkward(spark).selectExpr("*", "doc_id as _w", "'own' as _l", "2 as __w")
    out = quality.judge(df)
    assert out.columns[:len(df.columns)] == df.columns
    assert all((r._w, r._l, r["__w"]) == (r.doc_id, "own", 2) for r in out.collect())


def test_quality_is_native(spark):
    plan = quality.judge(awkward(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_quality_rules_work_out_the_metrics_once(spark):
    kept = quality.accept(awkward(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert kept.count("array_distinct") == 2  # of windows and of lines
    assert " INSET " in kept  # stop words are looked up, not compared one by one
    assert kept.count("slice(") == 1  # the starts of the windows, not each window
    # A metric's name may be that of a column, and words and windows may repeat.
    rows = [(k, f"{k} the of and " + " ".join(f"text{j if k < 7 else j % 11}" for j in range(n)), 7)
            for k, n in enumerate((0, 7, 8, 9, 30, 60, 200) * 2)]
    named = spark.createDataFrame(rows, "doc_id long, text string, words int")
    plain = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    want = sorted(r.doc_id for r in quality.judge(plain).where("kept").collect())
    assert sorted(r.doc_id for r in quality.accept(named).collect()) == want and 0 < len(want) < len(rows)



def brute_lines(rows, min_chars=40, min_docs=5):
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate(FOLD)
    holders = defaultdict(set)
    for i, t, *_ in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars and i is not None:
                holders[key(x)].add(i)
    common = {k: max(v) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for i, t, *_ in rows:
        own = (t or "").split("\n")
        left = [x for x in own if not (key(x) in common and common[key(x)] != i)]
        out.append((i, len(own), len(own) - len(left), "\n".join(left)))
    return Counter(out)


@pytest.mark.parametrize("partitions", [1, 5])
def test_line_dedup_matches_brute_force(spark, partitions):
    df = awkward(spark).repartition(partitions)
    out = lines.dedup_lines(df).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in out) == brute_lines(awkward_rows())
    assert sum(r.n_dropped for r in out) == 6 + 5  # the shared line, and the line of the six copies


def test_line_dedup_clashes_and_empty(spark):
    out = lines.dedup_lines(clashing(spark))
    assert out.columns[:-2] == clashing(spark).columns and out.columns[-2:] == ["_n_lines", "_n_dropped"]
    assert all(r[c] == f"own {c}" for r in out.collect() for c in CLASHING)
    assert lines.dedup_lines(empty(spark)).count() == 0


def slow_gear(data):
    return [sum(int(chunks._GEAR[data[i - j]]) << j for j in range(min(32, i + 1))) % 2**32 for i in range(len(data))]


def test_gear_and_cuts():
    data = np.random.default_rng(1).integers(0, 256, 500, dtype=np.uint8)
    assert chunks.gear(data).tolist() == slow_gear(data.tolist())
    text = ("word and more words " * 400).encode()
    ends = chunks.cut_points(text)
    assert ends[-1] == len(text) and all(b - a <= chunks.MAX_CHUNK for a, b in zip([0, *ends], ends))
    # An insertion moves the cuts behind it with the text.
    rng = np.random.default_rng(2)
    body = " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, 6)) for _ in range(500)).encode()
    plain, moved = chunks.cut_points(body), chunks.cut_points(b"an inserted start " + body)
    assert len(set(plain) & {e - 18 for e in moved}) > 0.95 * len(plain)
    wide = ("日本" * 500).encode()
    assert b"".join(wide[a:b] for a, b in zip([0, *chunks.cut_points(wide)], chunks.cut_points(wide))).decode() == "日本" * 500


def brute_chunks(rows):
    """Kept text per distinct (doc_id, text), by one ordered pass."""
    holders = sorted({(2**63 if i is None else i, i, t) for i, t, *_ in rows if t}, key=lambda x: x[0])
    seen, out = set(), {}
    for _, i, t in holders:
        data, start, spans = t.encode(), 0, []
        for stop in chunks.cut_points(data):
            d = hashlib.sha256(data[start:stop]).digest()
            if d in seen:
                if spans and spans[-1][1] == start:
                    spans[-1][1] = stop
                else:
                    spans.append([start, stop])
            seen.add(d)
            start = stop
        kept, at = b"", 0
        for a, b in spans:
            if b - a >= chunks.MIN_RUN:
                kept += data[at:a]
                at = b
        out[i, t] = (kept + data[at:]).decode()
    return out


@pytest.mark.parametrize("partitions", [1, 6])
def test_substring_dedup_matches_one_ordered_pass(spark, partitions):
    rows = [r for r in awkward_rows() if not (r[0] == 12 and r[1].startswith("other")) and r[0] is not None]
    df = spark.createDataFrame(rows, awkward(spark).schema).repartition(partitions)
    want = brute_chunks(rows)
    for r in chunks.dedup(df).collect():
        original = next(t for i, t, *_ in rows if i == r.doc_id)
        assert r.text == (want[r.doc_id, original] if original else original)
        assert r.removed_bytes == len((original or "").encode()) - len((r.text or "").encode())
        ends = chunks.cut_points((original or "").encode())
        assert r.n_chunks == len(ends)
        assert r.n_removed_chunks == sum(any(s.start <= a and b <= s.end for s in r.removed) for a, b in zip([0, *ends], ends))
        assert (r.n_removed_chunks > 0) == (r.removed_bytes > 0)


def test_substring_dedup_catches_passages_and_leaves_others(spark):
    out = {r.doc_id: r for r in chunks.dedup(awkward(spark)).collect() if r.doc_id not in (None, 12)}
    assert out[10].removed_bytes == 0 and out[11].removed_bytes > 150  # the later holder loses it
    assert out[60].removed_bytes == 0 and all(out[60 + k].text == "" for k in range(1, 6))
    assert all(out[k].removed_bytes == 0 for k in (4, 5, 6, 9))
    assert out[8].removed_bytes > 4_000  # a text that repeats itself


def planted(kind, seed, n=30):
    """Pairs of texts with nothing in common but one passage, and the later ones without it."""
    rng = np.random.default_rng(seed)

    def text(k, base):
        if kind == "cjk":
            return "".join(chr(0x4E00 + base * 3000 + c) for c in rng.integers(0, 3000, k))
        return " ".join("".join(chr(97 + base * 8 + c) for c in rng.integers(0, 8, 6)) for _ in range(k))

    rows, want, passages = [], {}, {}
    for k in range(n):
        passage = text(330 if kind == "cjk" else 51, 2)
        around = [text(int(rng.integers(20, 200)), base) for base in (0, 0, 1, 1)]
        rows += [(2 * k, around[0] + passage + around[1]), (2 * k + 1, around[2] + passage + around[3])]
        want[2 * k], want[2 * k + 1], passages[2 * k + 1] = rows[-2][1], around[2] + around[3], passage
    return rows, want, passages


@pytest.mark.parametrize("partitions", [1, 6])
@pytest.mark.parametrize("kind", ["words", "cjk"])
def test_substring_dedup_removes_whole_passages_to_the_byte(spark, kind, partitions):
    rows, want, passages = planted(kind, 7)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(partitions)
    out = chunks.dedup(df, to_ends=True).collect()
    assert {r.doc_id: r.text for r in out} == want
    assert all(r.removed_bytes == len(passages[r.doc_id].encode()) for r in out if r.doc_id % 2)


def test_substring_dedup_to_ends_keeps_one_copy_of_every_byte(spark):
    rows = [r for r in awkward_rows() if r[0] is not None and r[0] != 12]
    out = {p: {r.doc_id: r.asDict() for r in chunks.dedup(spark.createDataFrame(rows, awkward(spark).schema)
                                                          .repartition(p), to_ends=True).collect()} for p in (1, 5)}
    assert out[1] == out[5]  # whatever the partitions
    texts = {i: t for i, t, *_ in rows}
    earlier = lambda i: "\0".join(t for k, t in sorted(texts.items(), key=lambda x: x[0]) if t and k < i)
    for i, r in out[1].items():
        data = (texts[i] or "").encode()
        left = "".join(data[a:b].decode() for a, b in zip([0, *[s.end for s in r["removed"]]],
                                                          [*[s.start for s in r["removed"]], len(data)]))
        assert left == (r["text"] or "")
        if i not in (4, 8):  # texts that repeat themselves
            assert r["removed_bytes"] == 0 or all(data[s.start:s.start + 20].decode(errors="ignore") in earlier(i)
                                                  for s in r["removed"])
    passage = texts[10].split("\n")[1]
    assert passage in out[1][10]["text"] and passage not in out[1][11]["text"]
    assert out[1][11]["removed_bytes"] >= len(passage.encode())


def test_substring_dedup_clashes_and_empty(spark):
    out = chunks.dedup(clashing(spark))
    assert out.count() == len(awkward_rows())
    assert all(r[c] == f"own {c}" for r in out.collect() for c in CLASHING)
    assert chunks.dedup(empty(spark)).count() == 0
