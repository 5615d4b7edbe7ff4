"""Spelling variants by permuterm rotations.

Words are counted over all texts (counted in each task, summed after). Every word
gets a terminator and is turned: the rotation that starts behind a letter ends with
that letter. Two words of equal length that differ in one letter have rotations
that are equal but for this last letter, and a word with one letter more has a
rotation that is a rotation of the shorter word and that letter. So each rotation
stands under two prefixes, itself and itself without its last letter, the edited
one; all are sorted, and words under one prefix are near.

A prefix says all of a word but the edited letter, so a group holds at most one
word as a whole and one for each letter of the alphabet (90): its size is bounded
by the alphabet, whatever the number of words. The scan of the sorted rotations
keeps one group and emits for each word the number of its neighbours there and the
best of them, not pairs. Two words that differ by one inserted letter meet under
several prefixes if the letter stands in a run of its kind; only the first of the
run counts.

``form`` has at least twice the count of its word, so chains double from word to
word and are short; roots come from pointer jumping, a join a round.

Rows: null text has no words. A null ``doc_id`` is written as no text before the
colon. Repeated rows count each. No words give an empty result. Extra columns are
not looked at.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.llm.store import cut, shuffle_partitions

MIN_CHARS = 5
MIN_TIMES = 3
TIMES = 2
#: One run in so many loses a letter.
EDITED = 97
#: Distinct words a task counts before it sends them on.
HELD_WORDS = 500_000
TERMINATOR = "$"

# Latin-1 bytes: letters stay (A-Z lower-cased), everything else parts words.
_PARTS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))


def runs_of(text: str) -> list[bytes]:
    """Lower-cased runs of letters, one Latin-1 byte a letter."""
    return text.encode("latin-1", "replace").translate(_PARTS).split()


def edited(doc: str, run: bytes) -> bytes:
    """The run as it counts in this document."""
    return _edited(zlib.crc32(f"{doc}:".encode()), run)


def _edited(before: int, run: bytes) -> bytes:
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), before)
    if h % EDITED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def send() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([w.decode("latin-1") for w in held], pa.string()),
                                           pa.array(list(held.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            before = zlib.crc32(f"{doc}:".encode())
            for run, n in Counter(runs_of(text.as_py())).items():
                if len(run) >= MIN_CHARS:
                    word = _edited(before, run)
                    if len(word) >= MIN_CHARS:
                        held[word] += n
            if len(held) >= HELD_WORDS:
                yield send()
                held.clear()
    if held:
        yield send()


def words(docs: DataFrame, least: int = MIN_TIMES) -> DataFrame:
    """(word, n) of the words that occur at least ``least`` times."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.col("text").cast("string").alias("text"))
    return (rows.where("text is not null").mapInArrow(_count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least))


# --- near words -----------------------------------------------------------------

#: How a word stands under a prefix: whole, without the first letter of a run of
#: equal letters, or without a later one.
WHOLE, FIRST, LATER = 0, 1, 2


def rotations(word: Column) -> Column:
    """Array of (prefix, kind): the prefixes of all rotations of the marked word."""
    marked = F.concat(word, F.lit(TERMINATOR))
    part = lambda start, n: F.substring(word, start, n)

    def of(i: Column) -> Column:
        turned = F.concat(F.substring(marked, i + 1, F.length(marked)), part(F.lit(1), i))
        whole = F.struct(turned.alias("prefix"), F.lit(WHOLE).alias("kind"))
        again = (i > 1) & (part(i, F.lit(1)) == part(i - 1, F.lit(1)))
        skipped = F.struct(F.concat(F.substring(marked, i + 1, F.length(marked)), part(F.lit(1), i - 1)).alias("prefix"),
                           F.when(again, LATER).otherwise(FIRST).alias("kind"))
        return F.when(i == 0, F.array(whole)).otherwise(F.array(whole, skipped))

    return F.flatten(F.transform(F.sequence(F.lit(0), F.length(word)), of))


def group_neighbours(group: list[tuple[str, int, int]]) -> list[tuple[str, int, int, str]]:
    """(word, neighbours, n of the best, the best) of the words (word, n, kind)
    under one prefix. The best has the largest n; of equal ones the first word."""
    ranked = sorted(group, key=lambda g: (-g[1], g[0]))
    cuts = [g for g in ranked if g[2] != WHOLE]
    firsts = [g for g in cuts if g[2] == FIRST]
    wholes = [g for g in ranked if g[2] == WHOLE]
    out = []
    for word, _, kind in group:
        if kind == WHOLE:
            count, best = len(firsts), firsts[:1]
        else:
            # The better of the best other letter and the word without the letter.
            count, best = len(cuts) - 1, [g for g in cuts[:2] if g[0] != word][:1]
            if kind == FIRST and wholes:
                count, best = count + 1, sorted(best + wholes, key=lambda g: (-g[1], g[0]))[:1]
        if count:
            out.append((word, count, best[0][1], best[0][0]))
    return out


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours from rows sorted by prefix; a group may lie in two batches."""
    last, group = None, []
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        prefix = batch.column("prefix")
        same = pc.equal(prefix.slice(1), prefix.slice(0, n - 1)).to_numpy(zero_copy_only=False)
        # Alone under its prefix, and not at the batch's ends: near to nothing here.
        some = [i for i in range(n) if i in (0, n - 1) or same[i - 1] or same[i]]
        part = batch.take(pa.array(some, pa.int64()))
        out = []
        for p, *row in zip(*(part.column(c).to_pylist() for c in ("prefix", "word", "n", "kind"))):
            if p != last:
                if len(group) > 1:
                    out += group_neighbours(group)
                last, group = p, []
            group.append(tuple(row))
        if out:
            yield _near(out)
    if len(group) > 1 and (out := group_neighbours(group)):
        yield _near(out)


def _near(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["word", "near", "best_n", "best"])


def neighbours(counted: DataFrame) -> DataFrame:
    """(word, n_near, best): the number of near words, and the best of them."""
    turned = counted.select("word", "n", F.explode(rotations(F.col("word"))).alias("r")).select("r.prefix", "word", "n", "r.kind")
    ordered = turned.repartition(shuffle_partitions(counted.sparkSession), "prefix").sortWithinPartitions("prefix", "word")
    best = F.min(F.struct((-F.col("best_n")).alias("neg"), F.col("best").alias("word")))
    return (ordered.mapInArrow(_scan, "word string, near long, best_n long, best string")
            .groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): the end of the chain of forms (word, form)."""
    step = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = step.select(F.col("word").alias("at"), F.col("root").alias("next"))
        moved = cut(step.join(ahead, F.col("root") == F.col("at"), "left")
                    .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("went")))
        step = moved.select("word", "root")
        if moved.where("went").isEmpty():
            return step


def group_variants(docs: DataFrame, least: int = MIN_TIMES, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word of ``docs``
    (doc_id, text)."""
    counted = cut(words(docs, least))
    near = neighbours(counted).select(F.col("word").alias("w"), "n_near", (-F.col("best.neg")).alias("best_n"), F.col("best.word").alias("best"))
    strong = F.col("best_n") >= times * F.col("n")
    known = cut(counted.join(near, F.col("word") == F.col("w"), "left").select(
        "word", F.when(strong, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(strong, F.col("best_n")).alias("form_n")))
    ends = roots(known.where("form is not null")).select(F.col("word").alias("w"), "root")
    return known.join(ends, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
