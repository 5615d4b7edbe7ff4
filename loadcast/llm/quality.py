"""Quality rules: a threshold table compiled into one projection.

Base metrics and rule metrics are built-in expressions over ``text``; each
threshold becomes one Boolean, and a document is kept when the base test and
every rule hold. One scan, no shuffle, no user function.

Rows: null text has no words and fails the base test. Repeated rows and ties
are judged row by row. An empty table gives an empty result. Other columns pass
through ``judge``; a column whose name a verdict column needs is replaced in
``judge`` and kept in ``accept``, which adds nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.llm.text import SPACE_CHARS, SPACE_CLASS, fold, fresh, let, words

# The symbol characters, and frequent function words of the four
# languages of the corpus.
SYMBOLS = "#*$%&|<>"
STOP_WORDS = (
    "a an and are as at be by for from in is it of on or that the this to was with "
    "au avec dans de des du elle en est et il la le les ne pas pour que qui sur un une "
    "auf aus das dem den der die ein eine für ich im ist mit nicht sich sie und von zu "
    "con del el es los no o para por se su al lo las como más una y"
).split()
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``low <= metric <= high``; None leaves that side open."""

    name: str
    metric: str
    low: float | None = None
    high: float | None = None


#: The production table. Ratios are per word unless the name says otherwise.
RULES = (
    Rule("symbols", "symbol_ratio", high=0.25),
    Rule("short_words", "mean_word_chars", low=1.5),
    Rule("long_words", "mean_word_chars", high=20.0),
    Rule("stop_words", "stop_ratio", low=0.04),
    Rule("stuttering", "stutter_ratio", high=0.3),
    Rule("repeated_lines", "dup_line_ratio", high=0.5),
)

BASE_METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _covered(starts: Column, window: int) -> Column:
    """Positions covered by windows that begin at the ascending ``starts``."""
    return let(starts, lambda s: F.when(F.size(s) == 0, F.lit(0)).otherwise(
        F.lit(window) + F.aggregate(
            F.sequence(F.lit(1), F.greatest(F.size(s) - 1, F.lit(1))),
            F.lit(0),
            lambda acc, i: acc + F.when(i < F.size(s), F.least(
                F.lit(window), F.get(s, i) - F.get(s, i - 1))).otherwise(0))))


def repeat_words(word_array: Column, window: int = WINDOW) -> Column:
    """Words inside ``window``-word runs that occur twice or more.

    Each word becomes a 64-bit hash, each window the hash of its words' hashes, read
    where they are (a slice for each window costs more than the hash). Texts
    whose windows all differ are done; in the others, sorting (hash, start)
    pairs puts equal windows side by side.
    """
    def starts(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(pairs, lambda p: F.filter(
            p, lambda x, k: (F.get(p, k - 1)["h"] == x["h"]) | (F.get(p, k + 1)["h"] == x["h"])))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    def of(hashes: Column) -> Column:
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(
            _covered(starts(hashes), window))

    return let(F.transform(word_array, lambda w: F.xxhash64(w)),
               lambda h: F.when(F.size(h) <= window, F.lit(0)).otherwise(let(
                   F.transform(F.slice(h, F.lit(1), F.size(h) - window + 1),
                               lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, window)])), of)))


def metrics(text: Column) -> dict[str, Column]:
    """The base metrics (long) and the counts the rules need, by name."""
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(F.translate(x, SPACE_CHARS, "")) > 0)
    many = words(text)
    longest = max(map(len, STOP_WORDS)) + 1
    bundle = let(many, lambda w: F.struct(
        F.size(w).alias("n_words"),
        F.size(F.filter(w, lambda x: (F.length(x) <= longest) & F.rtrim(
            fold(x), F.lit(".,;:!?")).isin(STOP_WORDS))).alias("n_stop_words"),
        F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1))).alias("n_stutters"),
        repeat_words(w).alias("n_repeat_words")))
    counted = let(lines, lambda x: F.struct(
        F.size(x).alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")))
    return {
        "words": bundle,
        "lines": counted,
        "word_chars": F.length(F.translate(t, SPACE_CHARS, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
    }


def counts(m: Callable[[str], Column]) -> dict[str, Column]:
    """The counts inside the metrics ``words`` and ``lines``, by name (long)."""
    found = {n: m("words")[n] for n in ("n_words", "n_repeat_words")} | {"n_dup_lines": m("lines")["n_dup_lines"]}
    found |= {n: m("words")[n] for n in ("n_stop_words", "n_stutters")} | {"n_text_lines": m("lines")["n_lines"]}
    return {n: c.cast("long") for n, c in found.items()}


def ratios(c: Callable[[str], Column]) -> dict[str, Column]:
    """The metrics of the threshold table, from the counts by name."""
    per = lambda a, b: c(a) / F.greatest(c(b), F.lit(1))
    return {
        "symbol_ratio": per("n_symbols", "n_words"),
        "mean_word_chars": per("word_chars", "n_words"),
        "stop_ratio": per("n_stop_words", "n_words"),
        "stutter_ratio": per("n_stutters", "n_words"),
        "dup_line_ratio": per("n_dup_lines", "n_text_lines"),
    }


def base_failed(c: Callable[[str], Column]) -> Column:
    return (c("n_words") < 20) | (100 * c("n_repeat_words") > 30 * c("n_words"))


def verdict(rules=RULES, ratio: Callable[[str], Column] = F.col) -> Column:
    """The threshold table as one Boolean over the ratio columns."""
    out = F.lit(True)
    for r in rules:
        if r.low is not None:
            out = out & (ratio(r.metric) >= F.lit(float(r.low)))
        if r.high is not None:
            out = out & (ratio(r.metric) <= F.lit(float(r.high)))
    return out


def judge(docs: DataFrame, rules=RULES) -> DataFrame:
    """``docs`` with the base metrics, the ratios, ``base_failed`` and ``kept``."""
    m = metrics(F.col("text"))
    of = {"words": fresh(docs.columns, "_w"), "lines": fresh(docs.columns, "_l")}
    out = docs.withColumns({of["words"]: m["words"], of["lines"]: m["lines"], "word_chars": m["word_chars"],
                            "n_symbols": m["n_symbols"]})
    out = out.withColumns(counts(lambda n: F.col(of[n]))).drop(*of.values())
    out = out.withColumns(ratios(F.col))
    return out.withColumn("base_failed", base_failed(F.col)).withColumn(
        "kept", F.when(F.col("base_failed"), F.lit(False)).otherwise(verdict(rules)))


def accept(docs: DataFrame, rules=RULES) -> DataFrame:
    """The rows of ``docs`` that pass, with their own columns. The metrics are bound:
    as columns below a filter they would be worked out again wherever it names them."""
    def passes(m: Column) -> Column:
        got = counts(lambda n: m[n]) | {n: m[n] for n in ("word_chars", "n_symbols")}
        return F.when(base_failed(got.__getitem__), F.lit(False)).otherwise(
            verdict(rules, ratios(got.__getitem__).__getitem__))

    return docs.where(let(F.struct(*[c.alias(n) for n, c in metrics(F.col("text")).items()]), passes))
