"""Expressions shared by the text operators (all built-in Spark functions)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The white space that separates words, and the letters folded.
SPACE_CHARS = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# The same white space for code that runs inside Python tasks.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once for the row.

    A plain reference may be inlined into every use, also into lambdas that run
    once per element; a one-element ``transform`` binds it.
    """
    return F.transform(F.array(value), body)[0]


def fold(col: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(col, UPPER, LOWER)


def strip(col: Column) -> Column:
    """Without white space at both ends."""
    return F.btrim(col, F.lit(SPACE_CHARS))


def words(col: Column) -> Column:
    """The runs of non-space characters, in order; empty for null."""
    bare = strip(F.coalesce(col, F.lit("")))
    return let(bare, lambda s: F.when(F.length(s) == 0, F.array().cast("array<string>"))
               .otherwise(F.split(s, SPACE_CLASS + "+")))


def digest(*cols: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes that together identify a value (128 bits)."""
    return F.xxhash64(*cols), F.xxhash64(F.lit(0x9E37), *cols)


def fresh(taken: list[str], wanted: str) -> str:
    """``wanted``, with underscores in front until no column is called so."""
    low = {c.lower() for c in taken}
    while wanted.lower() in low:
        wanted = "_" + wanted
    return wanted
