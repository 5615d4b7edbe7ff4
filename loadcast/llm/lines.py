"""Line dedup: lines that many documents share are dropped.

Lines are exploded with a normalised key (white space stripped at both ends,
A-Z lower-cased), keys of ``min_chars`` code points or more are hashed to 128
bits, distinct documents are counted per hash, and hashes in ``min_docs``
documents or more lose all their lines except in the largest ``doc_id`` that
holds them. The remaining lines are joined again in their order.

Shuffles: (hash, doc_id) pairs, pre-aggregated per task, so a line that every
document holds is one pair per document and then one row per task; the hashes
that are over the threshold, joined to the lines of that hash (a plain equi-join,
so skewed partitions can be split); and one shuffle of the texts to meet the
positions to drop. Each document carries the positions of its own lines only.

Rows: null or empty text is one empty line. Rows with a null ``doc_id`` are no
document: they do not count and never keep a common line. Repeated rows count
once, and each of them loses (or keeps) the same lines. Extra columns pass.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadcast.llm.text import digest, fold, fresh, let, strip

MIN_CHARS = 40
MIN_DOCS = 5


def line_array(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _long_lines(rows: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, row key, pos, h1, h2) of the lines whose key is long enough."""
    lines = rows.select("doc_id", "_r1", "_r2", F.posexplode(line_array(F.col("text"))).alias("pos", "line"))
    key = strip(F.col("line"))
    # The fold keeps lengths, so short lines go before it.
    long = lines.where(F.length("line") >= min_chars).select(
        "doc_id", "_r1", "_r2", "pos", key.alias("key")).where(F.length("key") >= min_chars)
    h1, h2 = digest(fold(F.col("key")))
    return long.select("doc_id", "_r1", "_r2", "pos", h1.alias("h1"), h2.alias("h2"))


def common_lines(rows: DataFrame, min_docs: int) -> DataFrame:
    """Hashes found in ``min_docs`` distinct documents, with the largest of them."""
    return (rows.groupBy("h1", "h2")
            .agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("last"))
            .where(F.col("n") >= min_docs).select("h1", "h2", "last"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the common lines gone from ``text``, plus ``n_lines`` and
    ``n_dropped`` (under a free name if a column is called so already)."""
    r1, r2 = digest("doc_id", "text")
    rows = docs.select("doc_id", "text", r1.alias("_r1"), r2.alias("_r2"))
    lines = _long_lines(rows, min_chars)
    hits = (lines.join(common_lines(lines, min_docs), ["h1", "h2"])
            .where(~F.col("doc_id").eqNullSafe(F.col("last")))
            .groupBy("_r1", "_r2").agg(F.collect_set("pos").alias("_gone")))
    whole = docs.select(F.struct(*docs.columns).alias("_doc"), "doc_id", "text",
                        r1.alias("_r1"), r2.alias("_r2"))
    met = whole.join(hits, ["_r1", "_r2"], "left")
    n_lines, n_dropped, new = (fresh(docs.columns, n) for n in ("n_lines", "n_dropped", "left"))
    left = let(line_array(F.col("text")), lambda x: F.array_join(
        F.filter(x, lambda _, i: ~F.array_contains("_gone", i)), "\n"))
    out = met.select(
        "_doc.*",
        F.when(F.col("_gone").isNull(), F.col("text")).otherwise(left).alias(new),
        F.size(line_array(F.col("text"))).cast("long").alias(n_lines),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias(n_dropped))
    return out.select(*[F.col(new).alias("text") if c == "text" else F.col(c) for c in docs.columns],
                      n_lines, n_dropped)
