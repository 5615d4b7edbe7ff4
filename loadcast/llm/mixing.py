"""Mixing sources to target weights by Poisson replication.

Each source has a target share of the output; its rate is
``share * all rows / rows of the source``, so the mix has about as many rows as
the input. A document's count inverts the Poisson distribution with that rate at
a uniform number drawn from a hash of its ``doc_id`` and the seed: the same
document gets the same count on any cluster and in any order. Documents are
exploded by their counts and dealt out by a second hash, then sorted by it within
each partition, which is a random permutation of the whole mix.

Everything is built-in functions. The cumulative probabilities are one small
array per source, reaching to where the tail is below the resolution of the
uniform number; nothing is cut off a rate, however large. The per-source table is
broadcast when its names and arrays have at most ``BROADCAST_BYTES`` and otherwise
joined on the source, where skewed partitions can be split.

Rows: a null source is a source of its own. A row without ``doc_id`` draws
by its text. Repeated rows get the same count and key each. Null or empty texts are
mixed like others. A source without a weight gets none of the mix when weights
are given. An empty table gives an empty result. Extra columns pass; the added
columns take free names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from loadcast.llm.store import cut
from loadcast.llm.text import fresh

SEED = "mix-1"
#: Without given weights a source's share grows with its rows to this power.
POWER = 0.5
BROADCAST_BYTES = 32 << 20
HEX_DIGITS = 13


def uniform(seed: str, *parts: Column) -> Column:
    """A number in [0, 1) with 52 bits, from a hash of the seed and ``parts``."""
    named = F.concat_ws(":", F.lit(seed), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(named), 1, HEX_DIGITS), 16, 10).cast("long") / F.lit(float(16 ** HEX_DIGITS))


def _identity(docs: DataFrame) -> Column:
    """What a document draws by: its id, else its text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit("")) if "text" in docs.columns else F.lit("")
    return F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("null:"), F.md5(text)))


def rates(docs: DataFrame, weights: dict | None = None, power: float = POWER) -> DataFrame:
    """(source, rows, rate) of each source."""
    counts = docs.groupBy("source").agg(F.count("*").alias("rows"))
    if weights is None:
        weight = F.pow(F.col("rows").cast("double"), F.lit(power))
    else:
        pairs = [F.lit(x) for k, v in weights.items() for x in (k, float(v))]
        known = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,double>")
        weight = F.coalesce(F.element_at(known, F.col("source").cast("string")), F.lit(0.0))
    weighed = cut(counts.withColumn("weight", weight))
    sums = weighed.agg(F.sum("rows").alias("n"), F.sum("weight").alias("w")).first()
    share = F.col("weight") / F.lit(float(sums["w"] or 1))
    return weighed.select("source", "rows", (share * F.lit(float(sums["n"] or 0)) / F.col("rows")).alias("rate"))


def cumulative(rate_table: DataFrame) -> DataFrame:
    """(source, cdf): the Poisson probabilities of at most 0, 1, 2, ... copies."""
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 40).cast("int")
    points = rate_table.select("source", "rate", F.explode(F.sequence(F.lit(0), last)).alias("k"))
    upto = Window.partitionBy("source").orderBy("k")
    p = F.when(F.col("k") == 0, F.exp(-F.col("rate"))).when(F.col("rate") > 0, F.exp(
        F.col("k") * F.log("rate") - F.col("rate") - F.col("lf"))).otherwise(0.0)
    return (points.withColumn("lf", F.sum(F.log(F.greatest("k", F.lit(1)))).over(upto))
            .withColumn("c", F.sum(p).over(upto))
            .groupBy("source")
            .agg(F.transform(F.sort_array(F.collect_list(F.struct("k", "c"))), lambda x: x["c"]).alias("cdf")))


def mix(docs: DataFrame, weights: dict | None = None, seed: str = SEED, power: float = POWER) -> DataFrame:
    """``docs`` replicated to the target weights in random order, with ``copy``
    (from 1), ``n_copies`` and ``shuffle_key``."""
    copy, n_copies, key = (fresh(docs.columns, n) for n in ("copy", "n_copies", "shuffle_key"))
    source, cdf = fresh(docs.columns, "mix_source"), fresh(docs.columns, "cdf")
    table = cut(cumulative(rates(docs, weights, power))).withColumnsRenamed({"source": source, "cdf": cdf})
    held = table.agg(F.sum(8 * F.size(cdf) + F.coalesce(F.octet_length(F.col(source).cast("string")), F.lit(0)) + 32)
                     .alias("bytes")).first()["bytes"] or 0
    if held <= BROADCAST_BYTES:
        table = F.broadcast(table)
    own = _identity(docs)
    u = uniform(seed, own)
    drawn = (docs.join(table, F.col("source").eqNullSafe(F.col(source)))
             .withColumn(n_copies, F.size(F.filter(cdf, lambda c: c <= u)))
             .drop(source, cdf).where(F.col(n_copies) > 0))
    copies = drawn.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(n_copies))))
    keyed = copies.withColumn(key, F.md5(F.concat_ws(
        ":", F.lit(seed + "-order"), own, F.col(copy).cast("string"))))
    return (keyed.repartition(key).sortWithinPartitions(key)
            .select(*docs.columns, copy, n_copies, key))
