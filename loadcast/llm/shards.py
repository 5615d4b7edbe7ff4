"""Sharding by longest processing time: groups of equal texts stay together,
and the largest goes to the least-loaded shard first, through a heap.

The heap runs on the driver over a bounded number of units. With a grain of
``total bytes / (shards * fineness)``, a group of at least one grain is a unit of
its own, of which there are at most ``shards * fineness``; smaller groups are
bundled by hash into ``shards * fineness`` bundles, one unit each. So the driver
sees at most ``2 * shards * fineness`` (id, bytes) pairs however large the table
is, and the loads end within about one grain of each other unless a single group
is larger than a whole share (it stays together, as every group does).

Sizes are summed per group before any shuffle of rows, so a group that holds a
third of all rows is a few partial sums. The assignment comes back as a broadcast
of the bounded unit list. Slots are numbered per (shard, bucket), with the
buckets' offsets from their counts, so no task holds a whole shard.

Rows: null text is no bytes (size 8, checksum 0), and null texts are one group.
Repeated rows are separate rows with separate slots. Rows with equal ``doc_id``
are ordered by size and checksum. An empty table gives an empty result.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadcast.llm.store import cut
from loadcast.llm.text import digest

SHARDS = 24
FINENESS = 1000
ROW_BYTES = 8
ROWS_PER_BUCKET = 20_000


def row_bytes(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def deal(units: list[tuple], shards: int) -> dict:
    """Longest processing time: unit id → shard. ``units``: (id, size) pairs."""
    loads = [(0, s) for s in range(shards)]
    heapq.heapify(loads)
    out = {}
    for unit, size in sorted(units, key=lambda u: (-u[1], u[0])):
        load, shard = loads[0]
        out[unit] = shard
        heapq.heapreplace(loads, (load + size, shard))
    return out


def assign(rows: DataFrame, group: list[str], size: str, shards: int = SHARDS,
           fineness: int = FINENESS) -> DataFrame:
    """``rows`` with a ``shard`` column; rows equal in ``group`` (two hash
    columns) get the same one."""
    spark = rows.sparkSession
    sums = rows.groupBy(*group).agg(F.sum(size).alias("bytes"))
    total = rows.agg(F.sum(size)).first()[0] or 0
    bins = shards * fineness
    grain = max(1, -(-int(total) // bins))
    bundle = lambda: F.pmod(F.col(group[0]), F.lit(bins))
    big = F.col("bytes") >= grain
    units = (sums.select(
        F.when(big, F.col(group[0])).otherwise(bundle()).alias("a"),
        F.when(big, F.col(group[1])).alias("b"), "bytes")
        .groupBy("a", "b").agg(F.sum("bytes").alias("bytes")).collect())  # at most 2 * bins rows
    shard_of = deal([((r.a, r.b is not None, r.b or 0), r.bytes) for r in units], shards)
    whole = [(a, b, s) for (a, alone, b), s in shard_of.items() if alone]
    bundled = [(a, s) for (a, alone, b), s in shard_of.items() if not alone]
    alone_df = spark.createDataFrame(whole, "_a long, _b long, _s1 int")
    bundle_df = spark.createDataFrame(bundled, "_u long, _s2 int")
    return (rows
            .join(F.broadcast(alone_df),
                  (F.col(group[0]) == F.col("_a")) & (F.col(group[1]) == F.col("_b")), "left")
            .join(F.broadcast(bundle_df), bundle() == F.col("_u"), "left")
            .withColumn("shard", F.coalesce("_s1", "_s2"))
            .drop("_a", "_b", "_s1", "_u", "_s2"))


def slots(rows: DataFrame, order: list[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """``rows`` with ``slot``: 0, 1, ... within each ``shard``."""
    n = rows.count()
    buckets = max(1, -(-n // rows_per_bucket))
    # Buckets come from all the order columns, so copies of one row spread only
    # by being few; a hot row still differs in doc_id.
    dealt = rows.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    counts = dealt.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
    starts = counts.withColumn("_start", F.sum("_n").over(
        Window.partitionBy("shard").orderBy("_bucket")) - F.col("_n")).drop("_n")
    place = F.row_number().over(Window.partitionBy("shard", "_bucket").orderBy(*order)) - 1
    return (dealt.withColumn("_place", place).join(starts, ["shard", "_bucket"])
            .withColumn("slot", (F.col("_start") + F.col("_place")).cast("long"))
            .drop("_bucket", "_place", "_start"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, fineness: int = FINENESS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row."""
    g1, g2 = digest("text")
    rows = cut(docs.select(  # no texts: all that follows reads these few columns
        "doc_id", row_bytes(F.col("text")).alias("size"),
        F.coalesce(F.crc32(F.encode("text", "UTF-8")), F.lit(0)).cast("long").alias("text_crc32"),
        g1.alias("_g1"), g2.alias("_g2")))
    out = slots(assign(rows, ["_g1", "_g2"], "size", shards, fineness),
                ["doc_id", "size", "text_crc32"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
