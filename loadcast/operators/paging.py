"""Pages of a table from a stored index, and the page count.

``build_page_index`` orders a table once: rows are range-partitioned and sorted
by the requested columns and, behind them, by the key and all other columns, so
that the order is total and pages never overlap or skip rows on ties. Each row
gets its number and is written under its chunk, a fixed number of consecutive
rows. A manifest beside the chunks has a row for each: how many rows, the number of
the first, the smallest and the largest key. ``read_page`` opens only the one or two
chunks a page lies in, however deep it is, and ``read_from`` finds the chunk of a key
in the manifest; no other folder is listed. Nothing is merged on the driver. Chunks
and manifest become visible together, and an index can be built anew at its place.

Rows equal in every column are interchangeable; each has a number of its own.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import KEY, PAGE_SIZE
from ..session import work_dir
from ..sources.published import current, replace
from .joins import materialize

ROWS_PER_CHUNK = 100_000


def page_count(df: DataFrame, per_page: int = PAGE_SIZE) -> DataFrame:
    """(total_rows, total_pages) with pages = ceil(rows / per_page)."""
    n = F.count(F.lit(1))
    return df.agg(n.alias("total_rows"), F.ceil(n / F.lit(per_page)).alias("total_pages"))


def _sort_keys(df: DataFrame, order_by) -> list[str]:
    """The requested columns that exist, then the key, then all others."""
    asked = [c for c in order_by if c in df.columns]
    if not asked:
        raise ValueError("paging needs at least one ordering column")
    return list(dict.fromkeys([*asked, *[c for c in KEY if c in df.columns], *df.columns]))


def build_page_index(df: DataFrame, path: str, order_by=KEY, rows_per_chunk: int = ROWS_PER_CHUNK) -> str:
    """Write ``df`` in page order under ``path``, a folder per chunk, and commit it
    with its manifest as the index that readers of ``path`` use from then on."""
    if rows_per_chunk < 1:
        raise ValueError("a chunk holds one row or more")
    spark = df.sparkSession
    keys = _sort_keys(df, order_by)
    named = [c for c in keys if c in set(order_by) | set(KEY)]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Checkpointed: the counts and the numbering below must see the same
    # partitions; a recomputed range shuffle may sample other bounds.
    ranged = materialize(df.repartitionByRange(parts, *keys).sortWithinPartitions(*keys))
    numbered = ranged.select("*", F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__mono"))
    counts = materialize(numbered.groupBy("__part").agg(F.count(F.lit(1)).alias("__n")))
    # One row per partition: the window below runs over ``parts`` rows only.
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.select("__part", F.coalesce(before, F.lit(0)).alias("__offset"))
    # monotonically_increasing_id = (partition << 33) + row number in partition.
    local = F.col("__mono") - F.shiftleft(F.col("__part").cast("long"), 33)
    row = (F.col("__offset") + local).cast("long")
    placed = (numbered.join(offsets, "__part").withColumn("__row", row)
              .withColumn("__chunk", F.floor(F.col("__row") / rows_per_chunk).cast("long"))
              .drop("__part", "__mono", "__offset"))
    total = counts.agg(F.sum("__n")).first()[0] or 0

    def write(folder: str) -> dict:
        # A row per chunk: its rows, the number of its first, its smallest and largest key.
        key = F.struct(*named)
        (placed.groupBy("__chunk").agg(F.count(F.lit(1)).alias("rows"), F.min("__row").alias("first_row"),
                                       F.min(key).alias("low"), F.max(key).alias("high"))
         .withColumnRenamed("__chunk", "chunk").write.parquet(f"{folder}/manifest"))
        placed.write.partitionBy("__chunk").parquet(f"{folder}/chunks")
        return {"rows_per_chunk": rows_per_chunk, "rows": total, "order": named, "schema": df.schema.json()}

    replace(spark, path, write)
    return path


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(chunk, rows, first_row, low, high) of the index at ``path``."""
    return spark.read.parquet(f"{current(spark, path)[0]}/manifest")


def _open(spark: SparkSession, folder: str, record: dict, first: int, last: int) -> DataFrame:
    """Chunks ``first`` to ``last``, as far as there are any; no other is listed."""
    schema = T.StructType.fromJson(json.loads(record["schema"])).add("__row", T.LongType())
    last = min(last, (record["rows"] - 1) // record["rows_per_chunk"])
    if first > last:
        return spark.createDataFrame([], schema.add("__chunk", T.LongType()))
    paths = [f"{folder}/chunks/__chunk={k}" for k in range(first, last + 1)]
    return spark.read.schema(schema).option("basePath", f"{folder}/chunks").parquet(*paths)


def read_page(spark: SparkSession, path: str, page_no: int = 1, per_page: int = PAGE_SIZE,
              rows_per_chunk: int | None = None) -> DataFrame:
    """Rows of page ``page_no`` (1-based) of a stored index, in order. Pages past
    the end are empty. The index knows its chunk size; one that is given must be it."""
    if page_no < 1 or per_page < 1:
        raise ValueError("page numbers and page sizes start at 1")
    folder, record = current(spark, path)
    if rows_per_chunk not in (None, record["rows_per_chunk"]):
        raise ValueError(f"the index at {path} has {record['rows_per_chunk']} rows a chunk, not {rows_per_chunk}")
    start, stop = (page_no - 1) * per_page, page_no * per_page
    first, last = start // record["rows_per_chunk"], (stop - 1) // record["rows_per_chunk"]
    near = _open(spark, folder, record, first, last).where(F.col("__chunk").between(first, last))
    return (near.where((F.col("__row") >= start) & (F.col("__row") < stop))
            .orderBy("__row").drop("__row", "__chunk"))


def read_from(spark: SparkSession, path: str, key: list, n: int = PAGE_SIZE) -> DataFrame:
    """The first ``n`` rows of a stored index at or behind ``key``: values of the
    first of its ordering columns, of one or more. The manifest tells the chunk."""
    if n < 1:
        raise ValueError("page sizes start at 1")
    folder, record = current(spark, path)
    columns = record["order"][:len(key)]
    if not key or len(key) > len(record["order"]):
        raise ValueError(f"the index is ordered by {record['order']}")
    types = {f.name: f.dataType for f in T.StructType.fromJson(json.loads(record["schema"])).fields}
    wanted = F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(columns, key)])
    high = F.struct(*[F.col("high")[c].alias(c) for c in columns])
    first = spark.read.parquet(f"{folder}/manifest").where(high >= wanted).agg(F.min("chunk")).first()[0]
    if first is None:
        first = record["rows"]  # behind the last row
    near = _open(spark, folder, record, first, first + -(-n // record["rows_per_chunk"]))
    behind = near.where(F.struct(*[F.col(c).alias(c) for c in columns]) >= wanted)
    return behind.orderBy("__row").limit(n).drop("__row", "__chunk")


def preview_index(spark: SparkSession, path: str, n: int = PAGE_SIZE, columns=None) -> DataFrame:
    """The first ``n`` rows of an indexed table: its first chunk is all that is read
    (its first chunks, if ``n`` is larger than one)."""
    out = read_page(spark, path, 1, n)
    return out.select(*columns) if columns else out


def page(df: DataFrame, page_no: int = 1, per_page: int = PAGE_SIZE, order_by=KEY) -> DataFrame:
    """One page of a table that has no index yet: builds one in the work folder
    and reads the page from it. For more than one page keep the index."""
    if page_no < 1 or per_page < 1:
        raise ValueError("page numbers and page sizes start at 1")
    if df.isEmpty():
        return df.limit(0)
    spark = df.sparkSession
    return read_page(spark, build_page_index(df, work_dir(spark, "pages"), order_by), page_no, per_page)
