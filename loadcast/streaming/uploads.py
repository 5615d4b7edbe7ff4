"""Uploads that differ from one another, landed by one stream that goes on.

``ingest_uploads`` groups the files of each micro-batch by their header and reads
each group by it. Every line ends up in one of two tables:

* landed: the declared columns, whatever their order in the file, and the columns
  beyond them as a map (``EXTRA_COLUMNS``, null if there are none);
* rejected: ``file``, the ``line`` and the ``reason`` for a line with more or fewer
  fields than its header or a value of the wrong type, and for every line of a file
  whose header lacks a declared column or names one twice.

A micro-batch writes a folder of its own in both tables, named by the stream and the
batch, and writes it anew if it is tried again: each line counts once. A stream
looks at no file before it starts, so the landing folder may be empty. What the
driver gets are the headers of one micro-batch, at most ``max_files_per_trigger``.

``uploads_of`` is the same grouping for a list of files, as a batch.
"""

from __future__ import annotations

import csv
from collections import Counter
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..schema import RAW_SCHEMA
from ..sources import commits

EXTRA = "EXTRA_COLUMNS"
BATCH = "__batch"
REJECTS = T.StructType([T.StructField(c, T.StringType()) for c in ("file", "line", "reason")])
_BROKEN = "__broken"


def landed_schema(schema: T.StructType = RAW_SCHEMA) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(EXTRA, T.MapType(T.StringType(), T.StringType()))])


def headers(lines: DataFrame) -> DataFrame:
    """(file, header): the first line of each file of ``lines`` (value, file, start)."""
    first = lines.where("start = 0").withColumn("at", F.monotonically_increasing_id())
    return first.groupBy("file").agg(F.min_by("value", "at").alias("header"))


def header_fault(header: str, schema: T.StructType = RAW_SCHEMA) -> tuple[list[str], str | None]:
    """The columns a header names, and why it cannot be read (None if it can)."""
    columns = next(csv.reader([header]), [])
    lacking = [f for f in schema.fieldNames() if f not in columns]
    if lacking:
        return columns, f"the header lacks {', '.join(lacking)}"
    twice = [c for c, n in Counter(c.lower() for c in columns).items() if n > 1]
    return columns, f"the header repeats {', '.join(twice)}" if twice else None


def _refused(spark: SparkSession, files: list[str], header: str, reason: str) -> DataFrame:
    rows = spark.read.text(files).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))
    return rows.where(F.col("line") != header).withColumn("reason", F.lit(reason))


def _read_group(spark: SparkSession, files: list[str], columns: list[str], schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(landed, rejected) rows of files with one header."""
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, _BROKEN]])
    rows = (spark.read.schema(text).option("header", True).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", _BROKEN).csv(files)
            .select("*", F.col("_metadata.file_path").alias("__file")))
    value = {c: F.col(f"`{c}`") for c in columns}
    typed = {f.name: value[f.name] if isinstance(f.dataType, T.StringType) else value[f.name].try_cast(f.dataType)
             for f in schema.fields}
    faults = [F.when(F.col(_BROKEN).isNotNull(), F.lit("fields do not match the header"))]
    faults += [F.when(value[f.name].isNotNull() & typed[f.name].isNull(), F.lit(f"{f.name}: not a {f.dataType.simpleString()}"))
               for f in schema.fields if not isinstance(f.dataType, T.StringType)]
    judged = rows.withColumn("__reason", F.coalesce(*faults))
    more = [c for c in columns if c not in set(schema.fieldNames())]
    extra = F.map_from_arrays(F.array(*map(F.lit, more)), F.array(*[value[c] for c in more])) if more else F.lit(None)
    landed = judged.where("__reason IS NULL").select(
        *[typed[f.name].alias(f.name) for f in schema.fields],
        extra.cast(T.MapType(T.StringType(), T.StringType())).alias(EXTRA))
    line = F.coalesce(F.col(_BROKEN), F.to_csv(F.struct(*[value[c].alias(f"c{i}") for i, c in enumerate(columns)])))
    rejected = judged.where("__reason IS NOT NULL").select(
        F.col("__file").alias("file"), line.alias("line"), F.col("__reason").alias("reason"))
    return landed, rejected


def uploads_of(spark: SparkSession, by_header: dict[str, list[str]], schema: T.StructType = RAW_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """(landed, rejected) rows of CSV files, given by their header line."""
    landed, rejected = [spark.createDataFrame([], landed_schema(schema))], [spark.createDataFrame([], REJECTS)]
    for header, files in by_header.items():
        columns, fault = header_fault(header, schema)
        if fault:
            rejected.append(_refused(spark, files, header, fault))
        else:
            good, bad = _read_group(spark, files, columns, schema)
            landed.append(good)
            rejected.append(bad)
    return reduce(DataFrame.unionByName, landed), reduce(DataFrame.unionByName, rejected)


def batch_name(spark: SparkSession, batch_id: int) -> str:
    """Names a micro-batch apart from those of every other stream."""
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
    return f"{query}-{batch_id}"


def ingest_uploads(spark: SparkSession, src_dir: str, landed: str, rejected: str,
                   schema: T.StructType = RAW_SCHEMA, checkpoint: str | None = None,
                   available_now: bool = True, max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Land the CSV files that arrive in ``src_dir``; see the module."""
    def land(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        name = batch_name(session, batch_id)
        by_header: dict[str, list[str]] = {}
        for r in headers(batch).collect():  # a row per file of the micro-batch
            by_header.setdefault(r.header, []).append(r.file)
        good, bad = uploads_of(session, by_header, schema)
        good.write.mode("overwrite").parquet(f"{landed.rstrip('/')}/{BATCH}={name}")
        bad.write.mode("overwrite").parquet(f"{rejected.rstrip('/')}/{BATCH}={name}")

    # Both tables can be read before the first upload.
    for path, kind in ((landed, landed_schema(schema)), (rejected, REJECTS)):
        if not commits.exists(spark, path):
            spark.createDataFrame([], kind).write.mode("ignore").parquet(f"{path.rstrip('/')}/{BATCH}=start")
    lines = (spark.readStream.format("text").option("recursiveFileLookup", True)
             .option("maxFilesPerTrigger", max_files_per_trigger).load(src_dir)
             .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start")))
    writer = lines.writeStream.foreachBatch(land).option(
        "checkpointLocation", checkpoint or f"{landed.rstrip('/')}/_checkpoint")
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def read_landed(spark: SparkSession, landed: str, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    return spark.read.schema(landed_schema(schema)).parquet(landed).drop(BATCH)


def read_rejected(spark: SparkSession, rejected: str) -> DataFrame:
    return spark.read.schema(REJECTS).parquet(rejected).drop(BATCH)
