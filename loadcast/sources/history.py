"""Result histories: batches that count once, and results kept by day.

``append_once`` writes a batch to a folder of its own and names the folder in a
ledger record under the batch's id. The record is the commit: a batch that was
appended before is not written again, a batch whose write failed is not there,
and of two tries at once the first record counts. ``read_history`` joins the data
folders to the ledger, both read by Spark, so nothing is listed by hand.

``write_by_day`` replaces the partitions of the days it holds and no others.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import commits

#: Column that names the folder of a batch; readers do not see it.
FOLDER = "__batch"


def ledger_path(path: str) -> str:
    return f"{path.rstrip('/')}/_ledger"


def append_once(df: DataFrame, path: str, batch_id: str, notes: Callable[[], dict] | None = None) -> bool:
    """Add ``df`` under ``batch_id``; False, and nothing written, if that batch is
    there. ``notes()``, called after the write, is kept in the ledger record."""
    spark = df.sparkSession
    if commits.get(spark, ledger_path(path), batch_id) is not None:
        return False
    name = f"{batch_id}~{uuid.uuid4().hex[:12]}"
    folder = f"{path.rstrip('/')}/{FOLDER}={name}"
    try:
        df.write.mode("error").parquet(folder)
        record = {"batch_id": batch_id, "folder": name, **(notes() if notes else {})}
        done = commits.put(spark, ledger_path(path), batch_id, record)
    except BaseException:
        commits.delete(spark, folder)
        raise
    if not done:
        commits.delete(spark, folder)
    return done


def read_ledger(spark: SparkSession, path: str, schema: str = "batch_id string, folder string") -> DataFrame:
    """A row per committed batch. Without a batch yet there are no rows."""
    if not commits.exists(spark, ledger_path(path)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(ledger_path(path))


def read_history(spark: SparkSession, path: str, batch_column: str | None = None) -> DataFrame:
    """The rows of all committed batches, each once; ``batch_column`` adds the id."""
    if not commits.record_names(spark, ledger_path(path)):
        raise FileNotFoundError(f"no batch has been appended to {path}")
    rows = spark.read.option("mergeSchema", True).parquet(path)
    ledger = read_ledger(spark, path).select("batch_id", F.col("folder").alias("__folder"))
    met = rows.join(ledger, F.col(FOLDER) == F.col("__folder"))
    kept = [F.col(f"`{c}`") for c in rows.columns if c != FOLDER]
    return met.select(*kept, *([F.col("batch_id").alias(batch_column)] if batch_column else []))


def write_by_day(df: DataFrame, path: str, day: str = "STAT_CYCLE") -> None:
    """Write ``df`` by day; days it holds are replaced, all others stay. Rows of a
    day are brought together, and AQE splits a day that is too large for a task."""
    (df.hint("rebalance", F.col(day)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path))
