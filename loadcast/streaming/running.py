"""Streams whose small state is committed with each micro-batch.

* ``impute_uploads`` — raw rows that land are counted in the stored area sums and
  filled from the means of all uploads so far, theirs included: a join of the
  micro-batch with a small table, and no pass over earlier uploads.
* ``score_uploads`` — cleaned rows that land are scored by the saved models; the rows
  and squared errors of each hour are kept in the ledger record that commits the
  scored batch, so result and error cannot part. ``running_rmse`` adds them up.

Both append each micro-batch once, under the stream's id and the batch's number: a
batch that is tried again after a failure is not counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.area_state import add_upload, impute_from_state
from ..operators.clean import complete_rows
from ..operators.score import error_sums, predict_hours, wide_result
from ..schema import FEATURES, IMPUTED, RESULT_CONTEXT
from ..sources.history import append_once, read_ledger
from .uploads import batch_name


def _each(rows: DataFrame, do, checkpoint: str, available_now: bool) -> StreamingQuery:
    writer = rows.writeStream.foreachBatch(do).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()


def impute_uploads(spark: SparkSession, src_dir: str, schema: T.StructType, state: str, dst: str,
                   columns=IMPUTED, checkpoint: str | None = None, available_now: bool = True,
                   max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Count and fill the Parquet rows that land in ``src_dir``."""
    def fill(batch: DataFrame, batch_id: int) -> None:
        name = batch_name(batch.sparkSession, batch_id)
        add_upload(batch, state, name, columns)
        append_once(impute_from_state(batch, state, columns), dst, name)

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(src_dir)
    return _each(rows, fill, checkpoint or f"{dst.rstrip('/')}/_checkpoint", available_now)


def score_batch(rows: DataFrame, models: dict, dst: str, batch_id: str, digits: int | None = 4,
                features=FEATURES, id_cols=RESULT_CONTEXT) -> bool:
    """Append the scored complete rows of a batch once, with their squared errors."""
    labels = list(models)
    keep = [c for c in dict.fromkeys(("STAT_CYCLE", *id_cols)) if c in rows.columns]
    errors = Observation()
    scored = predict_hours(complete_rows(rows), models, digits, features=features, keep=keep).observe(errors, *error_sums(labels))

    def notes() -> dict:
        seen = errors.get
        return {"rows": seen["rows"], "sse": {lab: seen[f"sse_{lab}"] or 0.0 for lab in labels}}

    return append_once(wide_result(scored, labels, keep), dst, batch_id, notes)


def score_uploads(spark: SparkSession, src_dir: str, schema: T.StructType, models: dict, dst: str,
                  digits: int | None = 4, features=FEATURES, id_cols=RESULT_CONTEXT, checkpoint: str | None = None,
                  available_now: bool = True, max_files_per_trigger: int = 1000) -> StreamingQuery:
    """Score the cleaned Parquet rows that land in ``src_dir``."""
    def score(batch: DataFrame, batch_id: int) -> None:
        score_batch(batch, models, dst, batch_name(batch.sparkSession, batch_id), digits, features, id_cols)

    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(src_dir)
    return _each(rows, score, checkpoint or f"{dst.rstrip('/')}/_checkpoint", available_now)


def running_rmse(spark: SparkSession, dst: str) -> DataFrame:
    """(label, hour, rows, rmse) over all scored batches, from the ledger alone."""
    kind = "batch_id string, folder string, rows long, sse map<string,double>"
    parts = read_ledger(spark, dst, kind).where("rows > 0").select("rows", F.explode("sse").alias("label", "sse"))
    total = parts.groupBy("label").agg(F.sum("rows").alias("rows"), F.sum("sse").alias("sse"))
    hour = F.regexp_extract("label", r"(\d+)$", 1).cast("int")
    return total.select("label", hour.alias("hour"), "rows", F.sqrt(F.col("sse") / F.col("rows")).alias("rmse"))
