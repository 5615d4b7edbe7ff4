"""Incremental forms of two batch steps, for uploads that keep arriving.

* ``ingest_stream`` — raw meter-day files landing in a folder are read with
  the declared schema and appended as Parquet (the continuous form of the
  upload-and-land step).
* ``score_stream`` — cleaned rows landing in a folder are scored by the 24
  saved models and the wide result is appended (the continuous form of the
  per-hour result append). Scoring is a row-wise projection, so it needs no
  state; RMSE stays a batch report over the written result.

Both keep their checkpoint beside the result, in ``<dst>/_checkpoint``, unless
told another place, so a restarted query resumes where it stopped and every file
is processed exactly once. CSV uploads are read by header name as in the batch
form: the header of the files that are there fixes the columns of the stream, a
later file with another header fails it, and so does a broken row.
``available_now=True`` processes what is there and stops (used by tests and
scheduled runs); ``False`` keeps the query running.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import complete_rows
from ..operators.score import predict_hours, wide_result
from ..schema import RAW_SCHEMA, RESULT_CONTEXT
from ..sources.files import by_header, csv_options


def _start(df, dst: str, checkpoint: str | None, available_now: bool):
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("path", dst)
              .option("checkpointLocation", checkpoint or f"{dst.rstrip('/')}/_checkpoint"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()


def ingest_stream(spark: SparkSession, src_dir: str, dst_dir: str,
                  checkpoint: str | None = None, available_now: bool = True,
                  max_files_per_trigger: int = 1000) -> StreamingQuery:
    header = csv_options(spark.read).csv(src_dir).schema
    rows = (csv_options(spark.readStream).schema(header)
            .option("maxFilesPerTrigger", max_files_per_trigger).csv(src_dir))
    return _start(by_header(rows, RAW_SCHEMA), dst_dir, checkpoint, available_now)


def score_stream(spark: SparkSession, src_dir: str, schema: T.StructType, models: dict,
                 dst_dir: str, checkpoint: str | None = None, digits: int | None = 4,
                 id_cols=RESULT_CONTEXT, available_now: bool = True) -> StreamingQuery:
    rows = complete_rows(spark.readStream.schema(schema).parquet(src_dir))
    keep = [c for c in ("STAT_CYCLE",) + tuple(id_cols) if c in schema.fieldNames()]
    scored = predict_hours(rows, models, digits, keep=keep)
    result = wide_result(scored, list(models), keep)
    return _start(result, dst_dir, checkpoint, available_now)
