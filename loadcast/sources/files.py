"""File sources and sinks.

* ``read_table`` — CSV (header, no inference pass) or Parquet. With a declared
  schema CSV columns are taken by their header names, whatever their order;
  columns beyond the schema stay as strings, a declared one that the header
  lacks is an error, and so is a value that does not fit its type.
* ``write_table`` — overwrite or append, Parquet by default. A single output
  file (``single_file=True``) is for small exports only: it funnels the last
  stage through one task.
* ``publish`` — replace what is at the final URI: written beside it first and
  then moved there, so a write that fails leaves the old table. Readers that must
  never meet the moment of the move use ``published.publish_version``.
* ``ingest`` — land a raw upload: read with the declared schema, check the
  columns, write it as Parquet under the target.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import RAW_SCHEMA, clean_schema
from . import commits


def _strict(column: Column, field: T.StructField) -> Column:
    """The text as the declared type; a text that does not fit fails the job."""
    if isinstance(field.dataType, T.StringType):
        return column.alias(field.name)
    value = column.try_cast(field.dataType)
    bad = column.isNotNull() & value.isNull()
    message = F.concat(F.lit(f"{field.name}: not a {field.dataType.simpleString()}: "), column)
    return F.when(bad, F.raise_error(message).cast(field.dataType)).otherwise(value).alias(field.name)


def by_header(rows: DataFrame, schema: T.StructType, required=None) -> DataFrame:
    """Text columns as the declared ones, in declared order, then the others.
    ``required`` (all declared ones by default) must be in the header."""
    missing = [f for f in (schema.fieldNames() if required is None else required) if f not in rows.columns]
    if missing:
        raise ValueError(f"the header lacks {missing}")
    declared = [_strict(F.col(f"`{f.name}`"), f) if f.name in rows.columns
                else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    names = set(schema.fieldNames())
    return rows.select(*declared, *[F.col(f"`{c}`") for c in rows.columns if c not in names])


def csv_options(reader):
    """A header in every file, the same in all files of a read; broken rows fail."""
    return reader.option("header", True).option("mode", "FAILFAST").option("enforceSchema", False)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | None = None) -> DataFrame:
    if fmt == "csv":
        rows = csv_options(spark.read).csv(path)  # text columns: no inference pass
        return rows if schema is None else by_header(rows, schema)
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path) if fmt == "parquet" else reader.format(fmt).load(path)


def read_raw_csv(spark: SparkSession, path: str) -> DataFrame:
    """Raw meter-day CSV with the declared 107-column schema."""
    return read_table(spark, path, "csv", RAW_SCHEMA)


def read_clean_csv(spark: SparkSession, path: str, carry=("STAT_CYCLE",)) -> DataFrame:
    """A published cleaned CSV, with its declared schema. ``carry`` lists the
    id columns the file keeps beyond the 58 cleaned columns (none for a file
    in the reference's exact layout)."""
    return read_table(spark, path, "csv", clean_schema(carry))


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                single_file: bool = False, partition_by: list[str] | None = None) -> None:
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def append_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Add a batch to a result history; earlier batches stay."""
    write_table(df, path, fmt, mode="append")


def publish(df: DataFrame, uri: str, fmt: str = "csv", single_file: bool = False) -> None:
    """Replace whatever is published under ``uri`` by ``df``."""
    spark, uri = df.sparkSession, uri.rstrip("/")
    mark = uuid.uuid4().hex[:12]
    staged, replaced = f"{uri}.staged-{mark}", f"{uri}.replaced-{mark}"
    try:
        write_table(df, staged, fmt, mode="error", single_file=single_file)
    except BaseException:
        commits.delete(spark, staged)
        raise
    had = commits.exists(spark, uri)
    if had:
        commits.move(spark, uri, replaced)
    if not commits.move(spark, staged, uri):
        raise RuntimeError(f"{uri}: another writer published at the same time; {staged} holds this table")
    if had:
        commits.delete(spark, replaced)


def ingest(spark: SparkSession, src: str, dst: str, fmt: str = "csv") -> DataFrame:
    """Land a raw meter-day upload as Parquet and return the landed table."""
    raw = read_table(spark, src, fmt, RAW_SCHEMA if fmt == "csv" else None)
    missing = [c for c in ("MP_ID", "STAT_CYCLE", "AREA_NO") if c not in raw.columns]
    if missing:  # a CSV without them has failed already, by its own header
        raise ValueError(f"upload lacks key columns {missing}")
    write_table(raw, dst, "parquet", mode="overwrite")
    return spark.read.parquet(dst)
