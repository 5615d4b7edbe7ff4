"""Versions under a fixed name.

A version is written to a folder of its own below ``uri`` first; then one small
pointer record names it. Readers follow the newest pointer. A write that fails
leaves the version before it in place and readable, and a reader never sees half
a version. Two writers at once: the second one is told and its folder removed.
The newest ``keep`` versions stay, so a reader that has just followed a pointer
can finish; older ones go once a new one is committed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import commits
from .files import csv_options, write_table

KEEP = 2


def _pointers(uri: str) -> str:
    return f"{uri.rstrip('/')}/_published"


def replace(spark: SparkSession, uri: str, write: Callable[[str], dict | None], keep: int = KEEP) -> int:
    """Commit the folder that ``write(folder)`` fills as the next version; what it
    returns is kept in the pointer. Returns the version's number."""
    if keep < 1:
        raise ValueError("at least one version stays")
    base, pointers = uri.rstrip("/"), _pointers(uri)
    last = commits.latest(spark, pointers)
    number = int(last[0]) + 1 if last else 1
    folder = f"{number:012d}-{uuid.uuid4().hex[:12]}"
    try:
        notes = write(f"{base}/{folder}") or {}
        done = commits.put(spark, pointers, f"{number:012d}", {**notes, "folder": folder})
    except BaseException:
        commits.delete(spark, f"{base}/{folder}")
        raise
    if not done:
        commits.delete(spark, f"{base}/{folder}")
        raise RuntimeError(f"{uri}: another writer published version {number} first")
    for old in commits.record_names(spark, pointers)[:-keep]:
        gone = commits.get(spark, pointers, old)
        commits.delete(spark, f"{pointers}/{old}.json")
        if gone:
            commits.delete(spark, f"{base}/{gone['folder']}")
    return number


def is_published(spark: SparkSession, uri: str) -> bool:
    return commits.latest(spark, _pointers(uri)) is not None


def current(spark: SparkSession, uri: str) -> tuple[str, dict]:
    """The newest version's folder, and its pointer."""
    last = commits.latest(spark, _pointers(uri))
    if last is None:
        raise FileNotFoundError(f"nothing is published under {uri}")
    return f"{uri.rstrip('/')}/{last[1]['folder']}", last[1]


def publish_version(df: DataFrame, uri: str, fmt: str = "parquet", keep: int = KEEP) -> int:
    """Publish ``df`` under ``uri`` as a new version."""
    def write(folder: str) -> dict:
        write_table(df, folder, fmt, mode="error")
        return {"format": fmt, "schema": df.schema.json()}

    return replace(df.sparkSession, uri, write, keep)


def read_published(spark: SparkSession, uri: str) -> DataFrame:
    """The newest version, with the schema it was published with."""
    folder, record = current(spark, uri)
    reader = spark.read.schema(T.StructType.fromJson(json.loads(record["schema"])))
    if record["format"] == "csv":
        return csv_options(reader).csv(folder)
    return reader.format(record["format"]).load(folder)
