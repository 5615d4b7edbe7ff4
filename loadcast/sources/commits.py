"""Commit records: small JSON files that appear whole or not at all.

A record is written under a hidden temporary name and moved to its own, which
fails if that name is taken. So a reader never meets half a record, and of two
writers of one name one is told that it came second. Versions, batches and fits
elsewhere in the library are data folders written first and named by such a
record last; what no record names does not exist for readers.

Uses the Hadoop file system behind the session, so any URI Spark can write works
whose moves are atomic (on object stores: as atomic as the connector's).
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession

_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._~-]*")


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _file_system(spark, path)
    return fs.exists(at)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, at = _file_system(spark, path)
    fs.mkdirs(at)


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds; nothing if it is not there."""
    fs, at = _file_system(spark, path)
    fs.delete(at, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, hidden ones left out; none if there is no such folder."""
    fs, at = _file_system(spark, folder)
    if not fs.exists(at):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(n for n in found if not n.startswith((".", "_")))


def move(spark: SparkSession, src: str, dst: str) -> bool:
    """``src`` becomes ``dst``; False, and nothing moved, if ``dst`` is there."""
    fs, target = _file_system(spark, dst)
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(jvm.org.apache.hadoop.fs.Path(src), target, plain)
    except Exception:
        if fs.exists(target):
            return False
        raise
    return True


def put(spark: SparkSession, folder: str, name: str, record: dict) -> bool:
    """Write the record ``name``; False if there is one already."""
    if not _NAME.fullmatch(name):
        raise ValueError(f"not a record name: {name!r}")
    final = f"{folder.rstrip('/')}/{name}.json"
    if exists(spark, final):
        return False
    temporary = f"{folder.rstrip('/')}/.{name}-{uuid.uuid4().hex}"
    fs, at = _file_system(spark, temporary)
    out = fs.create(at, True)
    try:
        out.write(bytearray(json.dumps(record).encode()))
    finally:
        out.close()
    if move(spark, temporary, final):
        return True
    delete(spark, temporary)
    return False


def get(spark: SparkSession, folder: str, name: str) -> dict | None:
    fs, at = _file_system(spark, f"{folder.rstrip('/')}/{name}.json")
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def record_names(spark: SparkSession, folder: str) -> list[str]:
    return [n[:-5] for n in names(spark, folder) if n.endswith(".json")]


def latest(spark: SparkSession, folder: str) -> tuple[str, dict] | None:
    """The record whose name sorts last, and its name."""
    found = record_names(spark, folder)
    return (found[-1], get(spark, folder, found[-1])) if found else None
