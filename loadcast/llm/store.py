"""Cutting lineage through the shared folder of ``spark.checkpoint.dir``."""

from __future__ import annotations

import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Bytes of a batch on its way to or from a Python task.
BATCH_BYTES = 4 * 1024 * 1024
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
_UNITS = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}
#: Of each session: jobs inside ``small_batches``, and the setting before them.
_inside: dict[int, tuple[int, str]] = {}
_lock = threading.Lock()


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs started inside send at most ``BATCH_BYTES`` (or one row) at a time to a
    Python task. Batches bounded by rows alone hold tens of MB of text, and each
    is in memory several times: in the JVM's growing buffers, in the worker, in
    what the worker makes of it. A smaller setting of the session stays."""
    with _lock:
        depth, before = _inside.get(id(spark), (0, ""))
        if not depth:
            before = spark.conf.get(_BATCH)
            number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", before.strip().lower()).groups()
            spark.conf.set(_BATCH, str(min(int(number) * _UNITS[unit], BATCH_BYTES)))
        _inside[id(spark)] = depth + 1, before
    try:
        yield
    finally:
        with _lock:
            depth, before = _inside.pop(id(spark))
            if depth > 1:
                _inside[id(spark)] = depth - 1, before
            else:
                spark.conf.set(_BATCH, before)


def checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session, set from ``spark.checkpoint.dir``.

    Only a local master (one process, one disk) may go without the setting: it
    then gets a temporary folder. Elsewhere a missing setting is an error.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = sc.getConf().get("spark.checkpoint.dir", None)
        if not named:
            if not sc.master.startswith("local[") and sc.master != "local":
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="loadcast-llm-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read from there."""
    checkpoint_dir(df.sparkSession)
    with small_batches(df.sparkSession):
        return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def land(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/loadcast-llm/{uuid.uuid4().hex}"
    with small_batches(spark):
        df.write.parquet(path)
    return spark.read.parquet(path)
