"""Joins against a small side whose size is measured before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir

# Upper bound for a broadcast side: rows and estimated bytes.
MAX_BROADCAST_ROWS = 200_000
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def _row_bytes(df: DataFrame) -> int:
    """Rough width of a row: 8 bytes per fixed-width field, 64 per other."""
    fixed = (T.NumericType, T.DateType, T.TimestampType, T.BooleanType)
    return 16 + sum(8 if isinstance(f.dataType, fixed) else 64 for f in df.schema.fields)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage.

    A reliable checkpoint survives the loss of the executors that computed it;
    later reads never recompute the upstream plan.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def bounded_broadcast(small: DataFrame, max_rows: int | None = None,
                      max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """Materialize ``small``, count it, and mark it for broadcast only when the
    count and its estimated size are under the bounds.

    Returns (frame, broadcast?). Above the bounds the frame is returned
    unmarked: the join shuffles unless Spark's own size-checked broadcast
    threshold applies, and AQE's skew-join handling splits a hot key on the
    large side (one row per key on the small side makes that safe).
    """
    max_rows = MAX_BROADCAST_ROWS if max_rows is None else max_rows
    max_bytes = MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    frozen = materialize(small)
    rows = frozen.count()
    fits = rows <= max_rows and rows * _row_bytes(frozen) <= max_bytes
    return (F.broadcast(frozen) if fits else frozen), fits
