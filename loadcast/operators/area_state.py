"""Area means that follow arriving uploads.

The state is mergeable: the sum and the count of every imputed column per area,
one small batch per upload, appended once under the upload's id. The means of all
uploads so far are one aggregate over these batches, so a new upload costs a pass
over itself and none over the table. Semantics as in ``clean``: nulls are skipped,
NaN is a value, a null area has means of its own that no row is filled from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import IMPUTED
from ..sources.history import append_once, read_history
from .clean import impute_area_mean

KEY_COLUMN = "AREA_NO"


def area_sums(df: DataFrame, columns=IMPUTED, key: str = KEY_COLUMN) -> DataFrame:
    """The key, and ``sum_c`` and ``n_c`` of every listed column."""
    return df.groupBy(key).agg(*[F.sum(F.col(c).cast("double")).alias(f"sum_{c}") for c in columns],
                               *[F.count(c).alias(f"n_{c}") for c in columns])


def add_upload(df: DataFrame, state: str, upload_id: str, columns=IMPUTED, key: str = KEY_COLUMN) -> bool:
    """Count an upload; False if one with this id was counted before."""
    return append_once(area_sums(df, columns, key), state, upload_id)


def stored_means(spark: SparkSession, state: str, columns=IMPUTED, key: str = KEY_COLUMN) -> DataFrame:
    """The means of all counted uploads, as ``clean.area_means`` of their rows."""
    # Without a value the sum is null, and so is the mean.
    return read_history(spark, state).groupBy(key).agg(
        *[F.when(F.sum(f"n_{c}") > 0, F.try_divide(F.sum(f"sum_{c}"), F.sum(f"n_{c}"))).alias(c) for c in columns])


def impute_from_state(df: DataFrame, state: str, columns=IMPUTED, key: str = KEY_COLUMN) -> DataFrame:
    """``df`` with its gaps filled from the stored means."""
    return impute_area_mean(df, columns, key, stored_means(df.sparkSession, state, columns, key))
