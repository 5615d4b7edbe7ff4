"""Cleaning: drop columns, profile missing values, fill gaps with the area
mean, recode and cast the trade code, keep complete rows.

Plan at scale (``clean``; the flow is ``plans.pipeline.clean_table``):

1. the area means are one hash aggregate over the key and the 48 load
   columns only (column pruning reaches the scan), with partial sums per task
   before the shuffle, so a hot area costs one buffer per task;
2. the means — one row per area — are checkpointed, counted and broadcast
   when small (``bounded_broadcast``); the large side is then never shuffled;
3. filling, recoding and casting are one projection in the same stage as the
   scan and the broadcast-hash join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import recode_trade_expr
from ..schema import IMPUTED, REMOVED
from .joins import bounded_broadcast

MEAN_PREFIX = "__area_mean__"


def drop_columns(df: DataFrame, columns=REMOVED, carry=()) -> DataFrame:
    """Drop the listed columns; names that are absent are ignored. Columns in
    ``carry`` are kept (an id such as ``STAT_CYCLE`` that later steps need)."""
    return df.drop(*[c for c in columns if c not in carry])


def missing_profile(df: DataFrame, columns=None) -> DataFrame:
    """One row per column: (ordinal, column_name, missing_count, missing_ratio)
    with ratio = 1 − count(c) / count(*). One global aggregate: every task
    returns one row of counts, the final merge sees one row per task."""
    cols = list(columns or df.columns)
    counts = df.agg(F.count(F.lit(1)).alias("__rows"),
                    *[F.count(F.col(c)).alias(f"__nn{i}") for i, c in enumerate(cols)])
    entries = F.array(*[
        F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"),
                 F.col(f"__nn{i}").alias("non_null"))
        for i, c in enumerate(cols)
    ])
    rows = counts.select("__rows", F.inline(entries))
    return rows.select(
        "ordinal",
        "column_name",
        (F.col("__rows") - F.col("non_null")).alias("missing_count"),
        (F.lit(1.0) - F.try_divide(F.col("non_null"), F.col("__rows"))).alias("missing_ratio"),
    )


def sparse_columns(df: DataFrame, max_missing: float, columns=None) -> list[str]:
    """Names of the columns whose missing ratio exceeds ``max_missing``. The
    profile holds one row per column, so collecting it is bounded by the
    width of the table, not its length."""
    prof = missing_profile(df, columns).where(F.col("missing_ratio") > F.lit(max_missing))
    return [r["column_name"] for r in prof.select("column_name").collect()]


def drop_sparse_columns(df: DataFrame, max_missing: float = 0.99, columns=None) -> DataFrame:
    """Drop the columns with more than ``max_missing`` of their values missing."""
    return df.drop(*sparse_columns(df, max_missing, columns))


def area_means(df: DataFrame, columns=IMPUTED, key: str = "AREA_NO") -> DataFrame:
    """Mean of each listed column per area, nulls skipped (null key → own group)."""
    present = [c for c in columns if c in df.columns]
    return df.groupBy(key).agg(*[F.avg(c).alias(c) for c in present])


def impute_area_mean(df: DataFrame, columns=IMPUTED, key: str = "AREA_NO",
                     means: DataFrame | None = None) -> DataFrame:
    """Fill nulls of the listed columns with the mean of the row's area.

    Semantics: a left join on the key, so a row with a null key keeps its nulls;
    an all-null area has a null mean and its nulls stay; NaN is not null and
    stays. The key becomes the first column; filled columns are double.
    """
    present = [c for c in columns if c in df.columns]
    if means is None:
        means = area_means(df, present, key)
    means = means.where(F.col(key).isNotNull()).select(
        key, *[F.col(c).cast("double").alias(MEAN_PREFIX + c) for c in present])
    small, _ = bounded_broadcast(means)
    joined = df.join(small, key, "left")
    fill = set(present)
    out = [
        F.coalesce(F.col(c).cast("double"), F.col(MEAN_PREFIX + c)).alias(c) if c in fill else F.col(c)
        for c in joined.columns if not c.startswith(MEAN_PREFIX)
    ]
    return joined.select(*out)


def recode_trade(df: DataFrame, column: str = "TRADE_NO") -> DataFrame:
    """``31B0`` → 3000, cast to int; other non-numeric codes become null."""
    if column not in df.columns:
        return df
    numeric = isinstance(df.schema[column].dataType, T.NumericType)
    return df.withColumn(column, recode_trade_expr(column, numeric=numeric))


def complete_rows(df: DataFrame) -> DataFrame:
    """Keep rows with no null (and no NaN) in any column — ``dropna(how="any")``
    written as a conjunction of ``IS NOT NULL`` (and ``NOT isnan`` for float
    columns), so that the null checks reach the Parquet scan as pushed filters."""
    conds = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        conds.append(c.isNotNull())
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            conds.append(~F.isnan(c))
    if not conds:
        return df
    cond = conds[0]
    for x in conds[1:]:
        cond = cond & x
    return df.where(cond)


def clean(raw: DataFrame, carry=()) -> DataFrame:
    """Drop the 49 unused columns, fill the 48 load columns with the area mean,
    recode and cast the trade code. Incomplete rows are kept (see
    ``complete_rows``) as in the published cleaned table."""
    dropped = drop_columns(raw, REMOVED, carry)
    return recode_trade(impute_area_mean(dropped))
