"""Column expressions. All built-in functions: they stay inside whole-stage
codegen and never leave the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import TRADE_CODE_FROM, TRADE_CODE_TO


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def recode_trade_expr(c="TRADE_NO", numeric: bool = False) -> Column:
    """``31B0`` → 3000, then an integer; any other non-numeric code → null.

    As a non-ANSI cast reads it: space around the number and a decimal part are
    dropped (``3100.0`` → 3100), a bad code gives null under ANSI mode as well. A
    column that is numeric already has nothing to recode.
    """
    col = _c(c)
    if numeric:
        return col.cast("int")
    recoded = F.when(col == F.lit(TRADE_CODE_FROM), F.lit(TRADE_CODE_TO)).otherwise(col)
    whole = F.regexp_extract(recoded, r"^\s*([+-]?\d+)(\.\d*)?\s*$", 1)
    return whole.try_cast("int")


def relative_error_expr(label, prediction) -> Column:
    """|y − ŷ| / |y| where y ≠ 0, else |ŷ| (a null y takes the else branch)."""
    y, p = _c(label), _c(prediction)
    return F.when(y != 0, F.abs(y - p) / F.abs(y)).otherwise(F.abs(p))


def maybe_round(c, digits: int | None) -> Column:
    return _c(c) if digits is None else F.round(_c(c), digits)


def squared_error_expr(label, prediction) -> Column:
    d = _c(label) - _c(prediction)
    return d * d


def rmse_expr(label, prediction) -> Column:
    """Root of the mean squared error, as ``RegressionEvaluator`` computes it."""
    return F.sqrt(F.avg(squared_error_expr(label, prediction)))


def split_bucket_expr(*key_cols, buckets: int = 100) -> Column:
    """Stable bucket in [0, buckets): the first 8 hex digits of
    md5(k1 | k2 | ...) read as an integer, modulo ``buckets``.

    A function of the row key alone, so it does not change with file layout,
    partitioning or task retries, and train and predict agree.
    """
    key = F.concat_ws("|", *[_c(k).cast("string") for k in key_cols])
    head = F.substring(F.md5(key), 1, 8)
    return (F.conv(head, 16, 10).cast("long") % buckets).cast("int")
