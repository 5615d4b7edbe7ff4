"""Cleaning operators on hand-made frames (FIXTURES.md §5) and on sf0.001."""

import math

from pyspark.sql import functions as F

from loadcast.operators.clean import (
    area_means,
    clean,
    complete_rows,
    drop_columns,
    drop_sparse_columns,
    impute_area_mean,
    missing_profile,
    recode_trade,
)
from loadcast.schema import IMPUTED, RAW_COLUMNS, REMOVED, clean_columns
from loadcast.sources.meter_day import meter_day

from .conftest import SF001


def test_impute_edge_cases(spark):
    # impute_edge: null key with null and non-null load; all-null area; one null.
    rows = [
        (None, 1, None), (None, 2, 7),
        (1, 3, None), (1, 4, None),
        (2, 5, 10), (2, 6, 20), (2, 7, None),
    ]
    df = spark.createDataFrame(rows, "AREA_NO int, MP_ID int, LOAD0 int")
    out = impute_area_mean(df, ["LOAD0"])
    assert out.columns[0] == "AREA_NO"
    assert dict(out.dtypes)["LOAD0"] == "double"
    got = {r.MP_ID: r.LOAD0 for r in out.collect()}
    assert got[1] is None          # null key matches no mean
    assert got[2] == 7.0
    assert got[3] is None and got[4] is None   # all-null area stays null
    assert got[5] == 10.0 and got[6] == 20.0   # non-null values unchanged
    assert got[7] == 15.0          # filled with the area mean


def test_nan_is_kept_by_impute_and_dropped_by_complete_rows(spark):
    df = spark.createDataFrame(
        [(1, 1.0), (1, float("nan")), (1, None)], "AREA_NO int, LOAD0 double")
    out = impute_area_mean(df, ["LOAD0"]).collect()
    vals = [r.LOAD0 for r in out]
    # avg over a NaN is NaN: the null is filled with NaN, NaN stays NaN.
    assert sum(1 for v in vals if v is not None and math.isnan(v)) == 2
    assert complete_rows(df).count() == 1


def test_trade_codes(spark):
    rows = [("31B0",), ("311",), ("31C0",), ("31.0",), ("",), (None,), (" 31 ",), ("3100.7",), ("-2",)]
    df = spark.createDataFrame(rows, "TRADE_NO string")
    got = [r.TRADE_NO for r in recode_trade(df).collect()]
    # 31B0 → 3000; a decimal part and space are dropped; other codes → null.
    assert got == [3000, 311, None, 31, None, None, 31, 3100, -2]
    assert dict(recode_trade(df).dtypes)["TRADE_NO"] == "int"
    # A numeric column has nothing to recode.
    num = spark.createDataFrame([(311,), (None,)], "TRADE_NO int")
    assert [r.TRADE_NO for r in recode_trade(num).collect()] == [311, None]


def test_drop_columns_ignores_absent_names(spark):
    df = spark.createDataFrame([(1, 2.0)], "MP_ID long, LOAD0 double")
    assert drop_columns(df).columns == ["MP_ID", "LOAD0"]
    assert drop_columns(df, ["LOAD0", "NOPE"]).columns == ["MP_ID"]


def test_missing_profile_and_sparse_columns(spark):
    df = spark.createDataFrame(
        [(1, None, 1.0), (2, None, None), (3, None, 2.0), (4, None, 3.0)],
        "a int, b double, c double")
    prof = {r.column_name: (r.missing_count, r.missing_ratio)
            for r in missing_profile(df).collect()}
    assert prof == {"a": (0, 0.0), "b": (4, 1.0), "c": (1, 0.25)}
    assert drop_sparse_columns(df, 0.5).columns == ["a", "c"]
    empty = df.limit(0)
    assert all(r.missing_ratio is None for r in missing_profile(empty).collect())


def test_clean_shape_and_order_on_fixture(spark):
    raw = meter_day(spark, SF001)
    cleaned = clean(raw)
    assert cleaned.columns == clean_columns()
    assert len(cleaned.columns) == 58
    assert not set(REMOVED) & set(cleaned.columns)
    assert dict(cleaned.dtypes)["TRADE_NO"] == "int"
    # Removal precedes completeness: MLOAD* is all null yet rows survive.
    assert raw.where(F.col("MLOAD0").isNotNull()).count() == 0
    assert complete_rows(cleaned).count() > 0
    assert cleaned.count() == raw.count()


def test_imputation_never_changes_non_null_values(spark):
    raw = drop_columns(meter_day(spark, SF001), carry=("STAT_CYCLE",))
    filled = impute_area_mean(raw)
    j = raw.alias("r").join(filled.alias("f"), ["MP_ID", "STAT_CYCLE"])
    changed = j.where(F.exists(F.array(*[
        F.col(f"r.{c}").isNotNull() & (F.col(f"r.{c}") != F.col(f"f.{c}")) for c in IMPUTED
    ]), lambda x: x))
    assert changed.count() == 0
    # Every null of an area with at least one value is filled.
    means = {r.AREA_NO: r for r in area_means(raw).collect()}
    for r in filled.collect():
        for c in IMPUTED:
            if r[c] is None:
                assert means[r.AREA_NO][c] is None


def test_raw_schema_columns(spark):
    raw = meter_day(spark, SF001)
    assert tuple(raw.columns) == RAW_COLUMNS
    assert len(RAW_COLUMNS) == 107
