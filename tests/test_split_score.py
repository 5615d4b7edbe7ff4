"""Split, relative error, RMSE."""

import duckdb
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from loadcast.functions.exprs import relative_error_expr, rmse_expr, split_bucket_expr
from loadcast.operators.clean import complete_rows
from loadcast.operators.split import hash_split, random_split
from loadcast.sources.meter_day import meter_day

from .conftest import SF001, SF01


def test_hash_split_is_a_partition_and_layout_free(spark):
    rows = complete_rows(meter_day(spark, SF01).select("MP_ID", "STAT_CYCLE", "LOAD0"))
    train, test = hash_split(rows)
    n, a, b = rows.count(), train.count(), test.count()
    assert a + b == n and a > 0 and b > 0
    assert train.join(test, ["MP_ID", "STAT_CYCLE"]).count() == 0
    shuffled = rows.repartition(7, "LOAD0")
    train2, _ = hash_split(shuffled)
    assert train2.select("MP_ID", "STAT_CYCLE").exceptAll(
        train.select("MP_ID", "STAT_CYCLE")).count() == 0
    assert train2.count() == a


def test_meter10_split_counts(spark):
    # FIXTURES §4: at sf0.01 with 10 meters, 203 of 300 raw rows train.
    raw = meter_day(spark, SF01, meters=10)
    assert raw.count() == 300
    train, _ = hash_split(raw)
    assert train.count() == 203


def test_split_bucket_equals_duckdb(spark):
    keys = meter_day(spark, SF001).select("MP_ID", "STAT_CYCLE")
    got = {(r.MP_ID, str(r.STAT_CYCLE)): r.b for r in
           keys.select("*", split_bucket_expr("MP_ID", "STAT_CYCLE").alias("b")).collect()}
    con = duckdb.connect()
    for (mp, day), b in list(got.items())[:200]:
        want = con.execute(
            "SELECT CAST(('0x' || substr(md5(?), 1, 8))::BIGINT % 100 AS INTEGER)",
            [f"{mp}|{day}"]).fetchone()[0]
        assert want == b


def test_random_split_seeded(spark):
    df = spark.range(1000).repartition(4)
    a1, b1 = random_split(df)
    a2, _ = random_split(df)
    assert a1.count() + b1.count() == 1000
    assert sorted(r.id for r in a1.collect()) == sorted(r.id for r in a2.collect())


def test_relative_error_edges(spark):
    # error_edge: y = 0, negative prediction, null y, exact hit.
    df = spark.createDataFrame(
        [(0.0, 2.5), (4.0, -1.0), (None, 3.0), (5.0, 5.0)], "LOAD0 double, TLOAD0 double")
    got = [r.re for r in df.select(relative_error_expr("LOAD0", "TLOAD0").alias("re")).collect()]
    assert got == [2.5, 1.25, 3.0, 0.0]


def test_rmse_matches_regression_evaluator(spark):
    df = spark.createDataFrame(
        [(1.0, 1.5), (2.0, 1.0), (3.0, 3.25), (4.0, 6.0)], "LOAD0 double, TLOAD0 double")
    ours = df.agg(rmse_expr("LOAD0", "TLOAD0").alias("r")).first().r
    ev = RegressionEvaluator(labelCol="LOAD0", predictionCol="TLOAD0", metricName="rmse")
    assert ours == pytest.approx(ev.evaluate(df), rel=1e-15)


def test_nan_edge_dropna(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "LOAD0 double")
    assert [r.LOAD0 for r in complete_rows(df).collect()] == [1.0]
    assert df.where(F.col("LOAD0").isNull()).count() == 1
