"""Physical-plan properties that matter at scale: broadcast only behind a size
check (with a shuffle fallback that gives the same rows), a hot area handled,
filters and column pruning at the scan, no shuffle in split and scoring."""

from pyspark.sql import functions as F

from loadcast.operators import joins
from loadcast.operators.clean import complete_rows, impute_area_mean
from loadcast.operators.split import hash_split
from loadcast.schema import IMPUTED


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _hot_area_frame(spark, n=3000):
    # A third of all rows sit in area 0; loads are null on every fifth row.
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise((F.col("id") % 50) + 1)
        .cast("int").alias("AREA_NO"),
        F.col("id").alias("MP_ID"),
        *[F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise((F.col("id") * (i + 1)) % 97)
          .cast("double").alias(c) for i, c in enumerate(IMPUTED[:4])],
    )


def test_imputation_broadcasts_small_means(spark):
    out = impute_area_mean(_hot_area_frame(spark), IMPUTED[:4])
    plan = _plan(out)
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan


def test_shuffle_fallback_gives_same_rows(spark, monkeypatch):
    df = _hot_area_frame(spark)
    a = impute_area_mean(df, IMPUTED[:4])
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 0)
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        b = impute_area_mean(df, IMPUTED[:4])
        plan = _plan(b)
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert a.count() == 3000


def test_bounded_broadcast_reports_fit(spark):
    small = spark.range(10)
    _, fits = joins.bounded_broadcast(small)
    assert fits
    _, fits = joins.bounded_broadcast(small, max_rows=5)
    assert not fits


def test_scan_gets_pushed_filters_and_pruned_columns(spark, cleaned01, tmp_root):
    path = f"{tmp_root}/plan_cleaned"
    cleaned01.write.mode("overwrite").parquet(path)
    table = spark.read.parquet(path)
    train, _ = hash_split(complete_rows(table))
    plan = _plan(train.select("MP_ID", "LOAD0"))
    assert "PushedFilters: [IsNotNull(AREA_NO)" in plan
    # The split and the complete-row filter add no exchange.
    assert "Exchange" not in plan
    means_plan = _plan(table.groupBy("AREA_NO").agg(F.avg("LOAD0")))
    assert "ReadSchema: struct<AREA_NO:int,LOAD0:double>" in means_plan


def test_meter_day_plan_reads_three_columns_and_shuffles_twice(spark):
    from loadcast.sources.meter_day import meter_day

    from .conftest import SF001
    plan = _plan(meter_day(spark, SF001))
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,value:double>" in \
        meter_day(spark, SF001)._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    # Partial aggregate before the first exchange (map-side combine).
    assert "partial_sum" in plan
    assert plan.count("Exchange hashpartitioning") == 2


def test_result_pages_without_full_key_are_a_partition(spark):
    from loadcast.operators.paging import page

    df = spark.createDataFrame([(i % 3, float(i)) for i in range(47)], "MP_ID long, TLOAD0 double")
    rows = [r for p in range(1, 4) for r in page(df, p, 20).collect()]
    assert sorted(r.TLOAD0 for r in rows) == [float(i) for i in range(47)]


def test_hot_meters_third_of_events_match_sql(spark):
    """Each of 3 meters holds a third of all events: the derivation and the
    cleaning stay exact (partial aggregation absorbs the hot keys)."""
    from oracles import ROUND, cleaned_cte, meter_day_ctes, with_
    from loadcast.operators.clean import clean
    from loadcast.sources.meter_day import meter_day

    from .conftest import SF01
    from .oracle_check import compare, duck

    cleaned = clean(meter_day(spark, SF01, meters=3))
    out = cleaned.withColumns({c: F.round(c, ROUND) for c in IMPUTED})
    rows = [tuple(r) for r in out.collect()]
    sql = with_(meter_day_ctes(3), cleaned_cte(ROUND)) + "SELECT * FROM cleaned"
    res = duck(SF01).execute(sql)
    ok, msg = compare(rows, out.columns, res.fetchall(), [d[0] for d in res.description])
    assert ok, msg
    assert len(rows) == 90  # 3 meters × 30 days


def test_scale_settings_for_100_tb():
    from loadcast.session import scale_settings

    conf = scale_settings(100 * 1024 ** 4, total_cores=8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 819200  # 100 TB / 128 MB
    assert scale_settings(10 * 1024 ** 2, 8000)["spark.sql.shuffle.partitions"] == "16000"
    assert conf["spark.sql.adaptive.skewJoin.enabled"] == "true"
