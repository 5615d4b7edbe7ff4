"""Paging, page counts, file sources and sinks, streaming ingest and scoring."""

import os

import pytest
from pyspark.sql import functions as F

from loadcast.operators.paging import build_page_index, page, page_count, read_page
from loadcast.operators.train import fit_hours
from loadcast.plans.pipeline import model_inputs
from loadcast.schema import RAW_SCHEMA
from loadcast.sources.files import append_table, ingest, publish, read_raw_csv, write_table
from loadcast.sources.inspect import preview, schema_report
from loadcast.sources.meter_day import meter_day
from loadcast.streaming.incremental import ingest_stream, score_stream

from .conftest import SF001


@pytest.mark.parametrize("n", [0, 1, 20, 21, 40])
def test_page_edges(spark, n):
    df = spark.range(n).select(F.col("id"), (F.col("id") * 2).alias("v"))
    pc = page_count(df, 20).first()
    assert pc.total_rows == n and pc.total_pages == (n + 19) // 20
    pages = [page(df, p, 20, ["id"]).collect() for p in range(1, pc.total_pages + 2)]
    assert [r.id for p in pages for r in p] == list(range(n))
    assert pages[-1] == []  # past the end → empty
    with pytest.raises(ValueError):
        page(df, 0, 20, ["id"])


def test_indexed_pages_across_chunks(spark, tmp_root):
    df = spark.range(0, 537, 1, 5).select(((F.col("id") * 7919) % 537).alias("k"))
    path = build_page_index(df, f"{tmp_root}/page_index", ["k"], rows_per_chunk=33)
    pages = [[r.k for r in read_page(spark, path, p, 20, 33).collect()] for p in range(1, 29)]
    assert [k for p in pages for k in p] == list(range(537))
    assert pages == [[r.k for r in page(df, p, 20, ["k"]).collect()] for p in (1, 2)] + pages[2:]
    plan = read_page(spark, path, 3, 20, 33)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__chunk" in plan and "TakeOrderedAndProject" not in plan


def test_pages_on_a_tied_key_hold_every_row_once(spark, tmp_root):
    df = spark.range(2000).select((F.col("id") % 2).alias("tie"), F.col("id"))
    path = build_page_index(df, f"{tmp_root}/tied_index", ["tie"], rows_per_chunk=150)
    rows = [r.id for p in range(1, 101) for r in read_page(spark, path, p, 20, 150).collect()]
    assert len(rows) == 2000 and len(set(rows)) == 2000


def test_csv_is_read_by_header(spark, tmp_root):
    raw = meter_day(spark, SF001).limit(30).cache()
    swapped = raw.select(*reversed(raw.columns), F.lit("kept").alias("REMARK"))
    write_table(swapped, f"{tmp_root}/swapped", "csv")
    back = read_raw_csv(spark, f"{tmp_root}/swapped")
    assert back.columns == raw.columns + ["REMARK"]
    assert back.drop("REMARK").exceptAll(raw).count() == 0 and back.where("REMARK = 'kept'").count() == 30
    write_table(raw.drop("MP_ID"), f"{tmp_root}/no_key", "csv")
    for read in (lambda: ingest(spark, f"{tmp_root}/no_key", f"{tmp_root}/never"),
                 lambda: ingest_stream(spark, f"{tmp_root}/no_key", f"{tmp_root}/never_s")):
        with pytest.raises(ValueError, match="MP_ID"):
            read()
    broken = raw.withColumn("WINDSPEED", F.lit("fast"))
    write_table(broken, f"{tmp_root}/broken", "csv")
    with pytest.raises(Exception, match="WINDSPEED"):
        read_raw_csv(spark, f"{tmp_root}/broken").collect()
    with pytest.raises(Exception, match="WINDSPEED"):
        ingest_stream(spark, f"{tmp_root}/broken", f"{tmp_root}/never_b").awaitTermination(120)


def test_work_folder_must_be_shared_off_a_local_master(spark):
    from loadcast import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_csv_roundtrip_publish_append_ingest(spark, tmp_root):
    raw = meter_day(spark, SF001)
    path = f"{tmp_root}/csv_rt"
    write_table(raw, path, "csv")
    back = read_raw_csv(spark, path)
    assert back.schema == RAW_SCHEMA
    assert back.exceptAll(raw).count() == 0 and raw.exceptAll(back).count() == 0
    pub = f"{tmp_root}/published"
    publish(raw.limit(5), pub)
    publish(raw.limit(3), pub)
    assert any(f.endswith(".csv") for f in os.listdir(pub))
    publish(raw.limit(3), pub, single_file=True)
    assert len([f for f in os.listdir(pub) if f.endswith(".csv")]) == 1
    assert read_raw_csv(spark, pub).count() == 3
    hist = f"{tmp_root}/history"
    append_table(raw.limit(4), hist)
    append_table(raw.limit(6), hist)
    assert spark.read.parquet(hist).count() == 10
    landed = ingest(spark, path, f"{tmp_root}/landed")
    assert landed.count() == raw.count()


def test_schema_report_and_preview(spark):
    raw = meter_day(spark, SF001)
    rep = schema_report(raw).collect()
    assert len(rep) == 107 and rep[0].column_name == "MP_ID" and rep[0].data_type == "bigint"
    pv = preview(raw, 20, ["MP_ID", "STAT_CYCLE", "AREA_NO"]).collect()
    keys = [(r.MP_ID, r.STAT_CYCLE) for r in pv]
    assert len(pv) == 20 and keys == sorted(keys)


def test_streaming_ingest_and_score(spark, tmp_root, cleaned01):
    src = f"{tmp_root}/uploads"
    write_table(meter_day(spark, SF001), src, "csv")
    q = ingest_stream(spark, src, f"{tmp_root}/stream_landed",
                      checkpoint=f"{tmp_root}/stream_ckpt")
    q.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_root}/stream_landed").count() == \
        meter_day(spark, SF001).count()

    train, test = model_inputs(cleaned01)
    models = fit_hours(train, "ridge", ["LOAD0", "LOAD1"], parallelism=2)
    test_src = f"{tmp_root}/test_rows"
    write_table(test, test_src)
    q = score_stream(spark, test_src, cleaned01.schema, models, f"{tmp_root}/stream_scored",
                     checkpoint=f"{tmp_root}/score_ckpt")
    q.awaitTermination(120)
    scored = spark.read.parquet(f"{tmp_root}/stream_scored")
    assert scored.count() == test.count()
    assert {"TLOAD0", "TLOAD0_RE", "TLOAD1", "TLOAD1_RE", "MP_ID"} <= set(scored.columns)


def test_makedata_flow_and_split_options(spark, tmp_root):
    from loadcast.plans.pipeline import makedata, model_inputs
    from loadcast.schema import clean_schema

    src = f"{tmp_root}/makedata_src"
    write_table(meter_day(spark, SF001), src, "csv")
    out = makedata(spark, src, f"{tmp_root}/makedata_csv", fmt="csv")
    assert out.schema == clean_schema(("STAT_CYCLE",))
    pq = makedata(spark, src, f"{tmp_root}/makedata_pq")
    assert pq.count() == out.count() == meter_day(spark, SF001).count()
    h_train, h_test = model_inputs(pq)
    r_train, r_test = model_inputs(pq, "random")
    assert h_train.count() + h_test.count() == r_train.count() + r_test.count()
    # Without the key the hash split is refused; the caller may ask for a random one.
    no_key = pq.drop("STAT_CYCLE")
    with pytest.raises(ValueError, match="STAT_CYCLE"):
        model_inputs(no_key)
    a, b = model_inputs(no_key, "random")
    assert a.count() + b.count() == h_train.count() + h_test.count()


def test_stream_ingest_restart_processes_each_file_once(spark, tmp_root):
    import uuid

    run = f"{tmp_root}/restart-{uuid.uuid4().hex[:8]}"
    raw = meter_day(spark, SF001)
    first = raw.where(F.col("MP_ID") % 2 == 0)
    second = raw.where(F.col("MP_ID") % 2 == 1)
    write_table(first, f"{run}/src/batch1", "csv")
    dst = f"{run}/landed"  # the checkpoint lies beside the result
    ingest_stream(spark, f"{run}/src/*", dst).awaitTermination(120)
    n1 = spark.read.parquet(dst).count()
    assert n1 == first.count()
    # Restart with nothing new: no file is read twice.
    ingest_stream(spark, f"{run}/src/*", dst).awaitTermination(120)
    assert spark.read.parquet(dst).count() == n1
    # A new upload lands: only it is added.
    write_table(second, f"{run}/src/batch2", "csv")
    ingest_stream(spark, f"{run}/src/*", dst).awaitTermination(120)
    landed = spark.read.schema(RAW_SCHEMA).parquet(dst)
    assert landed.count() == raw.count()
    assert landed.exceptAll(raw).count() == 0 and raw.exceptAll(landed).count() == 0
