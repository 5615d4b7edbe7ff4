"""Published versions, histories, uploads, model sets, stored state, exact split."""

import os
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadcast.operators import split
from loadcast.operators.area_state import add_upload, impute_from_state, stored_means
from loadcast.operators.clean import area_means, drop_columns, impute_area_mean
from loadcast.operators.modelsets import (
    fit_with_journal,
    has_model_set,
    load_model_set,
    model_set_manifest,
    save_model_set,
)
from loadcast.operators.paging import build_page_index, preview_index, read_from, read_manifest, read_page
from loadcast.operators.score import predict_hours, rmse_report
from loadcast.operators.train import fit_hours
from loadcast.plans.pipeline import model_inputs, predict, train_models
from loadcast.schema import DAY_LAGS, KEY, LABELS
from loadcast.sources import commits
from loadcast.sources.files import publish, write_table
from loadcast.sources.history import append_once, read_history, read_ledger, write_by_day
from loadcast.sources.inspect import preview
from loadcast.sources.meter_day import meter_day
from loadcast.sources.published import current, publish_version, read_published
from loadcast.streaming.running import impute_uploads, running_rmse, score_batch, score_uploads
from loadcast.streaming.uploads import EXTRA, header_fault, ingest_uploads, read_landed, read_rejected

from .conftest import SF001


@pytest.fixture
def root(tmp_root):
    return f"{tmp_root}/{uuid.uuid4().hex}"


def broken(df):
    return df.withColumn("id", F.when(F.col("id") >= 3, F.raise_error(F.lit("broken")).cast("long")).otherwise(F.col("id")))


# --- records and versions ---------------------------------------------------------

def test_records_appear_once(spark, root):
    assert commits.latest(spark, root) is None and commits.record_names(spark, root) == []
    assert commits.put(spark, root, "a", {"x": 1}) and not commits.put(spark, root, "a", {"x": 2})
    assert commits.get(spark, root, "a") == {"x": 1} and commits.get(spark, root, "b") is None
    assert commits.put(spark, root, "b", {}) and commits.latest(spark, root) == ("b", {})
    assert sorted(n for n in os.listdir(root) if not n.startswith(".")) == ["a.json", "b.json"]
    for bad in ("", "../a", "a/b", ".a"):
        with pytest.raises(ValueError):
            commits.put(spark, root, bad, {})
    assert not commits.move(spark, f"{root}/a.json", f"{root}/b.json")


def test_a_failed_publish_leaves_the_version_before(spark, root):
    with pytest.raises(FileNotFoundError):
        read_published(spark, root)
    with pytest.raises(Exception, match="broken"):
        publish_version(broken(spark.range(5)), root)
    assert [n for n in os.listdir(root) if n[0].isdigit()] == []
    publish_version(spark.range(3), root)
    with pytest.raises(Exception, match="broken"):
        publish_version(broken(spark.range(5)), root)
    assert read_published(spark, root).count() == 3
    assert len([n for n in os.listdir(root) if n[0].isdigit()]) == 1
    publish_version(spark.range(7), root, "csv")
    assert read_published(spark, root).dtypes == [("id", "bigint")]
    assert read_published(spark, root).count() == 7


def test_a_reader_finishes_on_the_version_it_met(spark, root):
    publish_version(spark.range(3), root)
    before = read_published(spark, root)
    publish_version(spark.range(9), root)
    assert before.count() == 3 and read_published(spark, root).count() == 9
    publish_version(spark.range(4), root)
    assert len([n for n in os.listdir(root) if n[0].isdigit()]) == 2


def test_the_second_of_two_publishers_is_told(spark, root):
    from loadcast.sources import published

    publish_version(spark.range(3), root)

    def write(folder):
        publish_version(spark.range(5), root)  # another writer, in the meantime
        spark.range(8).write.parquet(folder)

    with pytest.raises(RuntimeError, match="another writer"):
        published.replace(spark, root, write)
    assert read_published(spark, root).count() == 5


def test_plain_publish_keeps_the_old_table_when_it_fails(spark, root):
    publish(spark.range(3), root, "parquet")
    with pytest.raises(Exception, match="broken"):
        publish(broken(spark.range(9)), root, "parquet")
    assert spark.read.parquet(root).count() == 3
    publish(spark.range(4), root, "parquet")
    assert spark.read.parquet(root).count() == 4
    assert [n for n in os.listdir(os.path.dirname(root)) if n.startswith(os.path.basename(root) + ".")] == []


# --- index ------------------------------------------------------------------------

def test_index_knows_its_chunks(spark, root):
    df = spark.range(397).select((F.col("id") * 31 % 397).alias("MP_ID"), F.lit("x").alias("v"))
    build_page_index(df, root, ["MP_ID"], 10)
    pages = [[r.MP_ID for r in read_page(spark, root, p, 20).collect()] for p in range(1, 22)]
    assert [x for p in pages for x in p] == list(range(397)) and pages[20] == []
    with pytest.raises(ValueError, match="10 rows a chunk"):
        read_page(spark, root, 1, 20, 33)
    files = read_page(spark, root, 4, 20).inputFiles()
    assert files and all("__chunk=6/" in f or "__chunk=7/" in f for f in files)
    shown = read_manifest(spark, root).orderBy("chunk").collect()
    assert [(r.chunk, r.rows, r.first_row, r.low.MP_ID, r.high.MP_ID) for r in shown][38:] == [
        (38, 10, 380, 380, 389), (39, 7, 390, 390, 396)]
    assert [r.MP_ID for r in read_from(spark, root, [55], 12).collect()] == list(range(55, 67))
    assert read_from(spark, root, [397], 5).collect() == []
    with pytest.raises(ValueError, match="ordered by"):
        read_from(spark, root, [1, 2, 3], 5)


def test_index_is_replaced_as_a_whole(spark, root):
    build_page_index(spark.range(30), root, ["id"], 10)
    with pytest.raises(Exception, match="broken"):
        build_page_index(broken(spark.range(50)), root, ["id"], 7)
    assert read_page(spark, root, 2, 20).count() == 10
    build_page_index(spark.range(50), root, ["id"], 7)
    assert [r.id for r in preview_index(spark, root, 9).collect()] == list(range(9))
    build_page_index(spark.range(0), root, ["id"], 7)
    assert read_page(spark, root, 1, 20).collect() == [] and read_from(spark, root, [0], 3).collect() == []


def test_seek_with_nulls_and_ties(spark, root):
    rows = [(None, k) for k in range(7)] + [(1, k) for k in range(20)] + [(3, k) for k in range(5)]
    df = spark.createDataFrame(rows, "g int, k int").repartition(4)
    build_page_index(df, root, ["g"], 6)
    assert [tuple(r) for r in read_from(spark, root, [1], 21).collect()] == [(1, k) for k in range(20)] + [(3, 0)]
    assert [tuple(r) for r in read_from(spark, root, [2], 50).collect()] == [(3, k) for k in range(5)]
    assert len(read_from(spark, root, [None], 50).collect()) == 32


def test_preview_merges_in_few_tasks(spark):
    df = spark.range(0, 5000, 1, 130).select(((F.col("id") * 7919) % 5000).alias("MP_ID"), F.lit(1).alias("__merger2"))
    assert [r.MP_ID for r in preview(df, 20).collect()] == list(range(20))
    assert preview(df.limit(0), 20).collect() == [] and preview(df.drop("MP_ID"), 5).count() == 5


# --- histories --------------------------------------------------------------------

def test_a_batch_counts_once(spark, root):
    with pytest.raises(FileNotFoundError):
        read_history(spark, root)
    assert read_ledger(spark, root).collect() == []
    assert append_once(spark.range(5), root, "b1") and not append_once(spark.range(5), root, "b1")
    with pytest.raises(Exception, match="broken"):
        append_once(broken(spark.range(9)), root, "b2")
    spark.range(50).write.parquet(f"{root}/__batch=b3~left")  # a try that was never committed
    assert read_history(spark, root).count() == 5
    assert append_once(spark.range(2), root, "b2", lambda: {"rows": 2})
    assert sorted((r.b, r.n) for r in read_history(spark, root, "b").groupBy("b").agg(F.count("*").alias("n")).collect()) == [("b1", 5), ("b2", 2)]
    assert read_history(spark, root).columns == ["id"]


def test_a_day_is_replaced_alone(spark, root):
    rows = spark.range(90).select("id", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 3).cast("int")).alias("STAT_CYCLE"))
    write_by_day(rows, root)
    write_by_day(rows.where("STAT_CYCLE = '2024-01-02'").limit(4), root)
    got = {str(r.STAT_CYCLE): r.n for r in spark.read.parquet(root).groupBy("STAT_CYCLE").agg(F.count("*").alias("n")).collect()}
    assert got == {"2024-01-01": 30, "2024-01-02": 4, "2024-01-03": 30}


# --- uploads ----------------------------------------------------------------------

SMALL = T.StructType([T.StructField("MP_ID", T.LongType()), T.StructField("DAY", T.DateType()), T.StructField("V", T.DoubleType())])


def put_file(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as out:
        out.write(text)


def test_one_stream_takes_every_upload(spark, root):
    src, landed, rejected = f"{root}/src", f"{root}/landed", f"{root}/rejected"
    commits.make_folder(spark, src)
    run = lambda: ingest_uploads(spark, src, landed, rejected, SMALL, max_files_per_trigger=3).awaitTermination(180)
    run()
    assert read_landed(spark, landed, SMALL).collect() == [] and read_rejected(spark, rejected).collect() == []
    put_file(src, "a.csv", "MP_ID,DAY,V\n1,2024-01-01,1.5\n2,2024-01-02,\n3,2024-01-03\n4,2024-01-04,1,9\n5,soon,2\n")
    put_file(src, "b.csv", "V,NOTE,MP_ID,DAY\n2.5,\"p, q\",6,2024-01-06\nx,,7,2024-01-07\n")
    put_file(src, "c.csv", "MP_ID,V\n8,1\n9,2\n")
    run()
    put_file(f"{src}/later", "d.csv", "MP_ID,DAY,V,v\n10,2024-01-01,1,1\n")
    put_file(src, "e.csv", "")
    put_file(src, "f.csv", "MP_ID,DAY,V\n")
    put_file(src, "g.csv", "MP_ID,DAY,V\n11,2024-01-11,4\n")
    run()
    run()
    good = {(r.MP_ID, str(r.DAY), r.V, tuple(r[EXTRA].items()) if r[EXTRA] else None) for r in read_landed(spark, landed, SMALL).collect()}
    assert good == {(1, "2024-01-01", 1.5, None), (2, "2024-01-02", None, None),
                    (6, "2024-01-06", 2.5, (("NOTE", "p, q"),)), (11, "2024-01-11", 4.0, None)}
    bad = sorted((os.path.basename(r.file), r.line, r.reason) for r in read_rejected(spark, rejected).collect())
    assert bad == [
        ("a.csv", "3,2024-01-03", "fields do not match the header"),
        ("a.csv", "4,2024-01-04,1,9", "fields do not match the header"),
        ("a.csv", "5,soon,2", "DAY: not a date"),
        ("b.csv", "x,,7,2024-01-07", "V: not a double"),
        ("c.csv", "8,1", "the header lacks DAY"), ("c.csv", "9,2", "the header lacks DAY"),
        ("d.csv", "10,2024-01-01,1,1", "the header repeats v")]


def test_a_batch_tried_again_lands_once(spark, root):
    import shutil

    src, landed, rejected = f"{root}/src", f"{root}/landed", f"{root}/rejected"
    put_file(src, "a.csv", "MP_ID,DAY,V\n1,2024-01-01,1.5\n,,\nx,2024-01-01,1\n")
    run = lambda: ingest_uploads(spark, src, landed, rejected, SMALL).awaitTermination(180)
    run()
    shutil.move(f"{landed}/_checkpoint/commits", f"{root}/commits")  # as if it had died before its commit
    run()
    assert read_landed(spark, landed, SMALL).count() == 2 and read_rejected(spark, rejected).count() == 1


def test_headers():
    assert header_fault("MP_ID,DAY,V", SMALL) == (["MP_ID", "DAY", "V"], None)
    assert header_fault('"V","DAY","a,b",MP_ID', SMALL) == (["V", "DAY", "a,b", "MP_ID"], None)
    assert header_fault("", SMALL)[1] == "the header lacks MP_ID, DAY, V"


# --- stored state -----------------------------------------------------------------

def test_state_gives_the_means_of_all_uploads(spark, root):
    rows = [(1, 1.0, None), (1, 3.0, None), (2, None, None), (None, 7.0, 1.0), (1, None, float("nan")), (3, 5.0, 2.0), (3, None, None)]
    df = spark.createDataFrame(rows, "AREA_NO int, LOAD0 double, LOAD1 double")
    parts = [df.where("AREA_NO = 1"), df.where("AREA_NO = 2 OR AREA_NO IS NULL"), df.where("AREA_NO = 3")]
    cols = ["LOAD0", "LOAD1"]
    for k, part in enumerate(parts):
        assert add_upload(part, root, f"u{k}", cols)
    assert not add_upload(parts[0], root, "u0", cols)
    key = lambda r: str(tuple(r))
    assert sorted(map(key, stored_means(spark, root, cols).collect())) == sorted(map(key, area_means(df, cols).collect()))
    assert sorted(map(key, impute_from_state(df, root, cols).collect())) == sorted(map(key, impute_area_mean(df, cols).collect()))


def test_streamed_fills_use_all_uploads_so_far(spark, root):
    rows = drop_columns(meter_day(spark, SF001)).cache()
    for k in (0, 1):
        write_table(rows.where(F.col("MP_ID") % 2 == k), f"{root}/src/side={k}")
        impute_uploads(spark, f"{root}/src/side=*", rows.schema, f"{root}/state", f"{root}/out").awaitTermination(180)
    filled = read_history(spark, f"{root}/out")
    assert filled.count() == rows.count() and read_ledger(spark, f"{root}/state").count() == 2
    last = impute_area_mean(rows, means=stored_means(spark, f"{root}/state")).where("MP_ID % 2 = 1")
    got = filled.where("MP_ID % 2 = 1")
    cols = ["MP_ID", "STAT_CYCLE", *[F.round(c, 9).alias(c) for c in DAY_LAGS]]
    cols = [c for c in cols if not isinstance(c, str) or c in got.columns]
    assert got.select(*cols).exceptAll(last.select(*cols)).count() == 0


def test_running_error_equals_the_batch_report(spark, root, cleaned01):
    train, test = model_inputs(cleaned01)
    labels = ["LOAD0", "LOAD7"]
    models = fit_hours(train, "ridge", labels, parallelism=2)
    for k in (0, 1):
        write_table(test.where(F.col("MP_ID") % 2 == k), f"{root}/src/side={k}")
        score_uploads(spark, f"{root}/src/side=*", test.schema, models, f"{root}/out").awaitTermination(180)
    want = {r.label: r.rmse for r in rmse_report(predict_hours(test, models, 4), labels).collect()}
    got = {r.label: r for r in running_rmse(spark, f"{root}/out").collect()}
    assert got.keys() == want.keys() and all(abs(got[k].rmse - want[k]) < 1e-9 and got[k].rows == test.count() for k in want)
    assert read_history(spark, f"{root}/out").count() == test.count()
    # A batch that is tried again, and one without a complete row, change nothing.
    assert score_batch(test, models, f"{root}/out", "again") and not score_batch(test, models, f"{root}/out", "again")
    assert score_batch(test.limit(0), models, f"{root}/out", "none")
    assert {r.label: r.rows for r in running_rmse(spark, f"{root}/out").collect()} == {k: 2 * test.count() for k in want}


# --- model sets -------------------------------------------------------------------

class NoDisk:
    def write(self):
        raise OSError("no space left")


def test_model_sets_are_replaced_as_a_whole(spark, root, cleaned01):
    train, test = model_inputs(cleaned01)
    labels = ["LOAD0", "LOAD1", "LOAD2"]
    models = fit_hours(train, "ridge", labels, parallelism=3, partitions=2)
    assert not has_model_set(root, "ridge")
    save_model_set(models, root, "ridge", notes={"split": "hash"})
    with pytest.raises(OSError):
        save_model_set({**{lab: models["LOAD0"] for lab in labels}, "LOAD2": NoDisk()}, root, "ridge")
    back = load_model_set(root, "ridge", labels)
    assert [back[lab].coefficients for lab in labels] == [models[lab].coefficients for lab in labels]
    record = model_set_manifest(root, "ridge")
    assert record["labels"] == labels and record["fit_partitions"] == 2 and record["notes"] == {"split": "hash"}
    with pytest.raises(FileExistsError):
        save_model_set(models, root, "ridge", overwrite=False)
    with pytest.raises(ValueError, match="LOAD9"):
        load_model_set(root, "ridge", ["LOAD9"])
    with pytest.raises(ValueError, match="other features"):
        load_model_set(root, "ridge", labels, ["DLOAD0"])
    assert len([n for n in os.listdir(os.path.dirname(current(spark, f"{root}/LineModelSet")[0])) if n[0].isdigit()]) == 1


@pytest.mark.parametrize("solver", ["mllib", "moments"])
def test_flows_use_the_set(spark, root, cleaned01, solver):
    if solver == "moments":
        from loadcast.operators.train import fit_hours as fit

        models = fit(model_inputs(cleaned01)[0], "ridge", solver="moments")
        save_model_set(models, root, "ridge")
    else:
        models = train_models(cleaned01, "ridge", model_root=root, parallelism=8, split="exact")
        assert model_set_manifest(root, "ridge")["notes"]["split"] == "exact"
    a = predict(cleaned01, models, "ridge")
    b = predict(cleaned01, family="ridge", model_root=root)
    assert a.rows == b.rows and all(abs(a.rmse[k] - b.rmse[k]) < 1e-9 for k in LABELS)


def test_a_journal_resumes_and_refuses_other_work(spark, root, cleaned01):
    train, _ = model_inputs(cleaned01)
    labels = ["LOAD0", "LOAD1", "LOAD2", "LOAD3"]
    seen = []

    def stop(label):
        seen.append(label)
        if len(seen) == 2:
            raise InterruptedError(label)

    with pytest.raises(InterruptedError):
        fit_with_journal(train, root, "forest", labels, parallelism=1, partitions=2, on_commit=stop, numTrees=3)
    rest = []
    models = fit_with_journal(train, root, "forest", labels, parallelism=2, partitions=2, on_commit=rest.append, numTrees=3)
    assert seen == labels[:2] and sorted(rest) == labels[2:]
    whole = fit_hours(train, "forest", labels, parallelism=2, partitions=2, numTrees=3)
    assert [m.toDebugString.split("\n", 1)[1] for m in models.values()] == [m.toDebugString.split("\n", 1)[1] for m in whole.values()]
    assert fit_with_journal(train, root, "forest", labels, partitions=2, on_commit=rest.append, numTrees=3) and len(rest) == 2
    for other, kw in ((train.limit(10), {}), (train, {"partitions": 3}), (train, {"numTrees": 4})):
        with pytest.raises(ValueError, match="begun with other"):
            fit_with_journal(other, root, "forest", labels, **{"partitions": 2, "numTrees": 3, **kw})


# --- exact split ------------------------------------------------------------------

def brute_split(rows, columns, key, share, seed=123):
    import hashlib

    def h(names, r):
        parts = ["-" if r[c] is None else f"={r[c]}" for c in names]
        return hashlib.md5("|".join([str(seed), *parts]).encode()).hexdigest()[:15]

    ordered = sorted(rows, key=lambda r: (h(key, r), h(columns, r)))
    k = int(share * len(rows) + 0.5)
    return sorted(map(str, ordered[:k])), sorted(map(str, ordered[k:]))


@pytest.mark.parametrize("share", [0, 0.1, 0.5, 0.7, 1])
@pytest.mark.parametrize("few", [10_000, 0])
def test_exact_split_equals_a_sort(spark, monkeypatch, share, few):
    monkeypatch.setattr(split, "FEW", few)
    rows = [(k, f"d{k % 7}", k * 3) for k in range(150)]
    rows += [(None, None, k) for k in range(60)] + [(500, "same", 1)] * 90
    df = spark.createDataFrame(rows, "MP_ID long, STAT_CYCLE string, v long")
    want = brute_split([r.asDict() for r in df.collect()], df.columns, KEY, share)
    for parts in (1, 6):
        train, test = split.exact_split(df.repartition(parts), share)
        assert (sorted(str(r.asDict()) for r in train.collect()), sorted(str(r.asDict()) for r in test.collect())) == want


def test_exact_split_of_nothing(spark):
    train, test = split.exact_split(spark.createDataFrame([], "MP_ID long, STAT_CYCLE date"))
    assert train.collect() == test.collect() == []
    with pytest.raises(ValueError):
        split.exact_split(spark.range(3), 1.5, key=["id"])
