"""

Every query derives the raw meter-day table from the ``events`` table of the
given scale-factor folder (each user is a metering point; see
``loadcast.sources.meter_day``) and runs one operator, or one flow, of the
library over all of it. ``oracle_sql`` states the same computation in DuckDB
SQL. Queries that fit tree models or compare saved models have no SQL form
and are checked by row count here and by invariants in ``tests/``.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from loadcast.operators.area_state import add_upload, impute_from_state, stored_means  # noqa: E402
from loadcast.operators.clean import (  # noqa: E402
    area_means,
    clean,
    complete_rows,
    drop_columns,
    drop_sparse_columns,
    impute_area_mean,
    missing_profile,
    recode_trade,
)
from loadcast.operators.features import features_array  # noqa: E402
from loadcast.operators.modelsets import (  # noqa: E402
    fit_with_journal,
    load_model_set,
    save_model_set,
)
from loadcast.operators.paging import (  # noqa: E402
    build_page_index,
    page,
    page_count,
    preview_index,
    read_from,
    read_manifest,
    read_page,
)
from loadcast.operators.score import predict_hours, rmse_report, wide_result  # noqa: E402
from loadcast.operators.split import (  # noqa: E402
    exact_split_label,
    hash_split,
    random_split,
    split_label,
)
from loadcast.operators.train import fit_hours, load_models, save_models  # noqa: E402
from loadcast.plans.pipeline import (  # noqa: E402
    clean_table,
    makedata,
    model_inputs,
    predict,
    train_models,
)
from loadcast.schema import (  # noqa: E402
    DAY_LAGS,
    FEATURES,
    IMPUTED,
    KEY,
    LABELS,
    RAW_SCHEMA,
    RESULT_CONTEXT,
)
from loadcast.session import work_dir  # noqa: E402
from loadcast.sources.commits import make_folder  # noqa: E402
from loadcast.sources.files import (  # noqa: E402
    append_table,
    ingest,
    read_raw_csv,
    write_table,
)
from loadcast.sources.history import append_once, read_history, write_by_day  # noqa: E402
from loadcast.sources.inspect import preview, schema_report  # noqa: E402
from loadcast.sources.meter_day import meter_day  # noqa: E402
from loadcast.sources.published import publish_version, read_published  # noqa: E402
from loadcast.streaming.incremental import ingest_stream  # noqa: E402
from loadcast.streaming.running import impute_uploads, running_rmse, score_uploads  # noqa: E402
from loadcast.streaming.uploads import ingest_uploads, read_landed, read_rejected  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
ROUND = 6
PARALLEL_FITS = 8


def _rounded(df: DataFrame, cols=IMPUTED, digits: int = ROUND) -> DataFrame:
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: F.round(F.col(c), digits) for c in present})


def _md(spark: SparkSession, sf_dir: str) -> DataFrame:
    return meter_day(spark, sf_dir)


def _cleaned_keyed(spark, sf_dir):
    return clean_table(_md(spark, sf_dir))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the cleaning flow (drop, area-mean fill, trade recode) on sf0.001."""
    return _rounded(clean(_md(spark, SMOKE_DIR)))


# --- queries --------------------------------------------------------------

def q_meter_day(spark, sf):
    return _md(spark, sf)


def q_csv_roundtrip(spark, sf):
    path = work_dir(spark, "csv_roundtrip")
    write_table(_md(spark, sf), path, "csv", mode="overwrite")
    return read_raw_csv(spark, path)


def q_ingest(spark, sf):
    # Raw upload (CSV) landed as Parquet with the declared schema.
    upload = work_dir(spark, "upload")
    write_table(_md(spark, sf), upload, "csv")
    return ingest(spark, upload, work_dir(spark, "landed"))


def q_stream_ingest(spark, sf):
    # The same landing as an available-now stream with a checkpoint.
    upload = work_dir(spark, "stream-upload")
    write_table(_md(spark, sf), upload, "csv")
    landed = work_dir(spark, "stream-landed")
    ingest_stream(spark, upload, landed).awaitTermination()
    return spark.read.schema(RAW_SCHEMA).parquet(landed)


def q_makedata(spark, sf):
    # The cleaning request end to end: raw CSV upload → clean → CSV part files.
    upload = work_dir(spark, "makedata-upload")
    write_table(_md(spark, sf), upload, "csv")
    return _rounded(makedata(spark, upload, work_dir(spark, "makedata-out"), fmt="csv"))


def q_schema_report(spark, sf):
    return schema_report(_md(spark, sf)).select("ordinal", "column_name", "data_type")


def q_schema_report_clean(spark, sf):
    # Schema of the cleaned table (the second schema the reference prints).
    return schema_report(clean(_md(spark, sf))).select("ordinal", "column_name", "data_type")


def q_preview(spark, sf):
    # The first rows of an indexed table: its first chunk is all that is read.
    path = build_page_index(_md(spark, sf), work_dir(spark, "preview"), rows_per_chunk=1000)
    return preview_index(spark, path, 20, ("STAT_CYCLE",) + RESULT_CONTEXT)


def q_preview_unindexed(spark, sf):
    return preview(_md(spark, sf), 20, ("STAT_CYCLE",) + RESULT_CONTEXT)


def q_drop_columns(spark, sf):
    return drop_columns(_md(spark, sf))


def q_missing_profile(spark, sf):
    return missing_profile(_md(spark, sf))


def q_drop_sparse_columns(spark, sf):
    return drop_sparse_columns(_md(spark, sf), max_missing=0.99)


def q_area_means(spark, sf):
    return _rounded(area_means(drop_columns(_md(spark, sf))))


def q_impute_area_mean(spark, sf):
    return _rounded(impute_area_mean(drop_columns(_md(spark, sf))))


def q_recode_trade(spark, sf):
    return recode_trade(_md(spark, sf)).select("MP_ID", "STAT_CYCLE", "TRADE_NO")


def q_clean(spark, sf):
    return _rounded(clean(_md(spark, sf)))


def q_complete_rows(spark, sf):
    return _rounded(complete_rows(clean(_md(spark, sf))))


def q_hash_split(spark, sf):
    return split_label(complete_rows(_cleaned_keyed(spark, sf)))


def q_random_split(spark, sf):
    train, test = random_split(complete_rows(_cleaned_keyed(spark, sf)))
    return (train.select(*KEY, F.lit("train").alias("SPLIT"))
            .unionByName(test.select(*KEY, F.lit("test").alias("SPLIT"))))


def q_assemble_features(spark, sf):
    rows = complete_rows(_cleaned_keyed(spark, sf))
    arr = features_array(rows)
    return arr.select(*KEY, F.transform("features", lambda x: F.round(x, ROUND)).alias("features"))


def _single_feature_models(spark, sf):
    train, test = model_inputs(_cleaned_keyed(spark, sf))
    feats = {label: [x] for label, x in zip(LABELS, DAY_LAGS)}
    return fit_hours(train, "ridge", LABELS, features=feats, parallelism=PARALLEL_FITS), test


def q_ridge_single_feature(spark, sf):
    models, _ = _single_feature_models(spark, sf)
    rows = [(label, int(label[4:]), float(m.coefficients[0]), float(m.intercept))
            for label, m in models.items()]
    out = spark.createDataFrame(rows, "label string, hour int, slope double, intercept double")
    return out.select("label", "hour", F.round("slope", ROUND).alias("slope"),
                      F.round("intercept", ROUND).alias("intercept"))


def _single_feature_scored(spark, sf):
    models, test = _single_feature_models(spark, sf)
    feats = {label: [x] for label, x in zip(LABELS, DAY_LAGS)}
    return predict_hours(test, models, 4, features=feats, keep=list(KEY))


def q_relative_error(spark, sf):
    scored = _single_feature_scored(spark, sf)
    return wide_result(scored, LABELS, KEY)


def q_rmse_by_hour(spark, sf):
    scored = _single_feature_scored(spark, sf)
    return rmse_report(scored, LABELS).select(
        "label", "hour", F.round("rmse", ROUND).alias("rmse"))


def _family_scored(spark, sf, family, digits=4, solver="mllib"):
    cleaned = _cleaned_keyed(spark, sf)
    train, test = model_inputs(cleaned)
    models = fit_hours(train, family, LABELS, parallelism=PARALLEL_FITS, solver=solver)
    return predict_hours(test, models, digits, keep=list(("STAT_CYCLE",) + RESULT_CONTEXT))


def q_ridge_train_score(spark, sf):
    return wide_result(_family_scored(spark, sf, "ridge"), LABELS, RESULT_CONTEXT)


def q_ridge_rmse_report(spark, sf):
    return rmse_report(_family_scored(spark, sf, "ridge"), LABELS, "ridge")


def q_ridge_cli_score(spark, sf):
    # Command-line variant: unrounded predictions, no MP_ID.
    return wide_result(_family_scored(spark, sf, "ridge", None), LABELS, RESULT_CONTEXT[1:])


def q_ridge_moments_train_score(spark, sf):
    # All 24 ridge labels from one set of moments (Correlation + Summarizer).
    return wide_result(_family_scored(spark, sf, "ridge", solver="moments"), LABELS,
                       RESULT_CONTEXT)


def q_ridge_predict_flow(spark, sf):
    # Train → save → (predict request) load → score → write → read the result.
    cleaned = _cleaned_keyed(spark, sf)
    root = work_dir(spark, "flow-models")
    train_models(cleaned, "ridge", LABELS, model_root=root)
    out = work_dir(spark, "flow-result")
    predict(cleaned, family="ridge", model_root=root, out_path=out)
    return spark.read.parquet(out)


def q_forest_train_score(spark, sf):
    return wide_result(_family_scored(spark, sf, "forest"), LABELS, RESULT_CONTEXT)


def q_gbt_train_score(spark, sf):
    return wide_result(_family_scored(spark, sf, "gbt"), LABELS, RESULT_CONTEXT)


def q_model_save_load(spark, sf):
    train, test = model_inputs(_cleaned_keyed(spark, sf))
    models = fit_hours(train, "ridge", LABELS, parallelism=PARALLEL_FITS)
    root = work_dir(spark, "models")
    save_models(models, root, "ridge")
    loaded = load_models(root, "ridge", LABELS)
    a = predict_hours(test, models, None, keep=list(KEY))
    b = predict_hours(test, loaded, None, keep=list(KEY))
    b = b.select(*KEY, *[F.col(f"TLOAD{h}").alias(f"B{h}") for h in range(24)])
    j = a.join(b, list(KEY))
    return j.agg(*[F.max(F.abs(F.col(f"TLOAD{h}") - F.col(f"B{h}"))).alias(f"LOAD{h}")
                   for h in range(24)]).select(
        F.inline(F.array(*[F.struct(F.lit(f"LOAD{h}").alias("label"),
                                    F.col(f"LOAD{h}").alias("max_abs_diff"))
                           for h in range(24)])))


def q_result_append(spark, sf):
    cleaned = _cleaned_keyed(spark, sf)
    train, test = hash_split(complete_rows(cleaned))
    path = work_dir(spark, "result_history")
    append_table(train.withColumn("SPLIT", F.lit("train")), path)
    append_table(test.withColumn("SPLIT", F.lit("test")), path)
    return _rounded(spark.read.parquet(path))


def q_page(spark, sf):
    return _rounded(page(_cleaned_keyed(spark, sf), 3, 20))


def q_page_indexed(spark, sf):
    # Page 101 of a stored index.
    path = build_page_index(_cleaned_keyed(spark, sf), work_dir(spark, "index"))
    return _rounded(read_page(spark, path, 101, 20))


def q_page_tied_key(spark, sf):
    # Ordered by a column with three values: the key breaks the ties.
    path = build_page_index(_cleaned_keyed(spark, sf), work_dir(spark, "tied"), ["AREA_NO"])
    return _rounded(read_page(spark, path, 7, 20))


def q_csv_reordered(spark, sf):
    # An upload with its columns in another order and one more than declared.
    path = work_dir(spark, "reordered")
    raw = _md(spark, sf)
    write_table(raw.select(F.lit("x").alias("REMARK"), *reversed(raw.columns)), path, "csv")
    return read_raw_csv(spark, path)


def q_stream_ingest_restart(spark, sf):
    # Two uploads with a restart of the stream between them.
    upload, landed = work_dir(spark, "restart-upload"), work_dir(spark, "restart-landed")
    raw = _md(spark, sf)
    for side in (0, 1):
        write_table(raw.where(F.col("MP_ID") % 2 == side), f"{upload}/batch{side}", "csv")
        ingest_stream(spark, f"{upload}/*", landed).awaitTermination()
    return spark.read.schema(RAW_SCHEMA).parquet(landed)


def q_trade_codes(spark, sf):
    # Every form of a trade code, one per event.
    events = spark.read.parquet(f"{sf}/events.parquet")
    forms = F.array(*[F.lit(c) for c in ("3100", "3100.0", " 31 ", "31B0", "31C0", "", "-7.9")])
    coded = events.select("event_id", F.get(forms, (F.col("event_id") % 7).cast("int")).alias("TRADE_NO"))
    return recode_trade(coded)


def q_random_split_keys(spark, sf):
    # Each key of the complete rows falls on exactly one side.
    train, test = random_split(complete_rows(_cleaned_keyed(spark, sf)))
    both = train.select(*KEY).unionByName(test.select(*KEY))
    return both.groupBy(*KEY).agg(F.count("*").alias("times"))


CELL_FEATURES = ["AREA_NO", "HOLIDAY", "ELECTRO_TYPE"]
CELL_LABELS = ["LOAD0", "LOAD8", "LOAD16"]


def _cells(spark, sf, family, **params):
    # Trees over three category columns separate every cell, so a prediction is
    # the training mean of its cell; fit, save, load, transform.
    train, test = model_inputs(_cleaned_keyed(spark, sf))
    models = fit_hours(train, family, CELL_LABELS, CELL_FEATURES, parallelism=PARALLEL_FITS, **params)
    root = work_dir(spark, f"{family}-cells")
    save_models(models, root, family)
    scored = predict_hours(test, load_models(root, family, CELL_LABELS), None, features=CELL_FEATURES, keep=list(KEY))
    return scored.select(*KEY, *[F.round(F.col(f"TLOAD{c[4:]}"), ROUND).alias(f"TLOAD{c[4:]}") for c in CELL_LABELS])


def q_forest_cells(spark, sf):
    return _cells(spark, sf, "forest", bootstrap=False, featureSubsetStrategy="all")


def q_gbt_cells(spark, sf):
    return _cells(spark, sf, "gbt")


def q_page_count(spark, sf):
    return page_count(_cleaned_keyed(spark, sf), 20)



# --- tables, models and results that survive failures ----------------------

class _Stopped(Exception):
    """Raised where a query has to be interrupted."""


def _fails(job) -> None:
    try:
        job()
    except Exception:
        return
    raise AssertionError("the job was to fail")


def q_publish_replace(spark, sf):
    # Publish A; a publish of B that fails halfway leaves A; publish C.
    rows = _md(spark, sf).select(*KEY, *LABELS)
    uri = work_dir(spark, "published")
    publish_version(rows.where(F.col("MP_ID") % 2 == 0), uri)
    broken = F.when(F.col("MP_ID") % 2 == 1, F.raise_error(F.lit("broken")).cast("double")).otherwise(F.col("LOAD0"))
    _fails(lambda: publish_version(rows.withColumn("LOAD0", broken), uri))
    # Read now: the version stays for one more publish.
    kept = read_published(spark, uri).withColumn("STEP", F.lit("after_failure"))
    publish_version(rows, uri, "csv")
    return kept.unionByName(read_published(spark, uri).withColumn("STEP", F.lit("after_replace")))


def q_page_manifest(spark, sf):
    # A page beyond the first chunk of an index with chunks of 150 rows.
    path = build_page_index(_cleaned_keyed(spark, sf), work_dir(spark, "chunked"), rows_per_chunk=150)
    return _rounded(read_page(spark, path, 40, 20))


def q_index_manifest(spark, sf):
    path = build_page_index(_cleaned_keyed(spark, sf), work_dir(spark, "manifest"), rows_per_chunk=150)
    return read_manifest(spark, path).select(
        "chunk", "rows", "first_row", F.col("low.MP_ID").alias("low_mp"), F.col("low.STAT_CYCLE").alias("low_cycle"),
        F.col("high.MP_ID").alias("high_mp"), F.col("high.STAT_CYCLE").alias("high_cycle"))


def q_page_seek(spark, sf):
    # The rows from meter 50 on, found in the manifest.
    path = build_page_index(_cleaned_keyed(spark, sf), work_dir(spark, "seek"), rows_per_chunk=150)
    return _rounded(read_from(spark, path, [50], 200))


def _mixed_uploads(spark, sf):
    # One stream over an empty folder, then over uploads of four kinds.
    upload, landed, rejected = (work_dir(spark, n) for n in ("mixed-upload", "mixed-landed", "mixed-rejected"))
    make_folder(spark, upload)
    ingest_uploads(spark, upload, landed, rejected).awaitTermination()
    raw = _md(spark, sf)
    kind = lambda k: raw.where(F.col("MP_ID") % 4 == k)
    write_table(kind(0), f"{upload}/plain", "csv")
    write_table(kind(1).select(F.lit("x, y").alias("REMARK"), *reversed(raw.columns)), f"{upload}/more", "csv")
    ingest_uploads(spark, upload, landed, rejected).awaitTermination()
    write_table(kind(2).drop("WINDSPEED"), f"{upload}/less", "csv")
    wind = F.when(F.dayofmonth("STAT_CYCLE") % 2 == 0, F.lit("fast")).otherwise(F.col("WINDSPEED").cast("string"))
    write_table(kind(3).withColumn("WINDSPEED", wind), f"{upload}/broken", "csv")
    ingest_uploads(spark, upload, landed, rejected).awaitTermination()
    return read_landed(spark, landed), read_rejected(spark, rejected)


def q_ingest_mixed_headers(spark, sf):
    landed, _ = _mixed_uploads(spark, sf)
    return landed.withColumn("REMARK", F.col("EXTRA_COLUMNS")["REMARK"]).drop("EXTRA_COLUMNS")


def q_ingest_mixed_rejects(spark, sf):
    _, rejected = _mixed_uploads(spark, sf)
    # A line ends as it began in the upload: with the meter first.
    return rejected.select("reason", F.split("line", ",")[0].cast("long").alias("MP_ID")).groupBy(
        "reason", "MP_ID").agg(F.count("*").alias("n_lines"))


def _coefficients(spark, models):
    rows = [(label, int(label[4:]), float(m.coefficients[0]), float(m.intercept)) for label, m in models.items()]
    out = spark.createDataFrame(rows, "label string, hour int, slope double, intercept double")
    return out.select("label", "hour", F.round("slope", ROUND).alias("slope"), F.round("intercept", ROUND).alias("intercept"))


_SINGLE = {label: [x] for label, x in zip(LABELS, DAY_LAGS)}


class _NoDisk:
    def write(self):
        raise _Stopped("no space left")


def q_model_set_replace(spark, sf):
    # A save that fails at label 12 leaves the 24 models before it.
    models, _ = _single_feature_models(spark, sf)
    root = work_dir(spark, "model-set")
    save_model_set(models, root, "ridge", _SINGLE)
    other = {label: models["LOAD0"] for label in LABELS}
    _fails(lambda: save_model_set({**other, "LOAD12": _NoDisk()}, root, "ridge", _SINGLE))
    return _coefficients(spark, load_model_set(root, "ridge", LABELS, _SINGLE))


def q_model_save_exists(spark, sf):
    # A save that must not replace fails where a set is, and changes nothing.
    models, _ = _single_feature_models(spark, sf)
    root = work_dir(spark, "model-keep")
    save_model_set(models, root, "ridge", _SINGLE, overwrite=False)
    other = {label: models["LOAD0"] for label in LABELS}
    _fails(lambda: save_model_set(other, root, "ridge", _SINGLE, overwrite=False))
    return _coefficients(spark, load_model_set(root, "ridge", LABELS, _SINGLE))


def q_fit_resume(spark, sf):
    # Interrupted after 10 labels; the second run fits the others.
    train, _ = model_inputs(_cleaned_keyed(spark, sf))
    journal, seen = work_dir(spark, "journal"), []

    def stop(label):
        seen.append(label)
        if len(seen) == 10:
            raise _Stopped(label)

    fit = lambda **kw: fit_with_journal(train, journal, "ridge", LABELS, _SINGLE, **kw)
    _fails(lambda: fit(parallelism=1, on_commit=stop))
    return _coefficients(spark, fit(parallelism=PARALLEL_FITS))


def q_append_once(spark, sf):
    # Each batch is appended twice and counts once.
    train, test = hash_split(complete_rows(_cleaned_keyed(spark, sf)))
    path = work_dir(spark, "history")
    for name, rows in (("train", train), ("test", test), ("train", train), ("test", test)):
        append_once(rows, path, name)
    return _rounded(read_history(spark, path, "SPLIT"))


def q_random_split_exact(spark, sf):
    return exact_split_label(complete_rows(_cleaned_keyed(spark, sf)))


def _area_state(spark, sf):
    # Three uploads one by one; the second arrives twice.
    rows = drop_columns(_md(spark, sf))
    state = work_dir(spark, "area-state")
    for k in (0, 1, 1, 2):
        add_upload(rows.where(F.col("MP_ID") % 7 % 3 == k), state, f"upload-{k}")
    return rows, state


def q_area_means_state(spark, sf):
    _, state = _area_state(spark, sf)
    return _rounded(stored_means(spark, state))


def q_impute_from_state(spark, sf):
    rows, state = _area_state(spark, sf)
    return _rounded(impute_from_state(rows, state))


def q_stream_area_means(spark, sf):
    # The state as a stream keeps it, over two uploads and a restart.
    rows = drop_columns(_md(spark, sf))
    upload, state, filled = (work_dir(spark, n) for n in ("fill-upload", "fill-state", "filled"))
    for side in (0, 1):
        write_table(rows.where(F.col("MP_ID") % 2 == side), f"{upload}/side={side}")
        impute_uploads(spark, f"{upload}/side=*", rows.schema, state, filled).awaitTermination()
    return _rounded(stored_means(spark, state))


def q_running_rmse(spark, sf):
    # Scored in two uploads with a restart between; errors from the ledger.
    models, test = _single_feature_models(spark, sf)
    upload, scored = work_dir(spark, "score-upload"), work_dir(spark, "scored")
    for side in (0, 1):
        write_table(test.where(F.col("MP_ID") % 2 == side), f"{upload}/side={side}")
        score_uploads(spark, f"{upload}/side=*", test.schema, models, scored, features=_SINGLE, id_cols=KEY).awaitTermination()
    return running_rmse(spark, scored).withColumn("rmse", F.round("rmse", ROUND))


def q_rescore_day(spark, sf):
    # A day scored again, with one digit, replaces its own rows only.
    models, test = _single_feature_models(spark, sf)
    path = work_dir(spark, "by-day")
    for rows, digits in ((test, 4), (test.where(F.dayofmonth("STAT_CYCLE") == 15), 1)):
        write_by_day(wide_result(predict_hours(rows, models, digits, features=_SINGLE, keep=list(KEY)), LABELS, KEY), path)
    return spark.read.parquet(path)


def q_relative_error_unrounded(spark, sf):
    # The command-line variant: predictions are not rounded (here for comparison).
    models, test = _single_feature_models(spark, sf)
    wide = wide_result(predict_hours(test, models, None, features=_SINGLE, keep=list(KEY)), LABELS, KEY)
    return wide.select(*KEY, *[F.round(c, ROUND).alias(c) for c in wide.columns if c not in KEY])


_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "meter_day": q_meter_day,
    "csv_roundtrip": q_csv_roundtrip,
    "ingest": q_ingest,
    "stream_ingest": q_stream_ingest,
    "makedata": q_makedata,
    "schema_report": q_schema_report,
    "schema_report_clean": q_schema_report_clean,
    "preview": q_preview,
    "drop_columns": q_drop_columns,
    "missing_profile": q_missing_profile,
    "drop_sparse_columns": q_drop_sparse_columns,
    "area_means": q_area_means,
    "impute_area_mean": q_impute_area_mean,
    "recode_trade": q_recode_trade,
    "clean": q_clean,
    "complete_rows": q_complete_rows,
    "hash_split": q_hash_split,
    "random_split": q_random_split,
    "assemble_features": q_assemble_features,
    "ridge_single_feature": q_ridge_single_feature,
    "relative_error": q_relative_error,
    "rmse_by_hour": q_rmse_by_hour,
    "ridge_train_score": q_ridge_train_score,
    "ridge_rmse_report": q_ridge_rmse_report,
    "ridge_cli_score": q_ridge_cli_score,
    "ridge_moments_train_score": q_ridge_moments_train_score,
    "ridge_predict_flow": q_ridge_predict_flow,
    "forest_train_score": q_forest_train_score,
    "gbt_train_score": q_gbt_train_score,
    "model_save_load": q_model_save_load,
    "result_append": q_result_append,
    "page": q_page,
    "page_indexed": q_page_indexed,
    "page_tied_key": q_page_tied_key,
    "csv_reordered": q_csv_reordered,
    "stream_ingest_restart": q_stream_ingest_restart,
    "trade_codes": q_trade_codes,
    "random_split_keys": q_random_split_keys,
    "forest_cells": q_forest_cells,
    "gbt_cells": q_gbt_cells,
    "page_count": q_page_count,
    "preview_unindexed": q_preview_unindexed,
    "publish_replace": q_publish_replace,
    "page_manifest": q_page_manifest,
    "index_manifest": q_index_manifest,
    "page_seek": q_page_seek,
    "ingest_mixed_headers": q_ingest_mixed_headers,
    "ingest_mixed_rejects": q_ingest_mixed_rejects,
    "model_set_replace": q_model_set_replace,
    "model_save_exists": q_model_save_exists,
    "fit_resume": q_fit_resume,
    "append_once": q_append_once,
    "random_split_exact": q_random_split_exact,
    "area_means_state": q_area_means_state,
    "impute_from_state": q_impute_from_state,
    "stream_area_means": q_stream_area_means,
    "running_rmse": q_running_rmse,
    "rescore_day": q_rescore_day,
    "relative_error_unrounded": q_relative_error_unrounded,
}


# The training-text operators; absent when the subpackage is not installed.
try:
    import corpus_pipeline
    from loadcast.llm.oracles import ORACLES as _LLM_ORACLES
    from loadcast.llm.queries import QUERIES as _LLM_QUERIES
except ImportError:
    _LLM_QUERIES, _LLM_ORACLES = {}, {}
else:
    _LLM_QUERIES = {**_LLM_QUERIES, "pipeline": corpus_pipeline.run}
    if corpus_pipeline.ORACLE_SQL:
        _LLM_ORACLES = {**_LLM_ORACLES, "pipeline": corpus_pipeline.ORACLE_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_QUERIES, **_LLM_QUERIES}


def oracle_sql() -> dict[str, str]:
    from oracles import oracle_queries
    return {**oracle_queries(), **_LLM_ORACLES}


__all__ = ["entry", "queries", "oracle_sql", "RAW_SCHEMA", "FEATURES"]
