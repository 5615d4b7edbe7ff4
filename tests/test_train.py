"""Training and scoring: ridge against a NumPy closed form, trees by
invariants, parameters against the saved-model metadata, save → load."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadcast.operators import train as training
from loadcast.operators.score import predict_hours, rmse_report, wide_result
from loadcast.operators.clean import clean
from loadcast.operators.train import (
    BOOST_ROWS,
    boost_fits,
    boost_partitions,
    estimator,
    fit_hours,
    forest_fits,
    load_models,
    model_path,
    save_models,
    storage_bytes,
)
from loadcast.plans.pipeline import clean_table, model_inputs, predict
from loadcast.schema import FEATURES, LABELS, RESULT_CONTEXT


def ridge_closed_form(X, y, reg):
    """MLlib's normal-equation ridge: standardized features and label,
    regularization scaled by the label's population σ."""
    mx, sx = X.mean(0), X.std(0)
    my, sy = y.mean(), y.std()
    Z = (X - mx) / sx
    lam = reg / sy
    C = Z.T @ Z / len(y)
    c = Z.T @ ((y - my) / sy) / len(y)
    w_std = np.linalg.solve(C + lam * np.eye(X.shape[1]), c)
    w = w_std * sy / sx
    return w, my - w @ mx


@pytest.fixture(scope="module")
def splits(cleaned01):
    train, test = model_inputs(cleaned01)
    return train.cache(), test.cache()


def test_ridge_matches_closed_form(splits):
    train, _ = splits
    labels = ["LOAD0", "LOAD7", "LOAD18"]
    models = fit_hours(train, "ridge", labels, parallelism=3)
    pdf = train.select(*FEATURES, *labels).toPandas()
    X = pdf[list(FEATURES)].to_numpy(dtype=float)
    for label in labels:
        w, b = ridge_closed_form(X, pdf[label].to_numpy(dtype=float), 0.15)
        m = models[label]
        assert np.allclose(m.coefficients.toArray(), w, rtol=1e-8, atol=1e-10)
        assert m.intercept == pytest.approx(b, rel=1e-8)


def test_parameters_match_saved_metadata():
    lr = estimator("ridge", "LOAD0")
    assert (lr.getRegParam(), lr.getMaxIter(), lr.getElasticNetParam()) == (0.15, 200, 0.0)
    assert lr.getStandardization() and lr.getFitIntercept()
    rf = estimator("forest", "LOAD0")
    assert (rf.getNumTrees(), rf.getMaxDepth(), rf.getMaxBins(), rf.getImpurity()) == \
        (30, 5, 32, "variance")
    gbt = estimator("gbt", "LOAD0")
    assert (gbt.getMaxIter(), gbt.getStepSize(), gbt.getMaxDepth(), gbt.getLossType()) == \
        (20, 0.1, 5, "squared")


def test_tree_invariants_and_save_load(splits, tmp_root):
    train, test = splits
    labels = ["LOAD3", "LOAD12"]
    forest = fit_hours(train, "forest", labels, parallelism=2)
    gbt = fit_hours(train, "gbt", labels, parallelism=2)
    for label in labels:
        assert forest[label].getNumTrees == 30
        assert len(gbt[label].trees) == 20
        assert forest[label].numFeatures == 33
    scored = predict_hours(test, forest, None)
    stats = train.agg(*[F.min(c).alias(f"lo_{c}") for c in labels],
                      *[F.max(c).alias(f"hi_{c}") for c in labels]).first()
    for label in labels:
        h = label[4:]
        bad = scored.where((F.col(f"TLOAD{h}") < stats[f"lo_{label}"] - 1e-9)
                           | (F.col(f"TLOAD{h}") > stats[f"hi_{label}"] + 1e-9))
        assert bad.count() == 0
    # Each family beats the constant-mean predictor on the training rows.
    for models in (forest, gbt):
        fit = rmse_report(predict_hours(train, models, None), labels).collect()
        for r in fit:
            std = train.agg(F.stddev_pop(r.label)).first()[0]
            assert r.rmse < std
    # save → load → same predictions; overwrite=False refuses an existing model.
    save_models(gbt, tmp_root, "gbt")
    loaded = load_models(tmp_root, "gbt", labels)
    a = predict_hours(test, gbt, None, keep=["MP_ID", "STAT_CYCLE"])
    b = predict_hours(test, loaded, None, keep=["MP_ID", "STAT_CYCLE"])
    diff = a.join(b.select("MP_ID", "STAT_CYCLE", F.col("TLOAD3").alias("b3")),
                  ["MP_ID", "STAT_CYCLE"]).agg(F.max(F.abs(F.col("TLOAD3") - F.col("b3"))))
    assert diff.first()[0] == 0.0
    with pytest.raises(Exception):
        save_models(gbt, tmp_root, "gbt", overwrite=False)
    assert model_path(tmp_root, "gbt", "LOAD3").endswith("GBTModel/GBTModel_LOAD3.model")


def test_inline_ridge_equals_model_transform(splits):
    train, test = splits
    models = fit_hours(train, "ridge", LABELS[:6], parallelism=6)
    a = predict_hours(test, models, 4, keep=["MP_ID", "STAT_CYCLE"])
    b = predict_hours(test, models, 4, keep=["MP_ID", "STAT_CYCLE"], inline_linear=True)
    cols = [f"TLOAD{h}" for h in range(6)]
    j = a.alias("a").join(b.alias("b"), ["MP_ID", "STAT_CYCLE"])
    worst = j.agg(*[F.max(F.abs(F.col(f"a.{c}") - F.col(f"b.{c}"))) for c in cols]).first()
    assert max(worst) <= 1e-4  # equal after rounding, bar a last-digit tie


def test_predict_flow_rmse_equals_report(cleaned01, tmp_root):
    labels = list(LABELS)
    models_ = fit_hours(model_inputs(cleaned01)[0], "ridge", labels, parallelism=8)
    rep = predict(cleaned01, models_, "ridge", out_path=f"{tmp_root}/ridge_result")
    _, test = model_inputs(cleaned01)
    direct = {r.label: r.rmse for r in
              rmse_report(predict_hours(test, models_, 4), labels).collect()}
    assert rep.rows == test.count()
    for label in labels:
        assert rep.rmse[label] == pytest.approx(direct[label], rel=1e-12)
    written = cleaned01.sparkSession.read.parquet(f"{tmp_root}/ridge_result")
    assert written.columns == list(RESULT_CONTEXT) + [
        c for h in range(24) for c in (f"TLOAD{h}", f"TLOAD{h}_RE")]
    assert written.count() == rep.rows
    cli = wide_result(predict_hours(test, models_, None), labels, RESULT_CONTEXT[1:])
    assert "MP_ID" not in cli.columns and len(cli.columns) == 9 + 48


def test_moments_solver_matches_mllib(splits, tmp_root):
    train, test = splits
    labels = list(LABELS)
    ml = fit_hours(train, "ridge", labels, parallelism=8)
    mo = fit_hours(train, "ridge", labels, solver="moments")
    pdf = train.select(*FEATURES, *labels).toPandas()
    X = pdf[list(FEATURES)].to_numpy(dtype=float)
    for label in labels:
        w, b = ridge_closed_form(X, pdf[label].to_numpy(dtype=float), 0.15)
        assert np.allclose(mo[label].coefficients.toArray(), w, rtol=1e-6, atol=1e-9)
        assert mo[label].intercept == pytest.approx(b, rel=1e-8)
    a = predict_hours(test, ml, None, keep=["MP_ID", "STAT_CYCLE"])
    b = predict_hours(test, mo, None, keep=["MP_ID", "STAT_CYCLE"])
    j = a.alias("a").join(b.alias("b"), ["MP_ID", "STAT_CYCLE"])
    worst = j.agg(*[F.max(F.abs(F.col(f"a.TLOAD{h}") - F.col(f"b.TLOAD{h}")))
                    for h in range(24)]).first()
    assert max(worst) < 1e-6
    save_models(mo, f"{tmp_root}/moments", "ridge")
    back = load_models(f"{tmp_root}/moments", "ridge", labels, solver="moments")
    assert list(back) == labels
    assert np.array_equal(back["LOAD5"].coefficients.toArray(),
                          mo["LOAD5"].coefficients.toArray())


def test_checkpoint_staging_gives_same_models(splits):
    train, _ = splits
    labels = ["LOAD2", "LOAD9"]
    cached = fit_hours(train, "ridge", labels, stage="cache")
    frozen = fit_hours(train, "ridge", labels, stage="checkpoint")
    for label in labels:
        assert np.allclose(cached[label].coefficients.toArray(),
                           frozen[label].coefficients.toArray(), rtol=1e-10, atol=1e-12)
        assert cached[label].intercept == pytest.approx(frozen[label].intercept, rel=1e-10)


def test_input_of_the_flows_is_computed_once(spark):
    runs = spark.sparkContext.accumulator(0)

    def rows(_):
        runs.add(1)
        for k in range(40):
            hole = None if k % 9 == 0 else float(k)
            yield (k % 3, k, f"2024-01-{k % 28 + 1:02d}", *[hole if c in LABELS else k + 1 for c in (*FEATURES, *LABELS)])

    names = ["AREA_NO", "MP_ID", "STAT_CYCLE", *FEATURES, *LABELS]
    keep = list(dict.fromkeys(names))
    kind = {"STAT_CYCLE": "string", **{c: "double" for c in LABELS}}
    at = [names.index(c) for c in keep]
    schema = ", ".join(f"{c} {kind.get(c, 'bigint')}" for c in keep)
    raw = spark.createDataFrame(spark.sparkContext.range(0, 1, 1, 1).mapPartitions(rows).map(lambda r: tuple(r[i] for i in at)), schema)
    cleaned = clean_table(raw)
    train, test = model_inputs(cleaned)
    assert train.count() + test.count() == cleaned.count() == 40
    fit_hours(train, "ridge", LABELS[:2], parallelism=2)
    assert runs.value == 1  # means, fill, both sides and the fits
    want = clean(raw, carry=("STAT_CYCLE",))
    assert cleaned.schema == want.schema
    assert cleaned.exceptAll(want).count() == want.exceptAll(cleaned).count() == 0


def test_boosted_fits_take_partitions_by_rows(splits):
    train, _ = splits
    assert [boost_partitions(n, 200) for n in (0, 1, BOOST_ROWS, BOOST_ROWS + 1, 10 ** 9)] == [1, 1, 1, 2, 200]
    asked = fit_hours(train, "gbt", ["LOAD4"], partitions=3, maxIter=2)["LOAD4"]
    free = fit_hours(train, "gbt", ["LOAD4"], maxIter=2)["LOAD4"]
    assert asked.fit_partitions == 3 and free.fit_partitions == 1  # of 8 shuffle partitions
    assert fit_hours(train, "forest", ["LOAD4"], numTrees=2)["LOAD4"].fit_partitions == 8


def test_forest_fits_at_once_follow_memory(spark, monkeypatch):
    copy = 1_000_000 * (4 * (33 + 30) + 100)
    assert forest_fits(1_000_000, 33, 30, 100 * copy, 8) == 8
    assert forest_fits(1_000_000, 33, 30, 6 * copy, 8) == 3
    assert forest_fits(1_000_000, 33, 30, copy, 8) == 1
    assert forest_fits(0, 33, 30, 0, 8) == 1
    assert storage_bytes(spark) > 100_000_000

    # The same trees, whether the copies of all fits or of one fit into memory.
    rows = spark.range(400).selectExpr("id as MP_ID", "current_date() as STAT_CYCLE", "cast(id % 7 as double) as x",
                                       "cast(id % 5 as double) as LOAD0", "cast(id % 3 as double) as LOAD1", "cast(id as double) as LOAD2")
    labels = ["LOAD0", "LOAD1", "LOAD2"]
    pools, pool = [], training.ThreadPoolExecutor

    def counted(max_workers):
        pools.append(max_workers)
        return pool(max_workers=max_workers)

    monkeypatch.setattr(training, "ThreadPoolExecutor", counted)
    trees = []
    for storage in (10**9, 2 * 2 * 400 * (4 * (1 + 4) + 100), 1):
        monkeypatch.setattr(training, "storage_bytes", lambda spark, storage=storage: storage)
        models = fit_hours(rows, "forest", labels, ["x"], parallelism=3, numTrees=4)
        trees.append([[t.toDebugString.split("\n", 1)[1] for t in models[c].trees] for c in labels])
    assert pools == [3, 2]  # the third went one fit after the other, without a pool
    assert trees[0] == trees[1] == trees[2]


def test_boosted_fits_at_once_follow_memory(spark, monkeypatch):
    copy = 1_000_000 * (4 * 33 + 230)
    assert [boost_fits(1_000_000, 33, n * copy, 8) for n in (100, 6, 1)] == [8, 3, 1]
    assert boost_fits(0, 33, 0, 8) == 1

    # The same trees, whether the copies of all fits, of two or of one fit into memory.
    rows = spark.range(400).selectExpr("id as MP_ID", "current_date() as STAT_CYCLE", "cast(id % 7 as double) as x",
                                       "cast(id % 5 as double) as LOAD0", "cast(id % 3 as double) as LOAD1", "cast(id as double) as LOAD2")
    labels = ["LOAD0", "LOAD1", "LOAD2"]
    pools, pool = [], training.ThreadPoolExecutor

    def counted(max_workers):
        pools.append(max_workers)
        return pool(max_workers=max_workers)

    monkeypatch.setattr(training, "ThreadPoolExecutor", counted)
    trees = []
    for storage in (10**9, 2 * 2 * 400 * (4 * 1 + 230), 1):
        monkeypatch.setattr(training, "storage_bytes", lambda spark, storage=storage: storage)
        models = fit_hours(rows, "gbt", labels, ["x"], parallelism=3, maxIter=2)
        trees.append([[t.toDebugString.split("\n", 1)[1] for t in models[c].trees] for c in labels])
    assert pools == [3, 2]  # the third went one fit after the other, without a pool
    assert trees[0] == trees[1] == trees[2]
