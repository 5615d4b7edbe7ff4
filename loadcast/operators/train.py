"""Multi-output training: one regressor per hourly label, three families.

The training table is assembled once and staged (written to the shared work
folder, or cached), dealt by its key to a stated number of partitions, then the 24 independent fits run from a
small thread pool so that several MLlib jobs share the cluster at once — the
same scheme as ``CrossValidator(parallelism=...)``. Every fit is MLlib's own
distributed estimator; nothing is solved on the driver.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml.regression import (
    GBTRegressionModel,
    GBTRegressor,
    LinearRegression,
    LinearRegressionModel,
    RandomForestRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame, SparkSession

from ..schema import (
    FEATURES,
    FOREST_NUM_TREES,
    FOREST_SEED,
    GBT_MAX_ITER,
    GBT_SEED,
    KEY,
    LABELS,
    RIDGE_MAX_ITER,
    RIDGE_REG_PARAM,
)
from ..session import checkpoint_dir
from .features import FEATURES_COL, assemble
from .joins import materialize
from .ridge import LinearFit, fit_ridge_moments, load_fits, save_fits

# Fits that run at once unless the caller says otherwise.
FIT_PARALLELISM = 4

# Rows of one partition of a boosted fit without a stated number of partitions.
BOOST_ROWS = 200_000

# Share of the executors' storage memory that the cached rows of tree fits may take.
COPIES_SHARE = 0.5

# Family → (estimator class, model class, default parameters, folder stem).
FAMILIES = {
    "ridge": (LinearRegression, LinearRegressionModel,
              {"regParam": RIDGE_REG_PARAM, "maxIter": RIDGE_MAX_ITER}, "Line"),
    "forest": (RandomForestRegressor, RandomForestRegressionModel,
               {"numTrees": FOREST_NUM_TREES, "seed": FOREST_SEED}, "Forest"),
    "gbt": (GBTRegressor, GBTRegressionModel,
            {"maxIter": GBT_MAX_ITER, "seed": GBT_SEED}, "GBT"),
}


def estimator(family: str, label: str, features_col: str = FEATURES_COL, **params):
    cls, _, defaults, _ = FAMILIES[family]
    return cls(featuresCol=features_col, labelCol=label, **{**defaults, **params})


def _inputs(features, labels) -> list[str]:
    if isinstance(features, dict):
        seen = []
        for lab in labels:
            seen += [f for f in features[lab] if f not in seen]
        return seen
    return list(features)


def boost_partitions(rows: int, most: int) -> int:
    """Partitions of a boosted fit: one per ``BOOST_ROWS`` rows, at most ``most``. A
    fit makes a hundred short passes one after the other (20 trees of five levels),
    and each pass costs two tasks a partition, so small partitions cost more than
    the rows in them."""
    return max(1, min(most, -(-rows // BOOST_ROWS)))


def storage_bytes(spark: SparkSession) -> int:
    """Memory for cached blocks of all executors. The status lists the driver as well,
    which caches nothing beside executors: the largest entry of several is left out."""
    sc = spark.sparkContext
    status = sc._jvm.scala.jdk.javaapi.CollectionConverters.asJava(sc._jsc.sc().getExecutorMemoryStatus())
    most = sorted(entry._1() for entry in status.values())
    return sum(most[:-1] if len(most) > 1 else most)


def forest_fits(rows: int, features: int, trees: int, storage: int, most: int) -> int:
    """Forest fits at once: as many as keep their binned rows within ``COPIES_SHARE`` of
    ``storage`` bytes, at least one and at most ``most``. A fit caches an int per feature
    and per tree and some 100 bytes of objects a row; what does not fit is written to
    disk and read back in each pass, which costs more than fewer fits at once."""
    return _at_once(rows * (4 * (features + trees) + 100), storage, most)


def boost_fits(rows: int, features: int, storage: int, most: int) -> int:
    """Boosted fits at once, by the same rule. A fit caches an int per feature and some
    230 bytes of objects a row: the point, its label and count, and its prediction and
    error of the last three iterations (356 bytes seen with 33 features)."""
    return _at_once(rows * (4 * features + 230), storage, most)


def _at_once(copy: int, storage: int, most: int) -> int:
    return max(1, min(most, int(storage * COPIES_SHARE) // max(1, copy)))


def training_table(train: DataFrame, labels=LABELS, features=FEATURES,
                   stage: str | None = "checkpoint", partitions: int | None = None) -> tuple[DataFrame, DataFrame | None]:
    """The inputs and the labels, staged once for all fits.

    Tree fits draw their samples partition by partition, so the table is dealt by
    its key to a stated number of ``partitions`` (``spark.sql.shuffle.partitions``
    without one) and sorted within each: the same rows, seed and number give the
    same models whatever the file layout or the other settings. With one shared
    feature list the vector is assembled before staging. ``stage="checkpoint"``
    writes the table to the shared folder; ``"cache"`` persists it in memory and
    on disk; ``None`` re-reads the input on every pass. Returns (table to fit on,
    persisted frame to release or None).
    """
    spark = train.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if n < 1:
        raise ValueError("partitions start at 1")
    inputs = list(dict.fromkeys([*_inputs(features, labels), *labels]))
    key = [c for c in KEY if c in train.columns]
    order = key + [c for c in inputs if c not in key] if len(key) < len(KEY) else key
    rows = train.select(*dict.fromkeys([*key, *inputs]))
    table = rows.repartition(n, *order).sortWithinPartitions(*order).select(*inputs)
    if not isinstance(features, dict):
        table = assemble(table, features).select(FEATURES_COL, *labels)
    checkpoint_dir(spark)  # boosting cuts its lineage there
    if stage == "cache":
        cached = table.persist(StorageLevel.MEMORY_AND_DISK)
        # Fill the cache in one job before concurrent fits read it; otherwise
        # every fit thread would compute the whole lineage at once.
        cached.count()
        return cached, cached
    if stage == "checkpoint":
        return materialize(table), None
    return table, None


def fit_hours(train: DataFrame, family: str = "ridge", labels=LABELS, features=FEATURES,
              parallelism: int = FIT_PARALLELISM, stage: str | None = "checkpoint",
              solver: str = "mllib", partitions: int | None = None, on_fit=None, **params) -> dict:
    """Fit one ``family`` model per label; returns {label: model} in label order.

    ``features`` is one list for all labels, or a mapping label → list (each
    label is then fitted on its own inputs).

    ``solver="moments"`` (ridge, shared features only) computes all labels from
    one set of moments (``ridge.fit_ridge_moments``): a fixed number of passes
    instead of one per label; the fits are ``LinearFit`` objects, applied as
    expressions by the scorer. The default fits MLlib ``LinearRegression``.

    ``parallelism`` fits run at once, whatever the size of the table; each tree
    fit holds its own binned copy of the rows, so tree fits are fewer where these
    copies would not fit into memory (``forest_fits``, ``boost_fits``). ``partitions``
    see ``training_table``; boosted fits without it take a number that follows from
    the rows (``boost_partitions``). It is kept on each model as ``fit_partitions``
    and saved with the models. ``on_fit(label, model)`` is called as each fit ends, in
    its thread.
    """
    labels = list(labels)
    if solver == "moments":
        if family != "ridge" or isinstance(features, dict):
            raise ValueError("the moments solver fits ridge models on shared features")
        unknown = sorted(set(params) - {"regParam"})
        if unknown:
            raise ValueError(f"the moments solver has no {unknown}")
        return fit_ridge_moments(train, labels, features,
                                 reg=params.get("regParam", RIDGE_REG_PARAM))
    dealt = partitions or int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if family == "gbt" and not partitions:
        key = [c for c in KEY if c in train.columns]
        train = train.select(*dict.fromkeys([*key, *_inputs(features, labels), *labels]))
        if stage == "checkpoint":  # counted and dealt from one run of the input
            train = materialize(train)
        partitions = dealt = boost_partitions(train.count(), dealt)
    table, cached = training_table(train, labels, features, stage, partitions)
    try:
        def fit(label):
            data = table
            if isinstance(features, dict):
                data = assemble(table.select(*features[label], label), features[label])
            model = estimator(family, label, **params).fit(data)
            if on_fit:
                on_fit(label, model)
            return label, model

        workers = max(1, min(int(parallelism), len(labels)))
        if family in ("forest", "gbt") and workers > 1:
            width = max(len(features[lab]) for lab in labels) if isinstance(features, dict) else len(features)
            storage = storage_bytes(table.sparkSession)
            if family == "forest":
                workers = forest_fits(table.count(), width, params.get("numTrees", FOREST_NUM_TREES), storage, workers)
            else:
                workers = boost_fits(table.count(), width, storage, workers)
        if workers == 1:
            fitted = dict(map(fit, labels))
        else:
            with ThreadPoolExecutor(max_workers=workers) as pool:
                fitted = dict(pool.map(inheritable_thread_target(fit), labels))
        for model in fitted.values():
            model.fit_partitions = dealt
        return {label: fitted[label] for label in labels}
    finally:
        if cached is not None:
            cached.unpersist()


def model_path(root: str, family: str, label: str) -> str:
    stem = FAMILIES[family][3]
    return f"{root.rstrip('/')}/{stem}Model/{stem}Model_{label}.model"


def moments_path(root: str) -> str:
    return f"{root.rstrip('/')}/LineModel/LineModel_moments.parquet"


def save_models(models: dict, root: str, family: str, overwrite: bool = True) -> list[str]:
    """Save every model under ``<root>/<Stem>Model/<Stem>Model_<label>.model``.
    With ``overwrite=False`` an existing model makes the save fail. Ridge fits
    of the moments solver are saved together as one small table."""
    fits = {k: m for k, m in models.items() if isinstance(m, LinearFit)}
    if fits:
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
        save_fits(fits, spark, moments_path(root), overwrite)
        return [moments_path(root)]
    paths = []
    dealt = {m.fit_partitions for m in models.values() if hasattr(m, "fit_partitions")}
    if dealt:
        from pyspark.sql import SparkSession
        stem = FAMILIES[family][3]
        notes = SparkSession.getActiveSession().createDataFrame([(max(dealt),)], "fit_partitions int").coalesce(1)
        notes.write.mode("overwrite" if overwrite else "error").parquet(f"{root.rstrip('/')}/{stem}Model/{stem}Model_fit.parquet")
    for label, model in models.items():
        path = model_path(root, family, label)
        if overwrite:
            model.write().overwrite().save(path)
        else:
            model.save(path)
        paths.append(path)
    return paths


def load_models(root: str, family: str, labels=LABELS, parallelism: int = 8,
                solver: str = "mllib") -> dict:
    """Load the saved model of every label (independent reads, run in a pool)."""
    model_cls = FAMILIES[family][1]
    labels = list(labels)
    if solver == "moments":
        from pyspark.sql import SparkSession
        fits = load_fits(SparkSession.getActiveSession(), moments_path(root))
        return {label: fits[label] for label in labels}

    def load(label):
        return model_cls.load(model_path(root, family, label))

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(labels)))) as pool:
        models = list(pool.map(inheritable_thread_target(load), labels))
    return dict(zip(labels, models))
