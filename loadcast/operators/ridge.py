"""Ridge regression for all 24 hourly labels from shared moments.

The 24 ridge models share the same 33 features, so a few passes give all
they need, whatever the number of labels: MLlib's ``Correlation`` (Pearson,
over the 57-wide vector of features and labels; mean-centred Gramian via
tree aggregation) and ``Summarizer`` (means, variances, count). The driver
receives a 57 × 57 matrix and three 57-vectors — fixed by the feature and
label counts, never by the data — and solves one 33 × 33 system per label.

Per label, the solution is the one MLlib's normal-equation solver gives for
``LinearRegression(regParam=λ, elasticNetParam=0, standardization=True)``:
with features and label standardized by their population deviations, solve
(R + λ/σ_y · I) w* = r, where R is the feature correlation matrix and r the
feature–label correlations, then w = w* · σ_y / σ_x and b = ȳ − w·x̄.
Constant features get a zero coefficient; a constant label gives w = 0 and
b = ȳ, as in MLlib.

Cost: three passes over the (cached) training vectors instead of one or more
per label.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import DenseVector
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import FEATURES, LABELS, RIDGE_REG_PARAM


@dataclass
class LinearFit:
    """A fitted linear model: ``intercept + coefficients · features``."""
    label: str
    coefficients: DenseVector
    intercept: float
    features: tuple = field(default=FEATURES)


def moments(train: DataFrame, features=FEATURES, labels=LABELS) -> dict:
    """Means, population variances and covariances of features and labels."""
    features, labels = tuple(features), tuple(labels)
    cols = [*features, *labels]
    vec = VectorAssembler(inputCols=cols, outputCol="__v").transform(
        train.select(*cols)).select("__v").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        stats = vec.select(Summarizer.metrics("mean", "variance", "count")
                           .summary(F.col("__v")).alias("s")).first().s
        corr = Correlation.corr(vec, "__v").first()[0].toArray()
    finally:
        vec.unpersist()
    n = int(stats["count"])
    var = stats.variance.toArray() * ((n - 1) / n if n > 1 else 0.0)
    sd = np.sqrt(np.clip(var, 0.0, None))
    k = len(features)
    corr = np.nan_to_num(corr)  # constant columns have no correlation
    cov = corr * np.outer(sd, sd)
    np.fill_diagonal(cov, var)
    mean = stats.mean.toArray()
    return {"n": n, "mx": mean[:k], "my": mean[k:], "cxx": cov[:k, :k],
            "cxy": cov[:k, k:], "vy": var[k:]}


def solve(mom: dict, h: int, reg: float) -> tuple[np.ndarray, float]:
    """Coefficients and intercept of label ``h`` from the moments."""
    mx, cxx = mom["mx"], mom["cxx"]
    my, vy, cxy = mom["my"][h], mom["vy"][h], mom["cxy"][:, h]
    w = np.zeros(len(mx))
    sy = float(np.sqrt(max(vy, 0.0)))
    if sy == 0.0:
        return w, float(my)
    sx = np.sqrt(np.clip(np.diag(cxx), 0.0, None))
    act = sx > 0
    s = sx[act]
    corr = cxx[np.ix_(act, act)] / np.outer(s, s)
    r = cxy[act] / (s * sy)
    w_std = np.linalg.solve(corr + (reg / sy) * np.eye(len(s)), r)
    w[act] = w_std * sy / s
    return w, float(my - w @ mx)


def fit_ridge_moments(train: DataFrame, labels=LABELS, features=FEATURES,
                       reg: float = RIDGE_REG_PARAM) -> dict[str, LinearFit]:
    labels, features = list(labels), tuple(features)
    mom = moments(train, features, labels)
    fits = {}
    for h, label in enumerate(labels):
        w, b = solve(mom, h, reg)
        fits[label] = LinearFit(label, DenseVector(w), b, features)
    return fits


def fits_frame(spark: SparkSession, fits: dict[str, LinearFit]) -> DataFrame:
    """The fits as a small table (label, intercept, coefficients, features)."""
    rows = [(f.label, float(f.intercept), [float(x) for x in f.coefficients.toArray()],
             list(f.features)) for f in fits.values()]
    return spark.createDataFrame(
        rows, "label string, intercept double, coefficients array<double>, features array<string>")


def save_fits(fits: dict[str, LinearFit], spark: SparkSession, path: str,
              overwrite: bool = True) -> None:
    # One row per label: a single small file.
    fits_frame(spark, fits).coalesce(1).write.mode(
        "overwrite" if overwrite else "errorifexists").parquet(path)


def load_fits(spark: SparkSession, path: str) -> dict[str, LinearFit]:
    rows = spark.read.parquet(path).collect()  # one row per label
    out = {r.label: LinearFit(r.label, DenseVector(r.coefficients), r.intercept,
                              tuple(r.features)) for r in rows}
    return {label: out[label] for label in sorted(out, key=lambda s: int(s[4:]))}
