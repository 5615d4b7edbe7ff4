"""End-to-end flows: clean, train, predict — each one Spark plan per step,
with I/O only at the ends.

* ``clean_table``   raw → drop, stage, impute, recode (``STAT_CYCLE`` carried as id)
* ``train_models``  cleaned → complete rows → train split → 24 fits → save
* ``predict``       cleaned → complete rows → test split → 24 predictions →
                    wide result written once, RMSE of every hour observed
                    during that same write (no second pass over the rows)
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from ..operators.clean import clean, complete_rows, drop_columns
from ..operators.joins import materialize
from ..operators.score import error_sums, hour_of, predict_hours, wide_result
from ..operators.modelsets import has_model_set, load_model_set, save_model_set
from ..operators.split import exact_split, hash_split, random_split
from ..operators.train import FIT_PARALLELISM, fit_hours, load_models
from ..schema import FEATURES, KEY, LABELS, RESULT_CONTEXT
from ..sources.files import publish, read_clean_csv, read_raw_csv, write_table

ID_CARRY = ("STAT_CYCLE",)


def clean_table(raw: DataFrame, carry=ID_CARRY) -> DataFrame:
    """``clean`` over a staged table: the means, the fill, and each side of a split
    read the needed columns back from the shared folder, so whatever ``raw`` costs
    (a parse, an aggregate and its windows) is paid once, not once a pass."""
    return clean(materialize(drop_columns(raw, carry=carry)), carry=carry)


def makedata(spark: SparkSession, src: str, dst: str, fmt: str = "parquet",
             carry=ID_CARRY) -> DataFrame:
    """The cleaning request end to end: raw CSV (declared schema) → clean →
    write under ``dst``, replacing what is there, as Parquet or CSV part files
    (one per task). Returns the written table."""
    cleaned = clean_table(read_raw_csv(spark, src), carry)
    if fmt == "csv":
        publish(cleaned, dst, "csv")
        return read_clean_csv(spark, dst, carry)
    write_table(cleaned, dst, fmt)
    return spark.read.format(fmt).load(dst)


def model_inputs(cleaned: DataFrame, split: str = "hash") -> tuple[DataFrame, DataFrame]:
    """(train, test) complete rows of the cleaned table. ``split="hash"`` splits
    on the row key (stable across jobs); ``"random"`` is ``randomSplit`` with
    weights 70/30 and seed 123, whose rows depend on the input partitioning;
    ``"exact"`` trains on exactly 70 % of the rows, the same on any layout. A
    table without the key has neither: ask for ``"random"`` and keep the
    sides, since another job would draw them anew."""
    if split not in ("hash", "exact", "random"):
        raise ValueError(f"unknown split {split!r}")
    rows = complete_rows(cleaned)
    if split == "random":
        train, test = random_split(rows)
        return train, test
    missing = [k for k in KEY if k not in rows.columns]
    if missing:
        raise ValueError(f"the hash split needs {missing}; pass split='random' for a table without the key")
    return hash_split(rows) if split == "hash" else exact_split(rows)


def train_models(cleaned: DataFrame, family: str = "ridge", labels=LABELS,
                 model_root: str | None = None, parallelism: int = FIT_PARALLELISM,
                 stage: str = "checkpoint", split: str = "hash", **params) -> dict:
    train, _ = model_inputs(cleaned, split)
    models = fit_hours(train, family, labels, parallelism=parallelism, stage=stage, **params)
    if model_root:
        save_model_set(models, model_root, family, params.get("features", FEATURES),
                       notes={"split": split, "params": {k: repr(v) for k, v in params.items()}})
    return models


@dataclass
class PredictReport:
    family: str
    rows: int
    rmse: dict
    seconds: float = 0.0  # scoring and writing, models loaded
    load_seconds: float = 0.0


def scored_test_rows(cleaned: DataFrame, models: dict, digits: int | None = 4,
                     split: str = "hash") -> DataFrame:
    _, test = model_inputs(cleaned, split)
    keep = [c for c in dict.fromkeys(KEY + RESULT_CONTEXT) if c in test.columns]
    return predict_hours(test, models, digits, keep=keep)


def predict(cleaned: DataFrame, models: dict | None = None, family: str = "ridge",
            model_root: str | None = None, out_path: str | None = None,
            digits: int | None = 4, id_cols=RESULT_CONTEXT, fmt: str = "parquet",
            solver: str = "mllib", split: str = "hash") -> PredictReport:
    """Score the test rows and write the wide result once. RMSE per hour comes
    from an ``Observation`` computed in the write job itself (exactly once per
    successful task: the observed aggregate runs in the result stage)."""
    start = time.perf_counter()
    labels = list(models) if models else list(LABELS)
    if models is None:
        models = (load_model_set(model_root, family, labels) if has_model_set(model_root, family)
                  else load_models(model_root, family, labels, solver=solver))
    loaded = time.perf_counter()
    scored = scored_test_rows(cleaned, models, digits, split)
    obs = Observation(f"rmse_{family}")
    observed = scored.observe(obs, *error_sums(labels))
    result = wide_result(observed, labels, id_cols)
    if out_path is None:
        result.write.format("noop").mode("overwrite").save()
    else:
        write_table(result, out_path, fmt)
    metrics = obs.get
    n = metrics["rows"]
    rmse = {label: ((metrics[f"sse_{label}"] or 0.0) / n) ** 0.5 if n else None for label in labels}
    ordered = dict(sorted(rmse.items(), key=lambda kv: hour_of(kv[0])))
    return PredictReport(family, n, ordered, round(time.perf_counter() - loaded, 3), round(loaded - start, 3))
