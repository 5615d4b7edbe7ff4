"""Model sets: all labels of a family as one version, and fits that resume.

``save_model_set`` writes every model to a new folder and commits them together,
with a manifest of what they were fitted on. A save that fails at any label leaves
the set before it as it was, and no reader meets models of two sets.
``load_model_set`` refuses a set that lacks a label or was fitted on other features.

``fit_with_journal`` commits each model as soon as it is fitted. Started again after
an interruption it fits only the labels that are missing, and refuses to go on with
other rows, features or parameters than those it began with.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import FEATURES, LABELS
from ..sources import commits
from ..sources.published import current, is_published, replace
from .ridge import LinearFit, load_fits, save_fits
from .train import FAMILIES, FIT_PARALLELISM, fit_hours

MOMENTS = "moments.parquet"


def set_path(root: str, family: str) -> str:
    return f"{root.rstrip('/')}/{FAMILIES[family][3]}ModelSet"


def _features_of(features, labels) -> dict[str, list[str]]:
    return {lab: list(features[lab] if isinstance(features, dict) else features) for lab in labels}


def save_model_set(models: dict, root: str, family: str, features=FEATURES, overwrite: bool = True,
                   notes: dict | None = None, parallelism: int = 8) -> int:
    """Commit ``models`` ({label: model}) as the family's set; its version. With
    ``overwrite=False`` an existing set makes the save fail. ``notes`` (split, seed,
    ...) are kept in the manifest."""
    spark = SparkSession.getActiveSession()
    path = set_path(root, family)
    if not overwrite and is_published(spark, path):
        raise FileExistsError(f"{path} holds a model set")
    fits = {lab: m for lab, m in models.items() if isinstance(m, LinearFit)}

    def write(folder: str) -> dict:
        if fits:
            save_fits(fits, spark, f"{folder}/{MOMENTS}")
        rest = [lab for lab in models if lab not in fits]
        save = inheritable_thread_target(spark)(lambda lab: models[lab].write().save(f"{folder}/{lab}.model"))
        with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(rest) or 1))) as pool:
            list(pool.map(save, rest))
        dealt = {m.fit_partitions for m in models.values() if hasattr(m, "fit_partitions")}
        return {"family": family, "labels": list(models), "features": _features_of(features, models),
                "moments": sorted(fits), "fit_partitions": max(dealt, default=None), "notes": notes or {}}

    return replace(spark, path, write)


def model_set_manifest(root: str, family: str) -> dict:
    return current(SparkSession.getActiveSession(), set_path(root, family))[1]


def has_model_set(root: str, family: str) -> bool:
    return is_published(SparkSession.getActiveSession(), set_path(root, family))


def load_model_set(root: str, family: str, labels=LABELS, features=FEATURES, parallelism: int = 8) -> dict:
    """{label: model} of the committed set."""
    spark = SparkSession.getActiveSession()
    folder, record = current(spark, set_path(root, family))
    missing = [lab for lab in labels if lab not in record["labels"]]
    if missing:
        raise ValueError(f"the {family} set has no model of {missing}")
    wanted = _features_of(features, labels)
    other = [lab for lab in labels if record["features"][lab] != wanted[lab]]
    if other:
        raise ValueError(f"the {family} set was fitted on other features for {other}")
    return _load(spark, family, {lab: f"{folder}/{lab}.model" for lab in labels}, record["moments"], f"{folder}/{MOMENTS}", parallelism)


def _load(spark, family, paths: dict[str, str], moments=(), moments_file="", parallelism: int = 8) -> dict:
    fits = load_fits(spark, moments_file) if moments else {}
    rest = [lab for lab in paths if lab not in fits]
    read = inheritable_thread_target(spark)(lambda lab: FAMILIES[family][1].load(paths[lab]))
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(rest) or 1))) as pool:
        found = {**fits, **dict(zip(rest, pool.map(read, rest)))}
    return {lab: found[lab] for lab in paths}


def fingerprint(rows: DataFrame) -> list:
    """Number of rows and an order-free digest of them."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(rows.columns)])
    got = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(h.cast("decimal(38,0)")).alias("s"), F.bit_xor(h).alias("x")).first()
    return [got.n, str(got.s), got.x]


def fit_with_journal(train: DataFrame, journal: str, family: str = "ridge", labels=LABELS, features=FEATURES,
                     parallelism: int = FIT_PARALLELISM, partitions: int | None = None, on_commit=None, **params) -> dict:
    """``fit_hours``, each model committed under ``journal`` when it is fitted.
    ``on_commit(label)`` is called after each commit."""
    spark = train.sparkSession
    labels = list(labels)
    dealt = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    needed = _features_of(features, labels)
    columns = sorted({c for lab in labels for c in [lab, *needed[lab]]})
    plan = {"family": family, "labels": labels, "features": needed, "params": {k: repr(v) for k, v in sorted(params.items())},
            "partitions": dealt, "rows": fingerprint(train.select(*columns))}
    records = f"{journal.rstrip('/')}/_journal"
    if not commits.put(spark, records, "plan", plan):
        began = commits.get(spark, records, "plan")
        other = [k for k in plan if began.get(k) != plan[k]]
        if other:
            raise ValueError(f"{journal} was begun with other {other}")
    done = {lab: r["folder"] for lab in labels if (r := commits.get(spark, records, f"fit-{lab}"))}

    def commit(label: str, model) -> None:
        folder = f"{label}-{uuid.uuid4().hex[:12]}.model"
        model.write().save(f"{journal.rstrip('/')}/{folder}")
        if commits.put(spark, records, f"fit-{label}", {"folder": folder}):
            done[label] = folder
        else:  # another run fitted it first, to the same model
            commits.delete(spark, f"{journal.rstrip('/')}/{folder}")
            done[label] = commits.get(spark, records, f"fit-{label}")["folder"]
        if on_commit:
            on_commit(label)

    missing = [lab for lab in labels if lab not in done]
    if missing:
        wanted = {lab: needed[lab] for lab in missing} if isinstance(features, dict) else features
        fit_hours(train, family, missing, wanted, parallelism=parallelism, partitions=dealt, on_fit=commit, **params)
    models = _load(spark, family, {lab: f"{journal.rstrip('/')}/{done[lab]}" for lab in labels})
    for model in models.values():
        model.fit_partitions = dealt
    return models
