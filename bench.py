"""Benchmark: the three flows of the reference on the meter-day table derived
from ``$BENCH_SF_DIR/events.parquet`` (default sf0.1), on
``local[$BENCH_CPUS]``. Prints one JSON line.

Timed steps:
  meter_day      derive the raw table from events and write it (Parquet)
  clean          read raw → drop, area-mean fill, recode → write cleaned table
  <f>_train      read cleaned → complete rows → train split → 24 fits → save
  <f>_predict    read cleaned → test split → load 24 models → wide result
                 written once, RMSE per hour observed in the same job
for f in ridge (MLlib, one fit per label), ridge_moments (all 24 labels from
one set of moments), forest, gbt. ``value`` is the sum of all steps.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

from loadcast.operators.train import save_models  # noqa: E402
from loadcast.plans.pipeline import clean_table, predict, train_models  # noqa: E402
from loadcast.schema import LABELS  # noqa: E402
from loadcast.session import local_session  # noqa: E402
from loadcast.sources.files import write_table  # noqa: E402
from loadcast.sources.meter_day import meter_day  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    families = os.environ.get("BENCH_FAMILIES", "ridge,ridge_moments,forest,gbt").split(",")
    spark = local_session(cpus)
    if not spark.sparkContext.getCheckpointDir() and not spark.conf.get(
            "spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loadcast-bench-"))
    root = tempfile.mkdtemp(prefix="loadcast-bench-out-")
    times: dict[str, float] = {}
    info: dict[str, object] = {}

    def step(name, fn):
        t = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t, 3)
        return out

    raw_path, clean_path = f"{root}/raw", f"{root}/cleaned"
    step("meter_day", lambda: write_table(meter_day(spark, sf_dir), raw_path))
    raw = spark.read.parquet(raw_path)
    info["raw_rows"] = raw.count()
    step("clean", lambda: write_table(clean_table(raw), clean_path))
    cleaned = spark.read.parquet(clean_path)
    parallel = int(os.environ.get("BENCH_PARALLEL_FITS", cpus))
    # A stated number, recorded with the models: 40,000 rows are one partition.
    partitions = int(os.environ.get("BENCH_FIT_PARTITIONS", "1"))
    for name in families:
        fam, solver = ("ridge", "moments") if name == "ridge_moments" else (name, "mllib")

        def train(fam=fam, solver=solver, name=name):
            models = train_models(cleaned, fam, LABELS, parallelism=parallel, solver=solver,
                                  partitions=partitions)
            save_models(models, f"{root}/models_{name}", fam)
            return models
        models = step(f"{name}_train", train)
        report = step(f"{name}_predict", lambda fam=fam, solver=solver, name=name: predict(
            cleaned, model_root=f"{root}/models_{name}", family=fam, solver=solver,
            out_path=f"{root}/{name}_result", models=None))
        fam = name
        info[f"{fam}_test_rows"] = report.rows
        info[f"{fam}_mean_rmse"] = round(sum(report.rmse.values()) / len(report.rmse), 4)
        info[f"{fam}_s_per_label_train"] = round(times[f"{fam}_train"] / len(LABELS), 3)
        del models
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "meter_day_clean_train_predict_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "info": info,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
