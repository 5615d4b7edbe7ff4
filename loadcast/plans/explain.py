"""Physical plans of the flows, for review: ``python -m loadcast.plans.explain
[sf_dir] > PLANS.md`` prints the operator tree of each step plus the scan
facts (pushed filters, read schema width) from ``explain("formatted")``."""

from __future__ import annotations

import contextlib
import io
import re
import sys
import tempfile

from pyspark.sql import DataFrame


def formatted(df: DataFrame) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def summary(df: DataFrame, width: int = 160) -> str:
    """Operator tree and per-scan facts, trimmed for reading."""
    text = formatted(df)
    tree = text.split("\n\n\n")[0].splitlines()
    facts = []
    for block in text.split("\n\n")[1:]:
        head = block.strip().splitlines()[0] if block.strip() else ""
        if "Scan parquet" in head or "Scan ExistingRDD" in head:
            for line in block.splitlines():
                if line.startswith("PushedFilters"):
                    facts.append(f"{head.strip()}: {line[:width]}")
                if line.startswith("ReadSchema"):
                    n = len(re.findall(r"[A-Za-z_0-9]+:", line)) - 1
                    facts.append(f"{head.strip()}: ReadSchema with {n} columns")
    exchanges = sum("Exchange" in ln and "Broadcast" not in ln for ln in tree)
    lines = [*(ln[:width] for ln in tree), "",
             f"shuffle exchanges: {exchanges}", *facts]
    return "\n".join(lines)


def main(sf_dir: str = "/root/testdata/sf0.1") -> None:
    from ..operators.clean import area_means, complete_rows
    from ..operators.paging import build_page_index, page_count, preview_index, read_page
    from ..operators.score import predict_hours, wide_result
    from ..operators.split import hash_split
    from ..operators.train import fit_hours
    from ..schema import FEATURES, LABELS, RESULT_CONTEXT
    from ..session import local_session
    from ..sources.files import write_table
    from ..sources.meter_day import meter_day
    from .pipeline import clean_table

    spark = local_session(8)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="loadcast-plans-"))
    root = tempfile.mkdtemp(prefix="loadcast-plans-out-")
    md = meter_day(spark, sf_dir)
    write_table(md, f"{root}/raw")
    raw = spark.read.parquet(f"{root}/raw")
    cleaned_df = clean_table(raw)
    write_table(cleaned_df, f"{root}/cleaned")
    cleaned = spark.read.parquet(f"{root}/cleaned")
    train, test = hash_split(complete_rows(cleaned))
    models = fit_hours(train, "ridge", LABELS[:2])
    index = build_page_index(cleaned, f"{root}/index")
    steps = {
        "meter_day (events → raw meter-day table)": md,
        "area means (raw → one row per area)": area_means(raw),
        "clean (raw → drop, fill from broadcast means, recode)": cleaned_df,
        "training input (cleaned → complete rows → train split)":
            train.select(*FEATURES, *LABELS),
        "scoring (test rows → predictions, relative errors)":
            wide_result(predict_hours(test, models, 4, keep=list(RESULT_CONTEXT)),
                        list(models)),
        "page 3 (of a stored index)": read_page(spark, index, 3),
        "preview (of a stored index)": preview_index(spark, index),
        "page count": page_count(cleaned),
    }
    print(f"# Physical plans ({sf_dir}, local[8], AQE on; initial plans)\n")
    for name, df in steps.items():
        print(f"## {name}\n\n```\n{summary(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main(*sys.argv[1:])
