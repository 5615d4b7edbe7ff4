"""loadcast — hourly load forecasting on Spark (DataFrame / MLlib).

The flows (``loadcast.plans.pipeline``) are the usual entry points; the
operators they compose are importable on their own.
"""

from .operators.clean import (
    area_means,
    clean,
    complete_rows,
    drop_columns,
    drop_sparse_columns,
    impute_area_mean,
    missing_profile,
    recode_trade,
)
from .operators.features import assemble
from .operators.paging import page, page_count
from .operators.score import predict_hours, rmse_report, wide_result
from .operators.split import hash_split, random_split
from .operators.train import fit_hours, load_models, save_models
from .plans.pipeline import clean_table, makedata, model_inputs, predict, train_models
from .sources.files import ingest, publish, read_clean_csv, read_raw_csv, write_table
from .sources.inspect import preview, schema_report
from .sources.meter_day import meter_day, meter_day_from_events

__all__ = [
    "area_means", "assemble", "clean", "clean_table", "complete_rows", "drop_columns",
    "drop_sparse_columns", "fit_hours", "hash_split", "impute_area_mean", "ingest",
    "load_models", "makedata", "meter_day", "meter_day_from_events", "missing_profile",
    "model_inputs", "page", "page_count", "predict", "predict_hours", "preview", "publish",
    "random_split", "read_clean_csv", "read_raw_csv", "recode_trade", "rmse_report",
    "save_models", "schema_report", "train_models", "wide_result", "write_table",
]
