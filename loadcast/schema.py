"""Column names and declared schemas of the meter-day tables.

Nothing here is inferred at read time: every read uses an explicit
``StructType`` so that no extra pass over the data is spent on inference and
``TRADE_NO`` keeps one type whatever codes a file happens to contain.
"""

from __future__ import annotations

from pyspark.sql import types as T

HOURS = tuple(range(24))

# --- Fixed values (they must equal the reference for the same results) ------
# Context features, in the order they enter the feature vector.
CONTEXT_FEATURES = (
    "AREA_NO",
    "HOLIDAY",
    "ELECTRO_TYPE",
    "TRADE_NO",
    "WINDSPEED",
    "LAPSERATE",
    "AIRPRESSURE",
    "HUMIDITY",
    "PRECIPITATIONRANINFALL",
)
# Identifier and context columns kept beside the predictions in a result.
RESULT_CONTEXT = ("MP_ID",) + CONTEXT_FEATURES
# Trade code recoded before the integer cast, and its replacement.
TRADE_CODE_FROM = "31B0"
TRADE_CODE_TO = "3000"
# Hyper-parameters of the three model families.
RIDGE_REG_PARAM = 0.15
RIDGE_MAX_ITER = 200
FOREST_NUM_TREES = 30
GBT_MAX_ITER = 20
# Seeds recorded in the saved tree models' metadata.
FOREST_SEED = 6349942244507929187
GBT_SEED = 5448321004627615351
# Split fractions and seed of the random split; rows per result page.
SPLIT_WEIGHTS = (0.7, 0.3)
SPLIT_SEED = 123
PAGE_SIZE = 20
# ---------------------------------------------------------------------------

# Hourly column families: label, 1-day, 7-day and 30-day lag.
LABELS = tuple(f"LOAD{h}" for h in HOURS)
DAY_LAGS = tuple(f"DLOAD{h}" for h in HOURS)
WEEK_LAGS = tuple(f"WLOAD{h}" for h in HOURS)
MONTH_LAGS = tuple(f"MLOAD{h}" for h in HOURS)

# 33 model inputs: context first, then the 1-day lags.
FEATURES = CONTEXT_FEATURES + DAY_LAGS
# Columns removed by cleaning (49).
REMOVED = ("STAT_CYCLE",) + MONTH_LAGS + WEEK_LAGS
# Columns whose nulls are filled with their area mean (48).
IMPUTED = DAY_LAGS + LABELS

KEY = ("MP_ID", "STAT_CYCLE")


def prediction_col(h: int) -> str:
    return f"TLOAD{h}"


def relative_error_col(h: int) -> str:
    return f"TLOAD{h}_RE"


_INT_COLS = ("AREA_NO", "HOLIDAY", "ELECTRO_TYPE")
_WEATHER = ("WINDSPEED", "LAPSERATE", "AIRPRESSURE", "HUMIDITY", "PRECIPITATIONRANINFALL")


def _hourly(names):
    return [T.StructField(c, T.DoubleType(), True) for c in names]


RAW_SCHEMA = T.StructType(
    [
        T.StructField("MP_ID", T.LongType(), True),
        T.StructField("STAT_CYCLE", T.DateType(), True),
        *[T.StructField(c, T.IntegerType(), True) for c in _INT_COLS],
        T.StructField("TRADE_NO", T.StringType(), True),
        *[T.StructField(c, T.DoubleType(), True) for c in _WEATHER],
        *_hourly(LABELS),
        *_hourly(DAY_LAGS),
        *_hourly(WEEK_LAGS),
        *_hourly(MONTH_LAGS),
    ]
)

RAW_COLUMNS = tuple(RAW_SCHEMA.fieldNames())


def clean_columns(raw_columns=RAW_COLUMNS, carry=()):
    """Column order of the cleaned table: ``AREA_NO`` first (join key of the
    imputation), then the remaining raw columns that cleaning keeps."""
    kept = [c for c in raw_columns if c not in REMOVED or c in carry]
    return ["AREA_NO"] + [c for c in kept if c != "AREA_NO"]


def clean_schema(carry=()) -> T.StructType:
    """Declared schema of the cleaned table (``TRADE_NO`` int, loads double)."""
    raw = {f.name: f for f in RAW_SCHEMA.fields}
    fields = []
    for c in clean_columns(carry=carry):
        f = raw[c]
        dtype = T.IntegerType() if c == "TRADE_NO" else f.dataType
        fields.append(T.StructField(c, dtype, True))
    return T.StructType(fields)
