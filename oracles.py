"""DuckDB SQL oracles for the registered queries (see ``__spark_entry__``).

Every oracle starts from the same derivation of the meter-day table from
``events`` (a left self-join for the lagged loads where the Spark side uses a
range window), then states the operator in plain SQL.
"""

from __future__ import annotations

from loadcast.schema import (
    CONTEXT_FEATURES,
    DAY_LAGS,
    FEATURES,
    HOURS,
    IMPUTED,
    LABELS,
    MONTH_LAGS,
    RAW_COLUMNS,
    REMOVED,
    RESULT_CONTEXT,
    RIDGE_REG_PARAM,
    WEEK_LAGS,
    clean_columns,
)

ROUND = 6


def _join(items, sep=",\n  "):
    return sep.join(items)


def meter_day_ctes(meters: int | None = None) -> str:
    """CTEs ``loads`` and ``meter_day`` (107 columns); ``meters`` folds users
    into that many metering points (user_id % meters)."""
    mp = "user_id" if meters is None else f"user_id % {int(meters)}"
    sums = _join(
        f"CAST(SUM(v) FILTER (WHERE h = {h}) AS DOUBLE) AS {c}" for h, c in zip(HOURS, LABELS))
    lag_cols = []
    joins = []
    for alias, names, n in (("d", DAY_LAGS, 1), ("w", WEEK_LAGS, 7), ("m", MONTH_LAGS, 30)):
        lag_cols += [f"{alias}.{src} AS {dst}" for src, dst in zip(LABELS, names)]
        joins.append(
            f"LEFT JOIN loads {alias} ON {alias}.MP_ID = b.MP_ID "
            f"AND {alias}.STAT_CYCLE + {n} = b.STAT_CYCLE")
    base_loads = _join(f"b.{c}" for c in LABELS)
    ctx = """
  CAST(MP_ID % 3 AS INTEGER) AS AREA_NO,
  CAST(CASE WHEN dd % 7 IN (6, 0) THEN 1 ELSE 0 END AS INTEGER) AS HOLIDAY,
  CAST(MP_ID % 2 AS INTEGER) AS ELECTRO_TYPE,
  CASE WHEN MP_ID % 4 = 0 THEN '31B0' ELSE CAST(3100 + MP_ID AS VARCHAR) END AS TRADE_NO,
  ((MP_ID * 7 + dd * 13) % 50) / 10e0 AS WINDSPEED,
  ((MP_ID * 3 + dd * 11) % 80) / 10e0 AS LAPSERATE,
  1e3 + ((MP_ID + dd * 5) % 300) / 10e0 AS AIRPRESSURE,
  CASE WHEN (MP_ID + dd) % 17 = 0 THEN NULL ELSE 4e1 + (MP_ID * 5 + dd * 3) % 50 END AS HUMIDITY,
  ((dd * 17 + MP_ID) % 30) / 10e0 AS PRECIPITATIONRANINFALL"""
    return f"""ev AS (
  SELECT CAST({mp} AS BIGINT) AS MP_ID, CAST(ts AS DATE) AS STAT_CYCLE,
         hour(ts) AS h, CAST(value AS DECIMAL(18,2)) AS v
  FROM events
),
loads AS (
  SELECT MP_ID, STAT_CYCLE,
  {sums}
  FROM ev GROUP BY MP_ID, STAT_CYCLE
),
lagged AS (
  SELECT b.MP_ID, b.STAT_CYCLE, dayofmonth(b.STAT_CYCLE) AS dd,
  {base_loads},
  {_join(lag_cols)}
  FROM loads b
  {chr(10).join('  ' + j for j in joins)}
),
meter_day AS (
  SELECT MP_ID, STAT_CYCLE,{ctx},
  {_join(list(LABELS) + list(DAY_LAGS) + list(WEEK_LAGS) + list(MONTH_LAGS))}
  FROM lagged
)"""


def _r(expr: str, digits: int = ROUND) -> str:
    return f"round({expr}, {digits})"


def dropped_cte(carry=()) -> str:
    cols = [c for c in RAW_COLUMNS if c not in REMOVED or c in carry]
    return f"dropped AS (SELECT {', '.join(cols)} FROM meter_day)"


def means_cte() -> str:
    return ("means AS (SELECT AREA_NO, "
            + ", ".join(f"avg({c}) AS m_{c}" for c in IMPUTED)
            + " FROM dropped GROUP BY AREA_NO)")


def imputed_cte(round_digits: int | None = None, carry=()) -> str:
    """``imputed``: dropped + area-mean filling; TRADE_NO still a string."""
    cols = []
    for c in clean_columns(carry=carry):
        if c == "AREA_NO":
            cols.append("d.AREA_NO")
        elif c in IMPUTED:
            e = f"COALESCE(d.{c}, m.m_{c})"
            cols.append(f"{_r(e, round_digits) if round_digits else e} AS {c}")
        else:
            cols.append(f"d.{c}")
    return (f"imputed AS (SELECT {', '.join(cols)} FROM dropped d "
            f"LEFT JOIN means m ON d.AREA_NO = m.AREA_NO)")


TRADE_SQL = (r"TRY_CAST(regexp_extract(CASE WHEN TRADE_NO = '31B0' THEN '3000' ELSE TRADE_NO END, "
             r"'^\s*([+-]?\d+)(\.\d*)?\s*$', 1) AS INTEGER)")


def cleaned_cte(round_digits: int | None = None, carry=()) -> str:
    cols = [TRADE_SQL + " AS TRADE_NO" if c == "TRADE_NO" else c
            for c in clean_columns(carry=carry)]
    return (f"{dropped_cte(carry)},\n{means_cte()},\n{imputed_cte(round_digits, carry)},\n"
            f"cleaned AS (SELECT {', '.join(cols)} FROM imputed)")


def complete_cte(source: str = "cleaned", carry=()) -> str:
    conds = []
    for c in clean_columns(carry=carry):
        conds.append(f"{c} IS NOT NULL")
        if c in IMPUTED or c in ("WINDSPEED", "LAPSERATE", "AIRPRESSURE", "HUMIDITY",
                                 "PRECIPITATIONRANINFALL"):
            conds.append(f"NOT isnan({c})")
    return f"complete AS (SELECT * FROM {source} WHERE {' AND '.join(conds)})"


BUCKET_SQL = ("CAST(('0x' || substr(md5(CAST(MP_ID AS VARCHAR) || '|' || "
              "CAST(STAT_CYCLE AS VARCHAR)), 1, 8))::BIGINT % 100 AS INTEGER)")


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def pipeline_ctes(carry=("STAT_CYCLE",)) -> str:
    """meter_day → cleaned (unrounded, STAT_CYCLE carried) → complete → split."""
    return with_(
        meter_day_ctes(),
        cleaned_cte(None, carry),
        complete_cte("cleaned", carry),
        f"split AS (SELECT *, {BUCKET_SQL} AS SPLIT_BUCKET FROM complete)",
        "train AS (SELECT * FROM split WHERE SPLIT_BUCKET < 70)",
        "test AS (SELECT * FROM split WHERE SPLIT_BUCKET >= 70)",
    )


def single_feature_fits_cte() -> str:
    """Closed form of ridge with one standardized feature (MLlib's normal
    equation with the regularization scaled by the label's population σ)."""
    parts = []
    for h in HOURS:
        x, y = f"DLOAD{h}", f"LOAD{h}"
        parts.append(
            f"SELECT '{y}' AS label, {h} AS hour, covar_pop({y}, {x}) AS cxy, "
            f"var_pop({x}) AS vx, stddev_pop({y}) AS sy, avg({x}) AS mx, avg({y}) AS my "
            f"FROM train")
    moments = "\nUNION ALL\n".join(parts)
    reg = repr(float(RIDGE_REG_PARAM))
    return (f"moments AS ({moments}),\n"
            f"fits AS (SELECT label, hour, slope, my - slope * mx AS intercept FROM ("
            f"SELECT *, CASE WHEN vx = 0 OR sy = 0 THEN 0e0 "
            f"ELSE cxy / vx / (1 + {reg} / sy) END AS slope FROM moments))")


def single_feature_scored_cte(digits: int | None = 4) -> str:
    def settle(expr):
        return expr if digits is None else f"round({expr}, {digits})"

    cols = []
    for h in HOURS:
        pred = settle(f"(SELECT slope FROM fits WHERE hour = {h}) * DLOAD{h} + "
                      f"(SELECT intercept FROM fits WHERE hour = {h})")
        cols.append(f"{pred} AS TLOAD{h}")
    base = ", ".join(["MP_ID", "STAT_CYCLE"] + list(LABELS) + cols)
    re_cols = [
        settle(f"CASE WHEN LOAD{h} <> 0 THEN abs(LOAD{h} - TLOAD{h}) / abs(LOAD{h}) "
               f"ELSE abs(TLOAD{h}) END") + f" AS TLOAD{h}_RE" for h in HOURS]
    return (f"pred AS (SELECT {base} FROM test),\n"
            f"scored AS (SELECT *, {', '.join(re_cols)} FROM pred)")


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    md = with_(meter_day_ctes())
    raw_cols = ", ".join(RAW_COLUMNS)

    q["meter_day"] = md + f"SELECT {raw_cols} FROM meter_day"
    q["csv_roundtrip"] = q["meter_day"]
    q["ingest"] = q["meter_day"]
    q["stream_ingest"] = q["meter_day"]

    q["schema_report"] = (
        "SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS ordinal, column_name, "
        "CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
        "WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'DATE' THEN 'date' "
        "ELSE lower(column_type) END AS data_type FROM (DESCRIBE ("
        + md + f"SELECT {raw_cols} FROM meter_day))")

    q["schema_report_clean"] = (
        "SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS ordinal, column_name, "
        "CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
        "WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'DATE' THEN 'date' "
        "ELSE lower(column_type) END AS data_type FROM (DESCRIBE ("
        + with_(meter_day_ctes(), cleaned_cte(None)) + "SELECT * FROM cleaned))")

    q["preview"] = (md + "SELECT " + ", ".join(("STAT_CYCLE",) + RESULT_CONTEXT)
                    + " FROM meter_day ORDER BY MP_ID, STAT_CYCLE LIMIT 20")

    q["drop_columns"] = (md + "SELECT " + ", ".join(c for c in RAW_COLUMNS if c not in REMOVED)
                         + " FROM meter_day")

    counts = ", ".join(f"count({c}) AS nn_{i}" for i, c in enumerate(RAW_COLUMNS))
    rows = "\nUNION ALL\n".join(
        f"SELECT CAST({i} AS INTEGER) AS ordinal, '{c}' AS column_name, "
        f"n - nn_{i} AS missing_count, CAST(1 AS DOUBLE) - nn_{i} / n AS missing_ratio FROM counts"
        for i, c in enumerate(RAW_COLUMNS))
    q["missing_profile"] = with_(
        meter_day_ctes(), f"counts AS MATERIALIZED (SELECT count(*) AS n, {counts} FROM meter_day)"
    ) + rows

    q["drop_sparse_columns"] = (md + "SELECT " + ", ".join(
        c for c in RAW_COLUMNS if c not in MONTH_LAGS) + " FROM meter_day")

    q["area_means"] = with_(meter_day_ctes(), dropped_cte()) + (
        "SELECT AREA_NO, " + ", ".join(f"{_r(f'avg({c})')} AS {c}" for c in IMPUTED)
        + " FROM dropped GROUP BY AREA_NO")

    q["impute_area_mean"] = with_(
        meter_day_ctes(), dropped_cte(), means_cte(), imputed_cte(ROUND)) + "SELECT * FROM imputed"

    q["recode_trade"] = md + f"SELECT MP_ID, STAT_CYCLE, {TRADE_SQL} AS TRADE_NO FROM meter_day"

    q["clean"] = with_(meter_day_ctes(), cleaned_cte(ROUND)) + "SELECT * FROM cleaned"

    q["complete_rows"] = with_(meter_day_ctes(), cleaned_cte(ROUND), complete_cte()) + \
        "SELECT * FROM complete"

    pipe = pipeline_ctes()
    q["hash_split"] = pipe + (
        "SELECT MP_ID, STAT_CYCLE, SPLIT_BUCKET, "
        "CASE WHEN SPLIT_BUCKET < 70 THEN 'train' ELSE 'test' END AS SPLIT FROM split")

    feats = ", ".join(f"round(CAST({c} AS DOUBLE), {ROUND})" for c in FEATURES)
    q["assemble_features"] = pipe + f"SELECT MP_ID, STAT_CYCLE, [{feats}] AS features FROM complete"

    fits = pipe.rstrip() + ",\n" + single_feature_fits_cte() + "\n"
    q["ridge_single_feature"] = fits + (
        f"SELECT label, hour, {_r('slope')} AS slope, {_r('intercept')} AS intercept FROM fits")

    scored = fits.rstrip() + ",\n" + single_feature_scored_cte(4) + "\n"
    wide = ", ".join(f"TLOAD{h}, TLOAD{h}_RE" for h in HOURS)
    q["relative_error"] = scored + f"SELECT MP_ID, STAT_CYCLE, {wide} FROM scored"

    rm = "\nUNION ALL\n".join(
        f"SELECT 'LOAD{h}' AS label, {h} AS hour, "
        f"{_r(f'sqrt(avg((LOAD{h} - TLOAD{h}) * (LOAD{h} - TLOAD{h})))')} AS rmse FROM scored"
        for h in HOURS)
    q["rmse_by_hour"] = scored + rm

    rounded_clean = ", ".join(
        f"{_r(c)} AS {c}" if c in IMPUTED else c for c in clean_columns(carry=("STAT_CYCLE",)))
    q["result_append"] = pipe + (
        f"SELECT {rounded_clean}, CASE WHEN SPLIT_BUCKET < 70 THEN 'train' ELSE 'test' END "
        "AS SPLIT FROM split")

    cleaned_keyed = with_(meter_day_ctes(), cleaned_cte(ROUND, ("STAT_CYCLE",)))
    q["makedata"] = cleaned_keyed + "SELECT * FROM cleaned"
    q["page"] = cleaned_keyed + "SELECT * FROM cleaned ORDER BY MP_ID, STAT_CYCLE LIMIT 20 OFFSET 40"
    q["page_indexed"] = (cleaned_keyed
                         + "SELECT * FROM cleaned ORDER BY MP_ID, STAT_CYCLE LIMIT 20 OFFSET 2000")
    q["page_count"] = cleaned_keyed + (
        "SELECT count(*) AS total_rows, CAST(ceil(count(*) / 20) AS BIGINT) AS total_pages "
        "FROM cleaned")
    q["csv_reordered"] = md + f"SELECT {raw_cols}, 'x' AS REMARK FROM meter_day"
    q["stream_ingest_restart"] = q["meter_day"]
    q["trade_codes"] = (
        f"SELECT event_id, {TRADE_SQL} AS TRADE_NO FROM (SELECT event_id, "
        "['3100', '3100.0', ' 31 ', '31B0', '31C0', '', '-7.9'][event_id % 7 + 1] AS TRADE_NO FROM events)")
    q["random_split_keys"] = pipe + "SELECT MP_ID, STAT_CYCLE, count(*) AS times FROM complete GROUP BY ALL"
    rounded = ", ".join(f"{_r(c)} AS {c}" if c in IMPUTED else c for c in clean_columns(carry=("STAT_CYCLE",)))
    q["page_tied_key"] = pipe + f"SELECT {rounded} FROM (SELECT * FROM cleaned ORDER BY AREA_NO, MP_ID, STAT_CYCLE LIMIT 20 OFFSET 120)"
    cells = ("SELECT MP_ID, STAT_CYCLE, " + ", ".join(f"{_r(f'm{h}')} AS TLOAD{h}" for h in (0, 8, 16))
             + " FROM test JOIN (SELECT AREA_NO, HOLIDAY, ELECTRO_TYPE, "
             + ", ".join(f"avg(LOAD{h}) AS m{h}" for h in (0, 8, 16))
             + " FROM train GROUP BY ALL) USING (AREA_NO, HOLIDAY, ELECTRO_TYPE)")
    q["forest_cells"] = q["gbt_cells"] = pipe + cells
    # A loaded model predicts what the saved one does.
    q["model_save_load"] = "\nUNION ALL\n".join(f"SELECT 'LOAD{h}' AS label, 0e0 AS max_abs_diff" for h in HOURS)
    _durable(q, md, pipe, fits, cleaned_keyed, raw_cols, rm)
    return q


def _durable(q, md, pipe, fits, cleaned_keyed, raw_cols, rmse_rows) -> None:
    """Tables, models and results that survive failures: what they hold then."""
    loads = ", ".join(LABELS)
    q["preview_unindexed"] = q["preview"]
    q["publish_replace"] = md + (
        f"SELECT MP_ID, STAT_CYCLE, {loads}, 'after_failure' AS STEP FROM meter_day WHERE MP_ID % 2 = 0\n"
        f"UNION ALL SELECT MP_ID, STAT_CYCLE, {loads}, 'after_replace' FROM meter_day")
    q["page_manifest"] = cleaned_keyed + "SELECT * FROM cleaned ORDER BY MP_ID, STAT_CYCLE LIMIT 20 OFFSET 780"
    q["page_seek"] = cleaned_keyed + "SELECT * FROM cleaned WHERE MP_ID >= 50 ORDER BY MP_ID, STAT_CYCLE LIMIT 200"
    q["index_manifest"] = cleaned_keyed + """SELECT (r // 150)::BIGINT AS chunk, count(*) AS rows, min(r)::BIGINT AS first_row,
  arg_min(MP_ID, r) AS low_mp, arg_min(STAT_CYCLE, r) AS low_cycle, arg_max(MP_ID, r) AS high_mp, arg_max(STAT_CYCLE, r) AS high_cycle
FROM (SELECT *, row_number() OVER (ORDER BY MP_ID, STAT_CYCLE) - 1 AS r FROM cleaned) GROUP BY r // 150"""
    q["ingest_mixed_headers"] = md + (
        f"SELECT {raw_cols}, CASE WHEN MP_ID % 4 = 1 THEN 'x, y' END AS REMARK FROM meter_day "
        "WHERE MP_ID % 4 < 2 OR (MP_ID % 4 = 3 AND dayofmonth(STAT_CYCLE) % 2 = 1)")
    q["ingest_mixed_rejects"] = md + (
        "SELECT CASE WHEN MP_ID % 4 = 2 THEN 'the header lacks WINDSPEED' ELSE 'WINDSPEED: not a double' END AS reason, "
        "MP_ID, count(*) AS n_lines FROM meter_day "
        "WHERE MP_ID % 4 = 2 OR (MP_ID % 4 = 3 AND dayofmonth(STAT_CYCLE) % 2 = 0) GROUP BY ALL")
    q["model_set_replace"] = q["model_save_exists"] = q["fit_resume"] = q["ridge_single_feature"]
    q["append_once"] = q["result_append"]
    q["random_split_exact"] = pipe + (
        "SELECT MP_ID, STAT_CYCLE, CASE WHEN row_number() OVER (ORDER BY substr(md5('123|=' || CAST(MP_ID AS VARCHAR) "
        "|| '|=' || CAST(STAT_CYCLE AS VARCHAR)), 1, 15)) <= floor(0.7e0 * count(*) OVER () + 0.5e0) "
        "THEN 'train' ELSE 'test' END AS SPLIT FROM complete")
    q["area_means_state"] = q["stream_area_means"] = q["area_means"]
    q["impute_from_state"] = q["impute_area_mean"]
    scored = fits.rstrip() + ",\n" + single_feature_scored_cte(4)
    q["running_rmse"] = f"{scored}\nSELECT *, (SELECT count(*) FROM scored) AS rows FROM ({rmse_rows})"
    wide = ", ".join(f"TLOAD{h}, TLOAD{h}_RE" for h in HOURS)
    again = single_feature_scored_cte(1).replace("pred AS", "pred1 AS").replace("FROM pred)", "FROM pred1)").replace("scored AS", "scored1 AS")
    q["rescore_day"] = (f"{scored},\n{again}\nSELECT MP_ID, STAT_CYCLE, {wide} FROM scored WHERE dayofmonth(STAT_CYCLE) <> 15\n"
                        f"UNION ALL SELECT MP_ID, STAT_CYCLE, {wide} FROM scored1 WHERE dayofmonth(STAT_CYCLE) = 15")
    rounded = ", ".join(f"{_r(c)} AS {c}" for h in HOURS for c in (f"TLOAD{h}", f"TLOAD{h}_RE"))
    q["relative_error_unrounded"] = (f"{fits.rstrip()},\n{single_feature_scored_cte(None)}\n"
                                     f"SELECT MP_ID, STAT_CYCLE, {rounded} FROM scored")


__all__ = ["oracle_queries", "meter_day_ctes", "CONTEXT_FEATURES"]
