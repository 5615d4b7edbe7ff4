"""Meter-day table derived from the ``events`` table.

The driver's tables hold no meter data, so the raw meter-day input is built
from ``events``: each user (or ``user_id % meters``) is a metering point, each
calendar day of ``ts`` a cycle, and the hourly loads are the decimal sums of
``value`` per hour. Lagged loads are the loads of the same meter 1, 7 and 30
calendar days earlier; the context columns are fixed functions of the meter
and the day of the month.

Plan: one scan of ``events`` (three columns), a hash aggregate with map-side
partial sums keyed on (meter, day) — a meter holding a third of all events is
collapsed to one row per day per task before the shuffle — then one window
exchange on the meter for the three lags. The window group of a meter is its
days, which the calendar bounds, however many events the meter has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import DAY_LAGS, HOURS, LABELS, MONTH_LAGS, RAW_COLUMNS, WEEK_LAGS

LAG_DAYS = {DAY_LAGS: 1, WEEK_LAGS: 7, MONTH_LAGS: 30}


def hourly_loads(events: DataFrame, meters: int | None = None) -> DataFrame:
    """(MP_ID, STAT_CYCLE, LOAD0..LOAD23) — one row per meter and day seen."""
    mp = F.col("user_id") if meters is None else F.col("user_id") % F.lit(meters)
    hourly = events.select(
        mp.cast("long").alias("MP_ID"),
        F.to_date("ts").alias("STAT_CYCLE"),
        F.hour("ts").alias("_hour"),
        F.col("value").cast("decimal(18,2)").alias("_value"),
    )
    sums = [
        F.sum(F.when(F.col("_hour") == h, F.col("_value"))).cast("double").alias(c)
        for h, c in zip(HOURS, LABELS)
    ]
    return hourly.groupBy("MP_ID", "STAT_CYCLE").agg(*sums)


def with_lags(loads: DataFrame) -> DataFrame:
    """Add DLOAD*, WLOAD*, MLOAD*: the loads n calendar days earlier, or null."""
    day = F.unix_date("STAT_CYCLE")
    base = Window.partitionBy("MP_ID").orderBy(day)
    # One function per frame: the day's loads travel as one struct.
    day_loads = F.struct(*LABELS)
    seen = loads.select("*", *[F.first(day_loads).over(base.rangeBetween(-n, -n)).alias(f"_{n}")
                               for n in LAG_DAYS.values()])
    lags = [F.col(f"_{n}")[src].alias(dst) for names, n in LAG_DAYS.items() for src, dst in zip(LABELS, names)]
    return seen.select(*loads.columns, *lags)


def _context(mp: Column, dd: Column) -> list[Column]:
    """Context columns as fixed functions of the meter and the day of month."""
    return [
        (mp % 3).cast("int").alias("AREA_NO"),
        F.when((dd % 7).isin(6, 0), 1).otherwise(0).cast("int").alias("HOLIDAY"),
        (mp % 2).cast("int").alias("ELECTRO_TYPE"),
        F.when(mp % 4 == 0, F.lit("31B0"))
        .otherwise((F.lit(3100) + mp).cast("string"))
        .alias("TRADE_NO"),
        (((mp * 7 + dd * 13) % 50) / F.lit(10.0)).alias("WINDSPEED"),
        (((mp * 3 + dd * 11) % 80) / F.lit(10.0)).alias("LAPSERATE"),
        (F.lit(1000.0) + ((mp + dd * 5) % 300) / F.lit(10.0)).alias("AIRPRESSURE"),
        F.when((mp + dd) % 17 == 0, F.lit(None).cast("double"))
        .otherwise(F.lit(40.0) + ((mp * 5 + dd * 3) % 50).cast("double"))
        .alias("HUMIDITY"),
        (((dd * 17 + mp) % 30) / F.lit(10.0)).alias("PRECIPITATIONRANINFALL"),
    ]


def meter_day_from_events(events: DataFrame, meters: int | None = None) -> DataFrame:
    """The raw meter-day table (107 columns, ``RAW_SCHEMA`` order)."""
    lagged = with_lags(hourly_loads(events, meters))
    mp, dd = F.col("MP_ID"), F.dayofmonth("STAT_CYCLE")
    with_ctx = lagged.select("*", *_context(mp, dd))
    return with_ctx.select(*RAW_COLUMNS)


def meter_day(spark: SparkSession, sf_dir: str, meters: int | None = None) -> DataFrame:
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return meter_day_from_events(events, meters)
