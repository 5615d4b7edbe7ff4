"""Schema report and preview of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import KEY

#: Tasks that merge the first rows of all others in a preview.
MERGERS = 64


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, Spark SQL type, nullability.

    Built from the analyzed schema only — no job runs.
    """
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable)
            for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "ordinal int, column_name string, data_type string, nullable boolean")


def preview(df: DataFrame, n: int = 20, columns=None, order_by=KEY) -> DataFrame:
    """First ``n`` rows in key order, without a sort of the table.

    Every task keeps its first ``n`` rows; ``MERGERS`` tasks merge those of many
    tasks each, and only their ``n`` rows are put in order at the end, however many
    tasks read the table. A table with a page index needs no scan: see
    ``paging.preview_index``.
    """
    keys = [c for c in order_by if c in df.columns]
    if not keys:
        out = df.limit(n)
        return out.select(*columns) if columns else out
    group, place = (name for name in ("__merger", "__place"))
    order = Window.partitionBy(group).orderBy(*keys)
    first = (df.withColumn(group, F.spark_partition_id() % MERGERS)
             .withColumn(place, F.row_number().over(order)).where(F.col(place) <= n).drop(group, place))
    out = first.orderBy(*keys).limit(n)
    return out.select(*columns) if columns else out
