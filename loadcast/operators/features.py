"""Feature assembly: the 33 numeric inputs as one ``features`` vector."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import FEATURES

FEATURES_COL = "features"


def assembler(features=FEATURES, output: str = FEATURES_COL) -> VectorAssembler:
    """``handleInvalid="error"``: a null input fails the job, so incomplete rows
    must be removed before (``complete_rows``)."""
    return VectorAssembler(inputCols=list(features), outputCol=output, handleInvalid="error")


def assemble(df: DataFrame, features=FEATURES, output: str = FEATURES_COL) -> DataFrame:
    return assembler(features, output).transform(df)


def features_array(df: DataFrame, features=FEATURES, output: str = FEATURES_COL) -> DataFrame:
    """The assembled vector as ``array<double>`` (for inspection and export)."""
    out = assemble(df, features, output)
    return out.withColumn(output, vector_to_array(F.col(output)))
