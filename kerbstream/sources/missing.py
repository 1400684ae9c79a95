"""A path nobody has written to yet holds no data; that is not an error."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def empty_if_missing(spark: SparkSession, schema: T.StructType,
                     load: Callable[[], DataFrame]) -> DataFrame:
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
