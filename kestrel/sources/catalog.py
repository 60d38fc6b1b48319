"""Views, caching and local rows."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Name a table for SQL (``registerTempTable``)."""
    df.createOrReplaceTempView(name)
    return df


@contextmanager
def cached(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Keep a reused table for the duration of a block, then release it."""
    df.persist(level)
    try:
        yield df
    finally:
        df.unpersist()


def rows_to_table(spark: SparkSession, rows, schema) -> DataFrame:
    """Local rows → table (``parallelize(...).toDF``); for small literals only."""
    return spark.createDataFrame(rows, schema)
