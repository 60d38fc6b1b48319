"""CSV scan and sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_csv_strings(spark: SparkSession, path: str, columns: Sequence[str], sep: str = ",") -> DataFrame:
    """Headered, quoted CSV with every column read as text (never inferred).

    Spark reads an unquoted empty field as NULL and a quoted empty field as
    ``''``; both mean "missing" to the parsers, which treat NULL and ``''``
    alike.
    """
    return (spark.read.option("header", True).option("sep", sep).option("quote", '"')
            .option("escape", '"').option("mode", "FAILFAST")
            .schema(string_schema(columns)).csv(path))


def write_csv(df: DataFrame, path: str, header: bool = True) -> str:
    """Write a table as a folder of CSV parts (with a header line)."""
    df.write.mode("overwrite").option("header", header).csv(path)
    return path


def empty_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    cols = columns or df.columns
    return df.select(*[F.when(F.col(c) == "", None).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
                       for c in df.columns])
