"""Text scans and sinks (S01, S12) and line splitting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per line of a file or a folder of files: ``value string``."""
    return spark.read.text(path)


def write_text(df: DataFrame, path: str, column: str = "value") -> str:
    """Write one string column as text parts (one line per row)."""
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)
    return path


def text_lines(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
               keep_empty: bool = False) -> DataFrame:
    """Split a text column on newlines: (id, line_no, line).

    ``line_no`` is the 1-based position in the text; empty lines are dropped
    unless ``keep_empty``.  The split runs per row inside the scan stage.
    """
    out = df.select(id_col, F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("pos", "line"))
    out = out.select(id_col, (F.col("pos") + 1).cast("int").alias("line_no"), "line")
    return out if keep_empty else out.where(F.col("line") != "")


def tuple_text(key, value) -> F.Column:
    """``(key,value)`` as a pair prints on the JVM."""
    return F.concat(F.lit("("), key.cast("string"), F.lit(","), value.cast("string"), F.lit(")"))
