"""A stored table of mergeable partial states.

Every load adds the partial statistics of its own rows; what is known of all loads is merged from the
stored states and nothing is read again.  A load is named by its batch: repeating it replaces its own states, so a
retried or late load counts once.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators.stats import merge_partials, na_partials

SCHEMA = "block int, slot int, n long, mean double, m2 double, min double, max double, missing long, batch string"


class PartialStates:
    """States below a shared folder, one sub-folder per batch."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def load(self, batch: str, df: DataFrame, blocks: Column, array_col: str = "scores", n_slots: int = 9) -> None:
        """Write the states of ``df`` as batch ``batch``; states that this batch already has are replaced.

        ``blocks`` spreads a batch over independent states, e.g. a hash bucket.
        """
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
            raise ValueError(f"batch names are letters, digits, '_', '.' and '-', not {batch!r}")
        states = na_partials(df, blocks, array_col, n_slots).select(
            F.col("block").cast("int").alias("block"), F.col("slot").cast("int").alias("slot"), F.col("n").cast("long").alias("n"), "mean", "m2", "min", "max",
            F.col("missing").cast("long").alias("missing"))
        states.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={batch}")  # at most blocks x slots rows

    def states(self, batches: Sequence[str] | None = None) -> DataFrame:
        """The stored states, of all batches or of some."""
        table = self.spark.read.schema(SCHEMA).option("basePath", self.path).parquet(self.path)
        return table if batches is None else table.where(F.col("batch").isin(list(batches)))

    def merged(self, batches: Sequence[str] | None = None) -> DataFrame:
        """(slot, n, mean, stdev, max, min, missing) over all rows of the batches."""
        return merge_partials(self.states(batches))
