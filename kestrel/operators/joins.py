"""Lookup, membership and exclusion joins.

Lookup sides derived from data (alias maps, group means, listen counts)
have no static size bound.  ``lookup_side`` writes such a side once, measures
it and hints a broadcast only under a byte limit: then the big side is not
shuffled at all.  Beyond the limit the join is a shuffle join whose skewed
partitions adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.session import scratch_path

LOOKUP_BYTES = 64 << 20
#: Size of rows in memory for a byte of compressed columns on disk.
UNPACKED = 6


def lookup_side(df: DataFrame, max_bytes: int = LOOKUP_BYTES) -> DataFrame:
    """``df`` written below the shared folder, hinted for broadcast if its measured size allows."""
    spark = df.sparkSession
    path = scratch_path(spark, "lookup")
    df.write.parquet(path)
    side = spark.read.schema(df.schema).parquet(path)
    size = int(side._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return F.broadcast(side) if UNPACKED * size <= max_bytes else side


def lookup_with_default(df: DataFrame, lookup: DataFrame, on: str | Sequence[str], value: str,
                        default: Column | None, out: str, keep: Column | None = None) -> DataFrame:
    """``map.getOrElse(key, default)`` as a left join.

    ``lookup`` must be unique on ``on``.  ``keep`` (a Column over the left
    row) decides whether the original value stays: the value is replaced
    only where ``keep`` is false / NULL; by default every row gets the
    looked-up value or ``default``.
    """
    keys = [on] if isinstance(on, str) else list(on)
    joined = df.join(lookup_side(lookup.select(*keys, F.col(value).alias("_lk"))), keys, "left")
    fill = F.col("_lk") if default is None else F.coalesce(F.col("_lk"), default)
    new = fill if keep is None else F.when(keep, F.col(out)).otherwise(fill)
    cols = [c for c in df.columns if c != out]
    return joined.select(*cols, new.alias(out))


def resolve_alias(df: DataFrame, alias: DataFrame, col: str = "item",
                  bad: str = "bad_id", good: str = "good_id") -> DataFrame:
    """Canonical id or the id itself (J02): ``alias.getOrElse(id, id)``."""
    side = lookup_side(alias.select(F.col(bad).alias(col), F.col(good).alias("_good")))
    joined = df.join(side, col, "left")
    return joined.select(*[F.coalesce("_good", col).alias(col) if c == col else F.col(c) for c in df.columns])


def last_wins(df: DataFrame, key: str, value: str, order: Column | str | None = None) -> DataFrame:
    """One row per key (A13).  ``collectAsMap`` keeps an arbitrary last
    write; here the winner is explicit: the greatest ``order`` (default the
    value itself)."""
    ordc = F.col(value) if order is None else (F.col(order) if isinstance(order, str) else order)
    return df.groupBy(key).agg(F.max_by(F.col(value), ordc).alias(value))


def semi(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows of ``df`` with a match in ``keys``."""
    return df.join(keys, on, "left_semi")


def anti(df: DataFrame, keys: DataFrame, on) -> DataFrame:
    """Rows of ``df`` without a match in ``keys``."""
    return df.join(keys, on, "left_anti")
