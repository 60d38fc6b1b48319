"""Skew-safe ranking primitives.

A plain ``Window.partitionBy(key)`` sends every row of a key to one task;
with one key holding a third of the data that task is the job.  These
helpers keep every task bounded:

* ``dense_index``: 0-based position of each row in a global order: range
  partitions, numbered inside each and shifted by the row counts of the
  earlier ones (a table with one row per partition).
* ``keyed_prefix_sums``: per key, the sum of some values over the rows
  that come strictly before the row in a given order.  Ordinary keys use
  one window per key; hot keys (more than ``hot_rows`` rows) are
  range-partitioned on (key, order) so that each spans many bounded
  partitions, and local running sums are completed with per-(partition,
  key) offsets.  ``hot_rows`` changes the plan alone, not the result.
* ``blocked_prefix_sums``: the same over a dense integer order (draw
  numbers), with fixed blocks instead of range partitions: deterministic
  and bounded without any checkpoint.
* ``top_k_per_key``: k best rows per key in two rounds (per salted
  sub-group, then over the at most k * salts survivors of each key).

Range-partitioned, partition-tagged frames are cut with a reliable
checkpoint (the cluster's ``spark.checkpoint.dir``) so that the tags are
stable when the frame is read twice and survive executor loss.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.session import cut_lineage


def _parts(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _as_list(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def dense_index(df: DataFrame, order_cols: str | Sequence[str], index_col: str = "idx",
                num_partitions: int | None = None) -> DataFrame:
    """Add ``index_col`` = 0-based rank of the row in ``order_cols`` order.

    The order columns must be unique (e.g. a distinct key column).  Rows are
    range-partitioned and written; a row's number in its partition is part
    of what is written, so that only the partitions' counts are summed up.
    """
    order = _as_list(order_cols)
    n = _parts(df, num_partitions)
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    tagged = cut_lineage(ranged.withColumn("_id", F.monotonically_increasing_id()))
    part, row = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    counts = tagged.groupBy(part.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: a proven size bound for the broadcast
    offsets = counts.select(
        "_pid", (F.sum("_n").over(Window.orderBy("_pid")) - F.col("_n")).alias("_off"))
    out = tagged.withColumn("_pid", part).join(F.broadcast(offsets), "_pid")
    return out.select(*df.columns, (F.col("_off") + row).cast("bigint").alias(index_col))


def _range_prefix_sums(df: DataFrame, keys: list[str], orders: list[str], values: Sequence[str],
                       suffix: str, n: int) -> DataFrame:
    tagged = cut_lineage(df.repartitionByRange(n, *keys, *orders)
                         .withColumn("_pid", F.spark_partition_id()))
    w_local = (Window.partitionBy("_pid", *keys).orderBy(*orders)
               .rowsBetween(Window.unboundedPreceding, -1))
    local = tagged.select(
        "*", *[F.coalesce(F.sum(v).over(w_local), F.lit(0)).alias(f"_l_{v}") for v in values])
    totals = tagged.groupBy("_pid", *keys).agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    # at most one row per (partition, key): a hot key has one row per partition it spans
    w_off = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_pid", *keys, *[F.coalesce(F.sum(f"_t_{v}").over(w_off), F.lit(0)).alias(f"_o_{v}") for v in values])
    joined = local.join(offsets, ["_pid", *keys])
    return joined.select(*df.columns,
                         *[(F.col(f"_o_{v}") + F.col(f"_l_{v}")).alias(f"{v}{suffix}") for v in values])


def _window_prefix_sums(df: DataFrame, keys: list[str], orders: list[str], values: Sequence[str],
                        suffix: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*orders).rowsBetween(Window.unboundedPreceding, -1)
    return df.select("*", *[F.coalesce(F.sum(v).over(w), F.lit(0)).alias(f"{v}{suffix}") for v in values])


def keyed_prefix_sums(df: DataFrame, key: str | Sequence[str], order: str | Sequence[str],
                      values: Sequence[str], suffix: str = "_before",
                      num_partitions: int | None = None, hot_rows: int = 1_000_000) -> DataFrame:
    """For each row: sum of each value column over the earlier rows of its key.

    (key, order) must be unique.  The result has the input columns plus
    ``<value><suffix>`` for every value column (0 for the first row).

    Keys with at most ``hot_rows`` rows use one window per key (a task
    holds at most ``hot_rows`` rows of a key).  Hot keys (found by one
    partially aggregated count) are range-partitioned on (key, order) so
    that each spans many bounded partitions, and completed with
    per-(partition, key) offsets.  ``hot_rows=0`` forces the range form.
    """
    keys, orders = _as_list(key), _as_list(order)
    n = _parts(df, num_partitions)
    if hot_rows <= 0:
        return _range_prefix_sums(df, keys, orders, values, suffix, n)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    hot = sizes.where(F.col("_rows") > hot_rows).select(*keys)
    if hot.isEmpty():
        return _window_prefix_sums(df, keys, orders, values, suffix)
    hot = cut_lineage(hot)
    cold_rows = _window_prefix_sums(df.join(hot, keys, "left_anti"), keys, orders, values, suffix)
    hot_rows_df = _range_prefix_sums(df.join(hot, keys, "left_semi"), keys, orders, values, suffix, n)
    return cold_rows.unionByName(hot_rows_df)


def blocked_prefix_sums(df: DataFrame, key: str | Sequence[str], order: str, values: Sequence[str],
                        block: int, suffix: str = "_before") -> DataFrame:
    """Prefix sums per key over an integer order column whose values are
    dense per key (e.g. draw numbers 1, 2, 3, ...).

    Rows are grouped in fixed blocks of ``block`` consecutive order values:
    a window inside each (key, block) group gives the local prefix, a window
    over the per-block totals of a key gives the block offsets.  Both are
    deterministic, no group exceeds ``block`` rows and a key spans
    (its rows / block) block totals.
    """
    keys = _as_list(key)
    b = F.floor((F.col(order) - F.lit(1)) / F.lit(block)).cast("bigint")
    df_b = df.withColumn("_blk", b)
    w_local = Window.partitionBy(*keys, "_blk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    local = df_b.select("*", *[F.coalesce(F.sum(v).over(w_local), F.lit(0)).alias(f"_l_{v}") for v in values])
    totals = df_b.groupBy(*keys, "_blk").agg(*[F.sum(v).alias(f"_t_{v}") for v in values])
    w_off = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_blk",
                            *[F.coalesce(F.sum(f"_t_{v}").over(w_off), F.lit(0)).alias(f"_o_{v}") for v in values])
    joined = local.join(offsets, [*keys, "_blk"])
    return joined.select(*df.columns,
                         *[(F.col(f"_o_{v}") + F.col(f"_l_{v}")).alias(f"{v}{suffix}") for v in values])


def top_k_per_key(df: DataFrame, key: str | Sequence[str], k: int, order: Sequence,
                  salt_cols: Sequence[str], salts: int | None = None, rank_col: str = "rank") -> DataFrame:
    """k best rows per key by ``order`` (a list of sort Columns with a unique
    tiebreak).  First round: per (key, salt) where the salt hashes
    ``salt_cols``; second round: over the survivors of each key."""
    keys = _as_list(key)
    s = salts or _parts(df, None)
    salted = df.withColumn("_salt", F.pmod(F.hash(*[F.col(c) for c in salt_cols]), F.lit(s)))
    first = (salted.withColumn("_r1", F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order)))
             .where(F.col("_r1") <= k).drop("_r1", "_salt"))
    ranked = first.withColumn(rank_col, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(rank_col) <= k)
