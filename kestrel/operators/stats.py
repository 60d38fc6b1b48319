"""Aggregations.

All of them are hash aggregates with map-side partial aggregation, so a
hot key is combined inside each task before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions.scalars import jvm_split_space, nan_to_null


def tokens(df: DataFrame, line_col: str = "line") -> DataFrame:
    """One row per token of the JVM space split."""
    return df.select(F.explode(jvm_split_space(line_col)).alias("word"))


def word_count(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """(word, count) over space-split tokens."""
    return tokens(lines, line_col).groupBy("word").agg(F.count(F.lit(1)).alias("count"))


def keyed_sum(df: DataFrame, key: str, value: str, out: str = "total") -> DataFrame:
    """``reduceByKey(_ + _)``."""
    return df.groupBy(key).agg(F.sum(value).alias(out))


def mean_by(df: DataFrame, keys: Sequence[str], value: str, out: str = "mean") -> DataFrame:
    """Group mean ignoring missing values."""
    return df.groupBy(*keys).agg(F.avg(value).alias(out))


def histogram(df: DataFrame, col: str, out: str = "n") -> DataFrame:
    """``countByValue``."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(out))


def rate(condition: Column) -> Column:
    """Fraction of rows meeting a condition, in one pass."""
    return F.avg(F.when(condition, 1.0).otherwise(0.0))


def _slot_aggs(arr: Column, i: int, where: Column | None = None) -> list[Column]:
    x = nan_to_null(F.get(arr, i))
    if where is not None:
        x = F.when(where, x)
        missing = F.count_if(where & x.isNull())
    else:
        missing = F.count_if(x.isNull())
    return [
        F.count(x).alias(f"n_{i}"),
        F.avg(x).alias(f"mean_{i}"),
        F.stddev_pop(x).alias(f"stdev_{i}"),
        F.max(x).alias(f"max_{i}"),
        F.min(x).alias(f"min_{i}"),
        missing.alias(f"missing_{i}"),
    ]


def _unpivot_slots(wide: DataFrame, n_slots: int, names: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    stack = ", ".join(f"{i}, " + ", ".join(f"{nm}_{i}" for nm in names) for i in range(n_slots))
    cols = ", ".join(["slot", *names])
    return wide.selectExpr(*keys, f"stack({n_slots}, {stack}) as ({cols})")


def na_stats(df: DataFrame, array_col: str = "scores", n_slots: int = 9,
             keys: Sequence[str] = ()) -> DataFrame:
    """Missing-value-aware statistics per array slot (A07, UDF03).

    One pass, no explode: 6 aggregates per slot (count, mean, population
    stdev, max, min of the present values, and the missing count; NaN and
    NULL both count as missing), then the single wide row is unpivoted
    into one row per slot.
    """
    arr = F.col(array_col)
    aggs = [a for i in range(n_slots) for a in _slot_aggs(arr, i)]
    wide = df.groupBy(*keys).agg(*aggs)
    return _unpivot_slots(wide, n_slots, ["n", "mean", "stdev", "max", "min", "missing"], keys)


def na_partials(df: DataFrame, block: Column, array_col: str = "scores", n_slots: int = 9) -> DataFrame:
    """Mergeable partial states per (block, slot): n, mean, m2, min, max, missing."""
    arr = F.col(array_col)
    aggs = []
    for i in range(n_slots):
        x = nan_to_null(F.get(arr, i))
        aggs += [F.count(x).alias(f"n_{i}"), F.avg(x).alias(f"mean_{i}"),
                 (F.var_pop(x) * F.count(x)).alias(f"m2_{i}"),
                 F.min(x).alias(f"min_{i}"), F.max(x).alias(f"max_{i}"),
                 F.count_if(x.isNull()).alias(f"missing_{i}")]
    wide = df.groupBy(block.alias("block")).agg(*aggs)
    return _unpivot_slots(wide, n_slots, ["n", "mean", "m2", "min", "max", "missing"], ["block"])


def merge_partials(partials: DataFrame, keys: Sequence[str] = ("slot",)) -> DataFrame:
    """Combine stored partial states (Chan et al. parallel variance merge).

    n = sum n_i; mean = sum(n_i * mean_i) / n;
    m2 = sum m2_i + sum n_i * (mean_i - mean)^2; stdev = sqrt(m2 / n).
    """
    p = partials.where(F.col("n") > 0)
    first = p.groupBy(*keys).agg(
        F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("mean"),
        F.max("max").alias("max"), F.min("min").alias("min"))
    second = p.join(first.select(*keys, F.col("mean").alias("_gm")), list(keys)).groupBy(*keys).agg(
        (F.sum("m2") + F.sum(F.col("n") * (F.col("mean") - F.col("_gm")) ** 2)).alias("m2"))
    missing = partials.groupBy(*keys).agg(F.sum("missing").alias("missing"))
    out = (missing.join(first, list(keys), "left").join(second, list(keys), "left"))
    return out.select(*keys, F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), "mean",
                      F.sqrt(F.col("m2") / F.col("n")).alias("stdev"), "max", "min",
                      F.col("missing").cast("bigint").alias("missing"))


def class_contrast(df: DataFrame, flag_col: str = "matched", array_col: str = "scores",
                   n_slots: int = 9) -> DataFrame:
    """Per slot: missing count over both classes and the difference of class
    means (flagged minus unflagged) (A14), in a single pass."""
    arr, flag = F.col(array_col), F.col(flag_col)
    aggs = []
    for i in range(n_slots):
        x = nan_to_null(F.get(arr, i))
        aggs += [F.count_if(x.isNull()).alias(f"missing_{i}"),
                 (F.avg(F.when(flag, x)) - F.avg(F.when(~flag, x))).alias(f"mean_diff_{i}")]
    wide = df.agg(*aggs)
    return _unpivot_slots(wide, n_slots, ["missing", "mean_diff"])


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Confusion counts."""
    return df.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))
