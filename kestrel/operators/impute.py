"""Group-mean imputation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators.joins import lookup_side


def group_means(fit: DataFrame, value: str, keys: Sequence[str], out: str = "mean") -> DataFrame:
    """Mean of ``value`` per key (missing ignored); a key whose values are
    all missing falls back to the overall mean (D10).  One pass over the
    rows: the overall mean comes from the keys' sums and counts."""
    per_key = fit.groupBy(*keys).agg(F.sum(value).alias("_s"), F.count(value).alias("_n"))
    overall = per_key.agg((F.sum("_s") / F.nullif(F.sum("_n"), F.lit(0))).alias("_all")).scalar()
    mean = F.col("_s") / F.nullif(F.col("_n"), F.lit(0))
    return per_key.select(*keys, F.coalesce(mean, overall).alias(out))


def impute_group_mean(df: DataFrame, value: str, keys: Sequence[str],
                      fit: DataFrame | None = None) -> DataFrame:
    """Replace missing ``value`` by the mean of its key group.

    ``fit`` is the table the means come from (by default ``df`` itself; the
    recipes pass train ∪ test, as the original does).  The means table has
    one row per distinct key; it is written, measured and broadcast under
    the lookup limit, so that the rows themselves are not shuffled.
    """
    means = lookup_side(group_means(fit if fit is not None else df, value, keys, "_gm"))
    joined = df.join(means, list(keys), "left")
    return joined.select(*[F.coalesce(F.col(c), F.col("_gm")).alias(c) if c == value else F.col(c)
                           for c in df.columns])
