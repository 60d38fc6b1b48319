"""Evaluation.

``mean_user_auc`` computes, per user, the fraction of (positive,
negative) pairs whose positive score is strictly higher, then the mean
over users that have both positives and negatives.  No pair is ever
materialised: rows are pre-aggregated per (user, score) and each score
level learns how many negatives lie strictly below it from skew-safe
prefix sums, so the cost is O(n log n) and a hot user is spread over
many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.scalars import null_to_zero
from kestrel.operators.ranking import keyed_prefix_sums
from kestrel.session import written


#: Products of two row counts need more than 64 bits when one user is hot.
_WIDE = "decimal(19,0)"


def cut_lineage(levels: DataFrame) -> DataFrame:
    return written(levels, "levels")


def error_rate(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Misclassified fraction (E01, A06) and row count (A15), one pass."""
    return pred.agg(
        F.avg(F.when(F.col(prediction) != F.col(label), 1.0).otherwise(0.0)).alias("error_rate"),
        F.count(F.lit(1)).alias("n"))


def micro_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Overall precision / recall of single-label data: both equal the
    accuracy (E02); per-class values come from ``per_class_metrics``."""
    acc = F.avg(F.when(F.col(prediction) == F.col(label), 1.0).otherwise(0.0))
    return pred.agg(acc.alias("accuracy"), acc.alias("precision"), acc.alias("recall"),
                    (1 - acc).alias("error_rate"), F.count(F.lit(1)).alias("n"))


def per_class_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Per class: true positives, predicted count, actual count, precision, recall.

    One pass over the rows: the (label, prediction) counts are all it needs."""
    counts = pred.groupBy(F.col(label).alias("_l"), F.col(prediction).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    sides = counts.select("_n", F.explode(F.array(
        F.struct(F.col("_l").alias("class"), F.lit(1).alias("actual"), F.lit(0).alias("predicted"),
                 (F.col("_l") == F.col("_p")).cast("int").alias("tp")),
        F.struct(F.col("_p").alias("class"), F.lit(0).alias("actual"), F.lit(1).alias("predicted"),
                 F.lit(0).alias("tp")))).alias("x"))
    out = sides.groupBy("x.class").agg(*[F.sum(F.col("_n") * F.coalesce(F.col(f"x.{c}"), F.lit(0))).alias(c)
                                         for c in ("tp", "predicted", "actual")])
    return out.select("class", "tp", "predicted", "actual",
                      (F.col("tp") / F.nullif(F.col("predicted"), F.lit(0))).alias("precision"),
                      (F.col("tp") / F.nullif(F.col("actual"), F.lit(0))).alias("recall"))


def user_auc(pos_scored: DataFrame, neg_scored: DataFrame, user: str = "user",
             score: str = "score", hot_rows: int = 1_000_000) -> DataFrame:
    """Per-user AUC (E03) from scored positive rows and scored negative rows.

    Every positive row is compared with every negative row of its user
    (duplicates count as many times as they occur); a tie is not a correct
    ranking.  Users lacking positives or negatives are dropped (inner join
    semantics, J01).  Returns (user, n_pos, n_neg, correct decimal, auc).
    """
    rows = (pos_scored.select(F.col(user).alias("user"), F.col(score).alias("score"),
                              F.lit(1).cast("bigint").alias("np"), F.lit(0).cast("bigint").alias("nn"))
            .unionByName(neg_scored.select(F.col(user).alias("user"), F.col(score).alias("score"),
                                           F.lit(0).cast("bigint").alias("np"), F.lit(1).cast("bigint").alias("nn"))))
    # one row per (user, score level), written once: the hot-key check and the
    # ranking both read it instead of re-running the scoring upstream
    levels = cut_lineage(rows.groupBy("user", "score").agg(F.sum("np").alias("np"), F.sum("nn").alias("nn")))
    below = keyed_prefix_sums(levels, "user", "score", ["nn"], hot_rows=hot_rows)
    per_user = below.groupBy("user").agg(
        F.sum("np").alias("n_pos"), F.sum("nn").alias("n_neg"),
        F.sum(F.col("np").cast(_WIDE) * F.col("nn_before").cast(_WIDE)).cast("decimal(38,0)").alias("correct"))
    per_user = per_user.where((F.col("n_pos") > 0) & (F.col("n_neg") > 0))
    return per_user.select(F.col("user").alias(user), "n_pos", "n_neg", "correct",
                           (F.col("correct").cast("double") / (F.col("n_pos").cast("double") * F.col("n_neg"))).alias("auc"))


def mean_user_auc(pos_scored: DataFrame, neg_scored: DataFrame, user: str = "user",
                  score: str = "score") -> DataFrame:
    """Mean over users of the per-user AUC (E03, A12): one row."""
    per_user = user_auc(pos_scored, neg_scored, user, score)
    return per_user.agg(F.avg("auc").alias("mean_auc"), F.count(F.lit(1)).alias("users"))


LINKAGE_SLOTS = (2, 5, 6, 7, 8)  # fixed values: the score slots summed by the linkage rule


def linkage_score(scores_col: str = "scores", slots=LINKAGE_SLOTS) -> F.Column:
    """Sum of the chosen score slots with missing as 0.0."""
    arr = F.col(scores_col)
    expr = None
    for i in slots:
        term = null_to_zero(F.get(arr, i))
        expr = term if expr is None else expr + term
    return expr


def threshold_counts(scored: DataFrame, thresholds=(4.0, 2.0), score: str = "score",
                     flag: str = "matched") -> DataFrame:
    """``filter(score >= t).map(matched).countByValue()`` for every threshold
    in one pass (E04, F05, A05): (threshold, matched, n), zero counts absent."""
    aggs = [F.count_if(F.col(score) >= F.lit(t)).alias(f"n_{i}") for i, t in enumerate(thresholds)]
    wide = scored.groupBy(flag).agg(*aggs)
    stack = ", ".join(f"cast({t} as double), n_{i}" for i, t in enumerate(thresholds))
    long = wide.selectExpr(flag, f"stack({len(thresholds)}, {stack}) as (threshold, n)")
    return long.where(F.col("n") > 0).select("threshold", flag, "n")
