"""Implicit-feedback recommender and its evaluation.

* Model: ``pyspark.ml`` ALS with implicit preferences; unknown users or
  items are dropped at scoring time (``coldStartStrategy='drop'``).
* Popularity baseline: score = total training listens of the item, 0.0
  for an item never listened to in training (M14).
* Mean per-user AUC with sampled negatives (X04 + E03), k-fold
  cross-validation (M15) and a parameter grid (M16): every step is a
  distributed job; the only driver loops are over folds and parameter
  settings, never over data.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import partial, reduce
from itertools import product

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators.evaluate import mean_user_auc, user_auc
from kestrel.operators.factors import top_products
from kestrel.operators.joins import lookup_side
from kestrel.operators.ranking import dense_index, top_k_per_key
from kestrel.operators.sampling import ItemIndex, item_index, k_folds, negative_samples
from kestrel.operators.wide_factors import WIDE, FactorModel, fit_wide
from kestrel.session import checkpoint_dir, collect_garbage, concurrently, cut_lineage, scratch_discarded, scratch_path, written

Scorer = Callable[[DataFrame], DataFrame]  # (user, item) pairs -> (user, item, score)

# fixed values: the model settings of the original evaluation
DEFAULT_RANK, DEFAULT_ITER, DEFAULT_REG, DEFAULT_ALPHA = 10, 5, 0.01, 1.0


#: Ratings of a block of ALS at most (a task holds and sorts a block), and up to which fits run side by side.
BLOCK_RATINGS, SIDE_BY_SIDE = 4_000_000, 1_000_000

INT_MIN, INT_MAX = -(2 ** 31), 2 ** 31 - 1


@dataclass
class RecModel:
    """A fitted ALS model plus, when the ids did not fit in an int, the
    id → dense int maps used for fitting (None otherwise)."""
    model: ALSModel | FactorModel
    users: DataFrame | None = None   # (user, _u int)
    items: DataFrame | None = None   # (item, _i int)


def _id_map(ids: DataFrame, col: str, out: str) -> DataFrame:
    idx = dense_index(ids.select(col).distinct(), col, "_idx")
    return cut_lineage(idx.select(col, F.col("_idx").cast("int").alias(out)))


def fit_als(ratings: DataFrame, rank: int = DEFAULT_RANK, max_iter: int = DEFAULT_ITER,
            reg: float = DEFAULT_REG, alpha: float = DEFAULT_ALPHA, seed: int = 42,
            blocks: int | None = None) -> RecModel:
    """``ALS.trainImplicit(ratings, rank, iterations, lambda, alpha)``.

    ``blocks``: user and item blocks, by default one per core of the
    cluster (the library's own default of ten would leave the others idle),
    and more where one would hold over ``BLOCK_RATINGS`` ratings.

    The fitted model is saved and loaded again: the blocks of ratings, the shuffles of all
    half-steps and the cached factors of the fit go then, and no later step computes them anew.

    ALS needs int ids.  One aggregate checks the id ranges: ids that fit are
    cast; otherwise users and items are mapped to dense ints with the
    distributed ``dense_index`` (no single-task numbering) and mapped back
    when scoring and recommending.

    From ``WIDE`` factors on the library gives the first factors, and the half-steps
    are solved by ``fit_wide``: the same equations without rank x rank systems for
    users and items of few ratings.
    """
    checkpoint_dir(ratings.sparkSession)  # ALS checkpoints its factor lineage there
    b = ratings.agg(F.min("user"), F.max("user"), F.min("item"), F.max("item"), F.count(F.lit(1))).first()
    fits = all(v is None or INT_MIN <= v <= INT_MAX for v in b[:4])
    users = items = None
    if fits:
        data = ratings.select(F.col("user").cast("int").alias("user"), F.col("item").cast("int").alias("item"),
                              F.col("rating").cast("float").alias("rating"))
    else:
        users, items = _id_map(ratings, "user", "_u"), _id_map(ratings, "item", "_i")
        data = (ratings.join(users, "user").join(items, "item")
                .select(F.col("_u").alias("user"), F.col("_i").alias("item"), F.col("rating").cast("float")))
    blocks = blocks or max(2, ratings.sparkSession.sparkContext.defaultParallelism, -(-b[4] // BLOCK_RATINGS))
    wide = rank >= WIDE and max_iter > 0
    als = ALS(numUserBlocks=blocks, numItemBlocks=blocks, rank=rank, maxIter=0 if wide else max_iter, regParam=reg, alpha=alpha, implicitPrefs=True,
              userCol="user", itemCol="item", ratingCol="rating", coldStartStrategy="drop",
              seed=seed, checkpointInterval=1)
    if wide:
        return RecModel(fit_wide(data, als.fit(data).userFactors, rank, max_iter, reg, alpha, 3 * blocks), users, items)
    return RecModel(_saved(als, data), users, items)


def _saved(als: ALS, data: DataFrame) -> ALSModel:
    path = scratch_path(data.sparkSession, "als")
    als.fit(data).write().save(path)
    collect_garbage(data.sparkSession)
    return ALSModel.load(path)


def als_scorer(rm: RecModel) -> Scorer:
    """Pair scoring with a fitted model (M11, J07): unknown ids disappear."""

    def score(pairs: DataFrame) -> DataFrame:
        if rm.users is None:
            p = pairs.select(F.col("user").cast("int").alias("user"), F.col("item").cast("int").alias("item"))
            return rm.model.transform(p).select("user", "item", F.col("prediction").cast("double").alias("score"))
        p = pairs.select("user", "item").join(rm.users, "user").join(rm.items, "item")
        scored = rm.model.transform(p.select("user", "item", F.col("_u"), F.col("_i"))
                                    .withColumnRenamed("user", "_user").withColumnRenamed("item", "_item")
                                    .withColumnRenamed("_u", "user").withColumnRenamed("_i", "item"))
        return scored.select(F.col("_user").alias("user"), F.col("_item").alias("item"),
                             F.col("prediction").cast("double").alias("score"))

    return score


def popularity_scores(train: DataFrame, pairs: DataFrame) -> DataFrame:
    """Popularity baseline (M14): total training rating of the item, else 0.0."""
    listens = lookup_side(train.groupBy("item").agg(F.sum("rating").alias("_total")))
    return pairs.join(listens, "item", "left").select(
        "user", "item", F.coalesce(F.col("_total"), F.lit(0.0)).alias("score"))


def popularity_scorer(train: DataFrame) -> Scorer:
    return lambda pairs: popularity_scores(train, pairs)


def auc_inputs(held_out: DataFrame, all_items: DataFrame | ItemIndex, scorer: Scorer, seed: int):
    """Scored positive rows and scored sampled negatives for ``held_out``."""
    positives = held_out.select("user", "item")
    negatives = negative_samples(positives, all_items, seed).select("user", "item")
    return scorer(positives), scorer(negatives)


def evaluate_auc(held_out: DataFrame, all_items: DataFrame | ItemIndex, scorer: Scorer, seed: int = 7,
                 per_user: bool = False) -> DataFrame:
    """Mean per-user AUC of a scorer on held-out ratings."""
    pos, neg = auc_inputs(held_out, all_items, scorer, seed)
    return user_auc(pos, neg) if per_user else mean_user_auc(pos, neg)


def cross_validated_auc(ratings: DataFrame, all_items: DataFrame, k: int = 10, seed: int = 500,
                        fit: Callable[[DataFrame], Scorer] | None = None, parallelism: int = 4) -> DataFrame:
    """k-fold cross-validated mean AUC (M15, X03, A17): (fold, mean_auc, users) rows.

    ``fit`` turns a fold's training rows into a scorer, by default the ALS model; ``parallelism`` folds run at a time, of large tables
    one (``SIDE_BY_SIDE``).  What a fold writes goes with it."""
    fit = fit or (lambda train: als_scorer(fit_als(train)))

    def fold(i: int, train: DataFrame, valid: DataFrame) -> DataFrame:
        with scratch_discarded(ratings.sparkSession):
            auc = evaluate_auc(valid, index, fit(train), seed=seed + i)
            return cut_lineage(auc.select(F.lit(i).alias("fold"), "mean_auc", "users"))

    index = item_index(written(all_items, "items"))
    parallelism = _side_by_side(ratings, parallelism)
    folds = [partial(fold, i, *parts) for i, parts in enumerate(k_folds(ratings, k, seed, ["user", "item", "cnt"]))]
    return reduce(DataFrame.unionByName, concurrently(ratings.sparkSession, folds, parallelism))


def _side_by_side(ratings: DataFrame, parallelism: int) -> int:
    """Fits of large tables fill the cluster alone; together they hold that many times the memory and disk."""
    return parallelism if ratings.count() <= SIDE_BY_SIDE else 1


def grid_search(train: DataFrame, held_out: DataFrame, all_items: DataFrame,
                ranks: Sequence[int], regs: Sequence[float], alphas: Sequence[float],
                max_iter: int = 10, seed: int = 7, parallelism: int = 4) -> DataFrame:
    """(rank, lambda, alpha, mean_auc, users), best first.

    All settings are fitted on one written set and judged on the same negatives, which are drawn once; ``parallelism`` settings run
    at a time, of large tables one (``SIDE_BY_SIDE``).  What a setting writes goes with it."""
    train = written(train, "train")
    positives = written(held_out.select("user", "item"), "held-out")
    negatives = negative_samples(positives, all_items, seed).select("user", "item")  # written by the draws

    def setting(rank: int, reg: float, alpha: float) -> DataFrame:
        with scratch_discarded(train.sparkSession):
            score = als_scorer(fit_als(train, rank, max_iter, reg, alpha))
            auc = mean_user_auc(score(positives), score(negatives))
            return cut_lineage(auc.select(F.lit(rank).alias("rank"), F.lit(float(reg)).alias("lambda"),
                                          F.lit(float(alpha)).alias("alpha"), "mean_auc", "users"))

    parallelism = _side_by_side(train, parallelism)
    out = reduce(DataFrame.unionByName, concurrently(train.sparkSession, [partial(setting, *x) for x in product(ranks, regs, alphas)], parallelism))
    return out.orderBy(F.desc("mean_auc"), "rank", "lambda", "alpha")


def factor_tables(rm: RecModel) -> tuple[DataFrame, DataFrame]:
    """The model's factors by the original ids: (user, features), (item, features)."""
    users = rm.model.userFactors.select(F.col("id").alias("user"), "features")
    items = rm.model.itemFactors.select(F.col("id").alias("item"), "features")
    if rm.users is None:
        return users, items
    back = lambda side, factors, name, short: factors.withColumnRenamed(name, short).join(side, short).select(name, "features")
    return back(rm.users, users, "user", "_u"), back(rm.items, items, "item", "_i")


def recommend(rm: RecModel, users: DataFrame, k: int = 5) -> DataFrame:
    """Top-k items for each requested user (L03, M13): (user, rank, item, score), equal scores by the smaller item.

    An exact search that leaves out the items which cannot be among the best (``factors.top_products``).
    Users unknown to the model yield no rows."""
    known, items = factor_tables(rm)
    wanted = known.join(users.select("user").distinct(), "user", "left_semi")
    return top_products(wanted, items, k)[0]


def format_recommendations(recs: DataFrame) -> DataFrame:
    """``"user -> i1, i2, ..."`` in rank order."""
    g = recs.groupBy("user").agg(F.sort_array(F.collect_list(F.struct("rank", "item"))).alias("r"))
    return g.select("user", F.concat(F.col("user").cast("string"), F.lit(" -> "),
                                     F.array_join(F.transform("r", lambda x: x["item"].cast("string")), ", "))
                    .alias("line"))


def top_k_items(scored: DataFrame, k: int = 5) -> DataFrame:
    """Generic top-k per user by score (ties: smaller item first), skew-safe."""
    return top_k_per_key(scored, "user", k, [F.desc("score"), F.asc("item")], ["item"])


def spot_check(spark: SparkSession, model: RecModel, ratings: DataFrame, items: DataFrame,
               user: DataFrame, k: int = 5) -> DataFrame:
    """Items a user touched and the k recommended ones, with names (M12):
    (kind, item, name) where kind is 'played' or 'recommended'."""
    played = ratings.join(user, "user").select("item").distinct()
    named_played = items.join(played, "item", "left_semi").select(F.lit("played").alias("kind"), "item", "name")
    recs = recommend(model, user, k).select("item")
    named_recs = items.join(recs, "item", "left_semi").select(F.lit("recommended").alias("kind"), "item", "name")
    return named_played.unionByName(named_recs)
