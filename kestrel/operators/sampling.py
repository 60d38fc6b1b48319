"""Reproducible splits, folds and negative sampling.

Every random choice is an MD5 hash of (key, seed): it does not depend on
partitioning or on the number of executors, survives recomputation after
executor loss, and an SQL engine with ``md5`` reproduces it exactly.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions.hashing import hash_bucket, hash_fraction
from kestrel.operators.joins import lookup_side
from kestrel.operators.ranking import blocked_prefix_sums, dense_index
from kestrel.session import scratch_path, shuffles_dropped, written


def split_column(key_cols: Sequence[str], weights: Sequence[float], seed: int) -> F.Column:
    """Index of the split a row falls in (0-based), from cumulative weights."""
    total = float(sum(weights))
    u = hash_fraction(*[F.col(c) for c in key_cols], seed)
    bounds, acc = [], 0.0
    for w in weights[:-1]:
        acc += w / total
        bounds.append(acc)
    expr = F.lit(len(weights) - 1)
    for i in reversed(range(len(bounds))):
        expr = F.when(u < F.lit(bounds[i]), F.lit(i)).otherwise(expr)
    return expr.cast("int")


def hash_split(df: DataFrame, weights: Sequence[float], seed: int, key_cols: Sequence[str]) -> list[DataFrame]:
    """``randomSplit`` with a partition-independent, reproducible rule."""
    return split_parts(df.withColumn("_split", split_column(key_cols, weights, seed)), len(weights))


def split_parts(tagged: DataFrame, n: int) -> list[DataFrame]:
    """The parts of rows whose split is known."""
    return [tagged.where(F.col("_split") == i).drop("_split") for i in range(n)]


def fold_column(key_cols: Sequence[str], k: int, seed: int) -> F.Column:
    """Fold number in ``[0, k)``."""
    return hash_bucket(k, *[F.col(c) for c in key_cols], seed).cast("int")


def k_folds(df: DataFrame, k: int, seed: int, key_cols: Sequence[str]) -> list[tuple[DataFrame, DataFrame]]:
    """k (training, validation) pairs; the validation folds partition the rows.

    The fold is computed once and the rows are written by fold, so that each
    of the 2 k reads prunes the other folders."""
    path = scratch_path(df.sparkSession, "folds")
    with shuffles_dropped(df.sparkSession):
        df.withColumn("_fold", fold_column(key_cols, k, seed)).write.partitionBy("_fold").parquet(path)
    schema = T.StructType([*df.schema.fields, T.StructField("_fold", T.IntegerType())])
    tagged = df.sparkSession.read.schema(schema).parquet(path)
    return [(tagged.where(F.col("_fold") != i).drop("_fold"), tagged.where(F.col("_fold") == i).drop("_fold"))
            for i in range(k)]


def _draw_rows(active: DataFrame, chunk: int) -> DataFrame:
    """Expand (user, start, end) into one row per draw number in (start, end].

    Ranges are first cut into chunks of at most ``chunk`` draws and the
    chunks are spread over the cluster, so no single row or task expands a
    hot user's whole range.  The chunk table is small in bytes but expands
    many times over, so it is spread over a fixed number of partitions (the
    session's shuffle partitions) instead of letting AQE coalesce it by
    its pre-expansion size.
    """
    n_chunks = F.ceil((F.col("_end") - F.col("_start")) / F.lit(chunk)).cast("int")
    chunks = active.select("*", F.explode(F.sequence(F.lit(0), n_chunks - 1)).alias("_c")) \
        .where(n_chunks > 0)
    parts = int(active.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = chunks.repartition(parts, "user", "_c")
    lo = F.col("_start") + F.col("_c") * F.lit(chunk) + 1
    hi = F.least(F.col("_end"), F.col("_start") + (F.col("_c") + 1) * F.lit(chunk))
    return chunks.select("*", F.explode(F.sequence(lo.cast("bigint"), hi.cast("bigint"))).alias("draw")) \
        .drop("_c")


@dataclass
class ItemIndex:
    """The items numbered by their order, for any number of draws: (item, idx), and how many there are."""
    rows: DataFrame
    n: int


def item_index(items: DataFrame) -> ItemIndex:
    """``items``: (item) distinct."""
    n = items.count()
    return ItemIndex(lookup_side(dense_index(items.select("item"), "item", "idx")) if n else items, n)


def negative_samples(positives: DataFrame, items: DataFrame | ItemIndex, seed: int,
                     first_batch_factor: float = 1.0, chunk: int = 100_000) -> DataFrame:
    """Per user, draw items uniformly from ``items`` (with replacement), skip
    the user's positives, and keep the first P non-positive draws, where P
    is the user's number of distinct positive items; a user stops after as
    many draws as there are items (X04).

    Draw d of user u is the item at position ``md5(u-d-seed) mod #items`` of
    the item list sorted by id.  Draws are generated in rounds: a round
    covers the draws that a user is expected to need (one in #items / P hits
    a positive) and a margin of four deviations, and only users still short
    of P negatives continue with a larger batch, until every user has P
    negatives or has used #items draws.  The result is therefore exactly
    "the first P non-positive draws among draws 1..#items", with work
    proportional to the draws needed.

    ``positives``: (user, item); ``items``: (item) distinct, or their index
    where several calls draw from the same items.
    Returns (user, item, draw).
    """
    spark = positives.sparkSession
    # read by the per-user targets, the anti-join and every round: written once
    pos = written(positives.select("user", "item").distinct(), "positives")
    index = items if isinstance(items, ItemIndex) else item_index(items)
    n_items = index.n
    if n_items == 0:
        return spark.createDataFrame([], "user int, item int, draw bigint")

    state = written(pos.groupBy("user").agg(F.count(F.lit(1)).alias("_p"))
                    .select("user", "_p", F.lit(0).cast("bigint").alias("_done"),
                            F.lit(0).cast("bigint").alias("_got")), "state")
    accepted_parts: list[DataFrame] = []
    factor = first_batch_factor
    while True:
        need = F.col("_p") - F.col("_got")
        hits = need * F.col("_p") / F.greatest(F.lit(n_items) - F.col("_p"), F.lit(1))
        batch = F.lit(factor) * (need + hits) + 4 * F.sqrt(hits) + F.lit(2)
        active = state.where((F.col("_got") < F.col("_p")) & (F.col("_done") < F.lit(n_items)))
        active = active.select("user", "_p", "_got", F.col("_done").alias("_start"),
                               F.least(F.lit(n_items), F.col("_done") + batch.cast("bigint")).alias("_end"))
        most = active.agg(F.max(F.col("_end") - F.col("_start"))).first()[0]
        if most is None and accepted_parts:
            break
        draws = _draw_rows(active, chunk)
        draws = draws.withColumn("idx", hash_bucket(n_items, F.col("user"), F.col("draw"), seed))
        cand = draws.join(index.rows, "idx").select("user", "item", "draw", "_p", "_got")
        cand = cand.join(pos, ["user", "item"], "left_anti")
        if (most or 0) <= chunk:  # no user has more rows than a block
            before = F.row_number().over(Window.partitionBy("user").orderBy("draw")) - 1
            ranked = cand.withColumn("_one_before", before)
        else:
            # ranking reads the candidates twice (blocks and rows): written once
            ranked = blocked_prefix_sums(written(cand, "candidates").withColumn("_one", F.lit(1)), "user", "draw", ["_one"], block=chunk)
        accepted = written(ranked.where(F.col("_got") + F.col("_one_before") < F.col("_p"))
                           .select("user", "item", "draw"), "accepted")
        accepted_parts.append(accepted)
        got = accepted.groupBy("user").agg(F.count(F.lit(1)).alias("_new"))
        state = (active.join(got, "user", "left")
                 .select("user", "_p", F.col("_end").alias("_done"),
                         (F.col("_got") + F.coalesce("_new", F.lit(0))).alias("_got")))
        state = written(state, "state")
        factor *= 2
    out = accepted_parts[0]
    for part in accepted_parts[1:]:
        out = out.unionByName(part)
    return out
