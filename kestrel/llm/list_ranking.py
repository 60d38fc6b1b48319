"""Ranking of one linked list that is spread over a cluster.

``prefix_sums`` contracts the list until it fits in a block and expands it again.  A step cuts dense ids into
blocks of ``block`` elements; the runs that stay inside a block shrink to their heads.  Lists whose
neighbours mostly have near ids shrink to a few elements a block at once.  Where
that leaves more than half, elements drawn by a coin are taken up by their predecessors instead, a
quarter of them on average, so the steps end for any list.  No task has more than a block of elements.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.llm.common import materialise
from kestrel.operators.ranking import dense_index

BLOCK = 1 << 10
_RUNS = "id long, head long, before array<long>, beyond long, total array<long>"


def _contract(table: pa.Table) -> pa.Table:
    """A block's runs: each element's head and what its run has before it; of a run's last element where the list
    goes on (-1: it ends) and the run's total."""
    ids, succ = table["id"].to_numpy(), table["next"].fill_null(-1).to_numpy()
    w = np.array(table["w"].to_pylist(), np.int64).reshape(len(ids), -1)
    order = np.argsort(ids)
    ids, succ, w = ids[order], succ[order], w[order]
    at = np.minimum(np.searchsorted(ids, succ), len(ids) - 1)
    inside = ids[at] == succ
    head = np.arange(len(ids))
    head[at[inside]] = np.flatnonzero(inside)  # now each element's predecessor in the block, or itself
    before = np.zeros_like(w)
    before[at[inside]] = w[inside]
    while (head[head] != head).any():
        before += before[head]
        head = head[head]
    total = np.where(inside[:, None], 0, before + w)
    return pa.table([pa.array(ids), pa.array(ids[head]), pa.array(list(before), pa.list_(pa.int64())),
                     pa.array(np.where(inside, -2, succ)), pa.array(list(total), pa.list_(pa.int64()))],
                    ["id", "head", "before", "beyond", "total"])


def _plus(a, b):
    return F.zip_with(a, b, lambda x, y: x + y)


def _by_coin(items: DataFrame, step: int) -> DataFrame:
    """As ``_contract``: an element with a one whose predecessor has a zero joins that one's run."""
    coin = F.xxhash64("id", F.lit(step)).bitwiseAND(F.lit(1))
    tossed = items.withColumn("one", coin == 1)
    first = tossed.where("not one").select(F.col("id").alias("head"), F.col("next").alias("id"), F.col("w").alias("w0"))
    none = F.transform("w", lambda x: F.lit(0).cast("long"))
    taken = tossed.where("one").join(first.where("id is not null"), "id").select(
        "id", "head", F.col("w0").alias("before"), F.coalesce("next", F.lit(-1)).alias("beyond"), _plus(F.col("w0"), F.col("w")).alias("total"))
    rest = tossed.join(taken.select("id"), "id", "left_anti")
    ahead = taken.select(F.col("head").alias("id"), F.lit(True).alias("more"))
    rest = rest.join(ahead, "id", "left").select(
        "id", F.col("id").alias("head"), none.alias("before"),
        F.when(F.col("more"), F.lit(-2)).otherwise(F.coalesce("next", F.lit(-1))).alias("beyond"), F.when(F.col("more"), none).otherwise(F.col("w")).alias("total"))
    return rest.unionByName(taken)


def prefix_sums(items: DataFrame, block: int = BLOCK) -> DataFrame:
    """(id, next, w: array) of one list, ids from 0 without gaps, null ``next`` at its end -> (id, before): the
    sums of ``w`` over all elements before each."""
    items = materialise(items.select("id", "next", "w"), "list")
    n, levels = items.count(), []
    while True:
        number = F.floor(F.col("id") / F.lit(block)).cast("long")
        runs = materialise(items.groupBy(number.alias("block")).applyInArrow(_contract, _RUNS), "runs")
        left = runs.where("beyond <> -2").count()
        if 2 * left > n > block:
            runs = materialise(_by_coin(items, len(levels)), "runs")
            left = runs.where("beyond <> -2").count()
        levels.append(runs)
        if left <= 1:
            break
        heads = runs.where("beyond <> -2").select("head", "beyond", F.col("total").alias("w"))
        heads = materialise(dense_index(heads, "head", "id"), "heads")
        where = heads.select(F.col("head").alias("beyond"), F.col("id").alias("next"))
        items = materialise(heads.join(where, "beyond", "left").select("id", "next", "w", F.col("head").alias("lower")), "list")
        levels.append(items.select("id", "lower"))
        items = items.select("id", "next", "w")
        n = left
    out = None
    for level in reversed(levels):
        if "lower" in level.columns:  # ids of the contracted list are heads of the one below
            out = out.join(level, "id").select(F.col("lower").alias("head"), F.col("before").alias("above"))
        elif out is None:
            out = level.select("id", "before")
        else:
            out = materialise(level.join(out, "head").select("id", _plus(F.col("before"), F.col("above")).alias("before")), "sums")
    return out if out is not None else items.select("id", F.col("w").alias("before"))
