"""Gini trees and forests grown level by level.

All trees grow at once.  A level is one aggregate: the weight and the weight of the positive rows of every (tree, node, feature,
bin), summed map-side, so that the driver gets trees x nodes x features x bins numbers at any number of rows.  Bins: the values of a categorical
feature, the distinct values of a continuous one or, if it has more than ``bins``, its exact quantiles (distributed running counts).
A forest draws each row Poisson(1) times for each tree by a hash of its id, and a node's features by a hash of (tree, node,
feature); rows that a tree did not draw are its out-of-bag rows.  Everything is a function of the data, so any engine
can grow the same trees.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from hashlib import md5
from itertools import accumulate
from math import exp, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.functions.hashing import hash_fraction
from kestrel.operators.ranking import keyed_prefix_sums
from kestrel.session import cut_lineage

#: Chances of drawing a row at most 0, 1, 2, ... times.
POISSON = [round(p, 9) for p in accumulate(exp(-1) / factorial(k) for k in range(9))]
#: Decimals to which purities are compared: the order of sums must not decide between equal splits.
DIGITS = 9


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used and wherever Spark moves the expression."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _place(x: Column, ends: Sequence[float], reached: bool = False, first: int = 0) -> Column:
    """How many of the rising ``ends`` are below ``x`` (``reached``: or equal to it), by halves; null for null unless there are no ends."""
    if not ends:
        return F.lit(first)
    half = len(ends) // 2
    over = x >= ends[half] if reached else x > ends[half]
    return F.when(over, _place(x, ends[half + 1:], reached, first + half + 1)).when(~over, _place(x, ends[:half], reached, first))


@dataclass(frozen=True)
class Split:
    """Rows of a node go left if their bin is at most ``cut``, or of a categorical feature one of ``left``."""
    feature: str
    cut: int | None = None
    left: tuple[int, ...] = ()

    def goes_left(self, prefix: str = "b_") -> Column:
        b = F.col(prefix + self.feature)
        return b <= self.cut if self.cut is not None else b.isin(*self.left)


@dataclass
class Forest:
    features: tuple[str, ...]
    cuts: dict[str, list[float]]  # of the continuous features: upper ends of all bins but the last
    trees: int
    bagging: bool
    seed: int
    id_col: str
    splits: dict[tuple[int, int], Split] = field(default_factory=dict)  # (tree, node); the children of node n are 2n and 2n + 1
    positive: dict[tuple[int, int], bool] = field(default_factory=dict)  # whether most of a node's weight is

    def binned(self, df: DataFrame) -> DataFrame:
        bins = {}
        for f in self.features:
            value = F.round(F.col(f).cast("double"), 6)
            bins[f"b_{f}"] = _once(value, lambda x: _place(x, self.cuts[f])) if f in self.cuts else F.col(f).cast("int")
        return df.withColumns(bins)

    def weight(self, tree) -> Column:
        """How often a tree draws a row."""
        if not self.bagging:
            return F.lit(1)
        return _once(hash_fraction(F.col(self.id_col), tree, self.seed), lambda u: _place(u, POISSON, reached=True))

    def node(self, tree: int) -> Column:
        """The node of the tree that a binned row comes to."""
        return self._below(tree, 1, lambda node: F.lit(node))

    def vote(self, tree: int) -> Column:
        return self._below(tree, 1, lambda node: F.lit(int(self.positive.get((tree, node), False))))

    def _below(self, tree: int, node: int, leaf) -> Column:
        split = self.splits.get((tree, node))
        if split is None:
            return leaf(node)
        return F.when(split.goes_left(), self._below(tree, 2 * node, leaf)).otherwise(self._below(tree, 2 * node + 1, leaf))

    def votes(self, df: DataFrame) -> DataFrame:
        """``df`` with ``votes`` (trees for the positive class) and ``prediction`` (1.0 if more than half are)."""
        out = self.binned(df).withColumn("votes", sum((self.vote(t) for t in range(self.trees)), F.lit(0)))
        return out.withColumn("prediction", (2 * F.col("votes") > self.trees).cast("double")).drop(*[f"b_{f}" for f in self.features])

    def out_of_bag(self, df: DataFrame, label: str) -> DataFrame:
        """One row (n, wrong): the rows that some tree did not draw, judged by those trees alone; one aggregate."""
        free = [self.weight(t) == 0 for t in range(self.trees)]
        judged = self.binned(df).select(label, sum((x.cast("int") for x in free), F.lit(0)).alias("judges"),
                                        sum(((x & (self.vote(t) == 1)).cast("int") for t, x in enumerate(free)), F.lit(0)).alias("votes"))
        wrong = (2 * F.col("votes") > F.col("judges")) != (F.col(label) == 1)
        return judged.where("judges > 0").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(wrong.cast("long")), F.lit(0)).alias("wrong"))

    def rows(self) -> list[tuple]:
        """The trees as (tree, node, feature, upper end or None, categories or None, positive)."""
        out = []
        for (tree, node), positive in sorted(self.positive.items()):
            s = self.splits.get((tree, node))
            upper = None if s is None or s.cut is None or s.cut >= len(self.cuts[s.feature]) else self.cuts[s.feature][s.cut]
            out.append((tree, node, s and s.feature, upper, list(s.left) if s and s.cut is None else None, positive))
        return out


def quantile_cuts(df: DataFrame, col: str, bins: int) -> list[float]:
    """Upper ends of at most ``bins`` bins of the values of ``col`` (to 6 decimals): every value its own, or exact quantiles."""
    counts = cut_lineage(df.groupBy(F.round(F.col(col).cast("double"), 6).alias("v")).agg(F.count(F.lit(1)).alias("n")))
    distinct, total = counts.agg(F.count(F.lit(1)), F.sum("n")).first()
    if distinct <= bins:
        return sorted(r.v for r in counts.collect())
    sums = keyed_prefix_sums(counts.withColumn("all", F.lit(0)), "all", "v", ["n"])
    share = lambda upto: F.floor(upto * F.lit(bins) / F.lit(total))
    ends = sums.where(share(F.col("n_before")) != share(F.col("n_before") + F.col("n")))
    return sorted(r.v for r in ends.select("v").collect())  # at most ``bins``


def allowed(features: Sequence[str], subset: int | None, tree: int, node: int, seed: int) -> list[str]:
    """The features a node may use: the ``subset`` with the smallest MD5 of tree-node-feature-seed."""
    if subset is None or subset >= len(features):
        return list(features)
    drawn = sorted(features, key=lambda f: md5(f"{tree}-{node}-{f}-{seed}".encode()).hexdigest())[:subset]
    return [f for f in features if f in drawn]


def purity(n: float, n1: float) -> float:
    """Rows times (1 - gini): the larger the sum over the children, the better the split."""
    return (n1 * n1 + (n - n1) * (n - n1)) / n


def best_split(stats: Mapping[str, list[tuple[int, int, int]]], features: Sequence[str], continuous: Mapping) -> Split | None:
    """The purest split of a node: of equal ones that of the first feature, then the first place.

    ``stats``: per feature (bin, n, n1).  Continuous bins are in order, categories in that of their share of
    positives, so that the best set of categories is a prefix.
    """
    best, found = None, None
    for f in features:
        rows = sorted(stats[f], key=lambda r: r[0] if f in continuous else (r[2] / r[1], r[0]))
        total, ones = sum(r[1] for r in rows), sum(r[2] for r in rows)
        n = n1 = 0
        for place, (b, k, k1) in enumerate(rows[:-1]):
            n, n1 = n + k, n1 + k1
            score = round(purity(n, n1) + purity(total - n, ones - n1), DIGITS)
            if score > round(purity(total, ones), DIGITS) and (best is None or score > best):
                best = score
                found = Split(f, cut=b) if f in continuous else Split(f, left=tuple(sorted(r[0] for r in rows[:place + 1])))
    return found


def grow_forest(df: DataFrame, id_col: str, features: Sequence[str], label: str, continuous: Sequence[str], trees: int = 1, depth: int = 3,
                bins: int = 32, bagging: bool = False, subset: int | None = None, seed: int = 1) -> Forest:
    """A single tree by default: all rows once, all features."""
    cuts = {f: quantile_cuts(df, f, bins)[:-1] for f in features if f in continuous}
    forest = Forest(tuple(features), cuts, trees, bagging, seed, id_col)
    bins_of = [f"b_{f}" for f in features]
    rows = forest.binned(df).select(id_col, F.col(label).cast("int").alias("y"), *bins_of)
    drawn = rows.withColumn("tree", F.explode(F.array(*[F.lit(t) for t in range(trees)]))).withColumn("w", forest.weight(F.col("tree")))
    # a tree knows of its rows no more than the bins and the label: rows alike in these are one row of their weight at all levels
    cells = cut_lineage(drawn.groupBy("tree", "y", *bins_of).agg(F.sum("w").alias("w")).where("w > 0"))
    slots = ", ".join(f"'{f}', b_{f}" for f in features)
    for level in range(depth + 1):
        node = F.coalesce(*[F.when(F.col("tree") == t, forest.node(t)) for t in range(trees)])
        open_rows = cells.withColumn("node", node).where(F.col("node") >= 1 << level)
        counts = open_rows.selectExpr("tree", "node", "w", "y", f"stack({len(features)}, {slots}) as (feature, bin)") \
            .groupBy("tree", "node", "feature", "bin").agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("y")).alias("n1"))
        stats: dict[tuple[int, int], dict[str, list]] = {}
        for r in counts.collect():  # trees x nodes x features x bins
            stats.setdefault((r.tree, r.node), {}).setdefault(r.feature, []).append((r.bin, r.n, r.n1))
        for (tree, at), own in stats.items():
            n, n1 = (sum(r[i] for r in own[features[0]]) for i in (1, 2))
            forest.positive[tree, at] = 2 * n1 > n
            if level < depth:
                split = best_split(own, allowed(features, subset, tree, at, seed), cuts)
                if split is not None:
                    forest.splits[tree, at] = split
    return forest
