"""Classes of similar things from buckets, without all pairs of a bucket.

``connected`` labels components by alternating large and small stars.
``link_buckets`` verifies pairs bucket by bucket in rounds: some pivots of a bucket
meet its members in other components, links join components, and the next pivots
come from outside the bucket's largest component.  A bucket is done when all
its members are in one component or every one outside the largest was a pivot; then every
pair of it is verified, or connected by verified links already.  Two or three
members are done in one round; a large group of copies in few, because what is
connected meets no more; only members that resemble nothing in their bucket cost a
pass each.  Each verified pair is a row of a join, so no task holds a bucket.
``link_filtered`` goes by the same rounds, meets only those that a filter lets pass, and picks pivots by partial
aggregates.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import bounded, fits, hinted, materialise

#: Pivots of a bucket in the first round; a round has four times as many as the one before.
PIVOTS = 2


def connected(links: DataFrame) -> DataFrame:
    """(a, b) links -> (id, comp): ``comp`` is the least id of the component.

    Sides of joins are broadcast while the written edges are within the bound.
    """
    ids = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = materialise(ids.distinct(), "edges")
    while True:
        side = F.broadcast if fits(edges) else lambda df: df
        # a forest of stars: no centre hangs on another node, no node on two
        chained = edges.join(side(edges.select(F.col("b").alias("a"))), "a", "left_semi")
        if chained.isEmpty() and edges.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            return materialise(edges.select(F.col("a").alias("id"), F.col("b").alias("comp")).unionByName(
                edges.select(F.col("b").alias("id"), F.col("b").alias("comp")).distinct()), "comp")
        # large star: larger neighbours hang on the least neighbour
        both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(side(least), "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        # small star: smaller neighbours and the node itself hang on the least of them
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(side(least), "a").select(F.explode(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))).alias("e"))
        edges = materialise(hung.select("e.a", "e.b").where("a <> b").distinct(), "edges")


def shared_buckets(members: DataFrame, *carried: str) -> DataFrame:
    """The (key, id, *carried) rows, each given once, of the keys with two ids or more; ``n``: ids of the key."""
    rows = members.select("key", "id", *carried)
    several = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return rows.join(bounded(several, "shared-keys", factor=3), "key")


def link_buckets(members: DataFrame, verify: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Written (key, id, n) -> (id, comp) of the ids that have a link.

    ``verify`` takes pairs (a, b) with a < b and returns those that are linked.
    Pivots are the members that meet most others over all buckets: of a group of
    copies the one that most resemble.  Sides of joins that are written, or parts of
    what is, are broadcast while they are within the bound.
    """
    side = F.broadcast if fits(members) else lambda df: df
    degrees = members.groupBy("id").agg(F.sum("n").alias("degree"))
    members = materialise(members.join(side(degrees), "id"), "members")
    pivoted = pairs_done = links = comp = None
    pivots_a_bucket = PIVOTS
    while True:
        if comp is None:
            rows = members.withColumn("comp", F.col("id"))
            outside = rows
        else:
            rows = members.join(hinted(comp), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
            sizes = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("m")).groupBy("key").agg(
                F.count(F.lit(1)).alias("parts"), F.max(F.struct("m", "comp")).alias("main"))
            split = bounded(sizes.where("parts > 1").select("key", F.col("main.comp").alias("main")), "open")
            rows = materialise(rows.join(split, "key"), "open-rows")
            outside = rows.where("comp <> main").join(hinted(pivoted), ["key", "id"], "left_anti")
        best = Window.partitionBy("key").orderBy(F.desc("degree"), "id")
        ranked = outside.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= pivots_a_bucket)
        pivots = materialise(ranked.select("key", F.col("id").alias("pivot"), F.col("comp").alias("own")), "pivots")
        if pivots.isEmpty():
            return comp if comp is not None else members.select("id", F.col("id").alias("comp")).limit(0)
        met = rows.select("key", "id", "comp").join(hinted(pivots), "key").where("comp <> own")
        pairs = met.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()
        if pairs_done is not None:
            pairs = pairs.join(hinted(pairs_done), ["a", "b"], "left_anti")
        pairs = materialise(pairs, "pairs")
        good = materialise(verify(pairs).select("a", "b"), "links")
        more = pivots.select("key", F.col("pivot").alias("id"))
        pivoted = more if pivoted is None else materialise(pivoted.unionByName(more), "pivoted")
        pairs_done = pairs if pairs_done is None else materialise(pairs_done.unionByName(pairs), "pairs-done")
        if not good.isEmpty():
            links = good if links is None else materialise(links.unionByName(good), "links")
            comp = connected(links)
        elif comp is None:
            comp = materialise(members.select("id", F.col("id").alias("comp")).limit(0), "comp")
        pivots_a_bucket *= 4


def link_filtered(members: DataFrame, carried: list[str], may_link: Column, verify: Callable[[DataFrame], DataFrame],
                  links: DataFrame, pivots_a_bucket: int = PIVOTS, more: int = 4) -> DataFrame:
    """Written (key, id, *carried) and links (a, b) known before -> all links found, those included.

    A pivot meets the members of its bucket in other components for which ``may_link`` holds; it reads the member's
    ``carried`` columns and the pivot's under ``pivot_`` and the same names.  Pivots come from outside the
    bucket's largest component, those that meet most ids first, one of each of some hash groups of a bucket.  A bucket is done
    when all its members outside its largest component were pivots: each of its pairs is then verified, ruled out or connected.
    The first round has ``pivots_a_bucket`` pivots, each other ``more`` times as many as the one before.
    """
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    rows = materialise(members.join(bounded(sizes, "bucket-sizes", factor=3), "key"), "buckets")
    degrees = rows.groupBy("id").agg(F.sum("size").alias("degree"))
    rows = materialise(rows.drop("size").join(hinted(degrees, rows), "id"), "buckets")
    found, asked, pivoted, comp = [links], [], [], connected(links)
    while True:
        rows = rows.drop("comp").join(hinted(comp), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
        parts = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("rows")).groupBy("key").agg(
            F.count(F.lit(1)).alias("parts"), F.max(F.struct("rows", "comp")).alias("main"))
        split = bounded(parts.where("parts > 1").select("key", F.col("main.comp").alias("main")), "open-buckets")
        rows = materialise(rows.join(split, "key"), "open-rows")
        outside = rows.where("comp <> main")
        rows = rows.drop("main")
        if pivoted:
            outside = outside.join(bounded(reduce(DataFrame.unionByName, pivoted), "pivoted"), ["key", "id"], "left_anti")
        group = F.pmod(F.xxhash64("id"), F.lit(pivots_a_bucket))
        best = outside.groupBy("key", group.alias("g")).agg(F.max(F.struct("degree", "id", "comp", *carried)).alias("x"))
        pivots = materialise(best.select("key", F.col("x.id").alias("pivot"), F.col("x.comp").alias("own"),
                                         *[F.col(f"x.{c}").alias(f"pivot_{c}") for c in carried]), "pivots")
        if pivots.isEmpty():
            return reduce(DataFrame.unionByName, found)
        pivoted.append(pivots.select("key", F.col("pivot").alias("id")))
        met = rows.join(hinted(pivots), "key").where((F.col("comp") != F.col("own")) & may_link)
        pairs = met.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()
        if asked:
            pairs = pairs.join(bounded(reduce(DataFrame.unionByName, asked), "asked"), ["a", "b"], "left_anti")
        pairs = materialise(pairs, "pairs")
        asked.append(pairs)
        good = materialise(verify(pairs).select("a", "b"), "links")
        if not good.isEmpty():
            found.append(good)
            comp = connected(good.unionByName(comp.select(F.col("id").alias("a"), F.col("comp").alias("b"))))
        pivots_a_bucket *= more
