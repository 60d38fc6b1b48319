import random

import pytest
from pyspark.sql import functions as F

from kestrel.llm.linking import connected, link_buckets, shared_buckets


def components(pairs):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("pairs", [[(1, 2), (2, 3), (5, 4)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 40)], [(7, 7)], []])
def test_components(spark, pairs):
    df = spark.createDataFrame(pairs, "a long, b long")
    assert {r.id: r.comp for r in connected(df).collect()} == components([p for p in pairs if p[0] != p[1]])


def test_random_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(150)]
    got = {r.id: r.comp for r in connected(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == components([p for p in pairs if p[0] != p[1]])


@pytest.mark.parametrize("size,reach", [(12, 3), (60, 4), (40, 1000), (40, 0)])
def test_no_link_of_a_bucket_is_lost(spark, size, reach):
    """Numbers in a bucket, linked if they differ by ``reach`` or less: chains that no single pivot sees."""
    rng = random.Random(size)
    values = {f"{i:03d}": rng.randrange(200) for i in range(size)}
    table = spark.createDataFrame(list(values.items()), "id string, v long")
    seen = []

    def verify(pairs):
        seen.append(pairs.count())
        a = table.select(F.col("id").alias("a"), F.col("v").alias("x"))
        b = table.select(F.col("id").alias("b"), F.col("v").alias("y"))
        return pairs.join(a, "a").join(b, "b").where(F.abs(F.col("x") - F.col("y")) <= reach)

    members = spark.createDataFrame([(k, i) for i in values for k in (1, 2)] + [(9, "alone")], "key long, id string")
    got = {r.id: r.comp for r in link_buckets(shared_buckets(members), verify).collect()}
    ids = list(values)
    want = components([(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if abs(values[a] - values[b]) <= reach])
    assert got == want
    if reach >= 1000:
        assert sum(seen) < 4 * size  # copies cost a few passes, not all pairs
