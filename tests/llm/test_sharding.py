import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.llm.sharding import minimax_cuts, minimax_shards, op9_minimax_shards, running_sums

SCHEMA = "doc_id long, text string, size string, shard string, key int"


def least(sizes, n):
    """Smallest capacity by trying every contiguous partition (dynamic programme)."""
    best = {0: 0}
    for _ in range(n):
        best = {j: min([max(best[i], sum(sizes[i:j])) for i in range(j + 1) if i in best]) for j in range(len(sizes) + 1)}
    return best[len(sizes)]


@pytest.mark.parametrize("sizes,n,cells", [([5, 1, 1, 9, 2, 2, 7], 3, 4), ([1] * 30, 7, 3), ([100, 1, 1], 2, 2),
                                           ([3], 4, 8), (list(range(1, 40)), 24, 5)])
def test_capacity_is_the_least(spark, sizes, n, cells):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(sizes)], "i long, s long")
    sums = running_sums(df, "s", [F.col("i")]).cache()
    capacity, cuts = minimax_cuts(sums, n, sum(sizes), max(sizes), cells)
    assert capacity == least(sizes, n)
    assert cuts[-1] == sum(sizes) and len(cuts) <= n
    assert all(b - a <= capacity for a, b in zip([0] + cuts, cuts))


def test_random_sizes_with_few_cells(spark):
    rng = random.Random(5)
    sizes = [rng.choice([1, 3, 10, 200]) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(sizes)), "i long, s long")
    sums = running_sums(df, "s", [F.col("i")]).cache()
    assert minimax_cuts(sums, 6, sum(sizes), max(sizes), 3)[0] == least(sizes, 6)


def check(rows, docs, n):
    shards = defaultdict(list)
    where = {}
    for r in rows:
        shards[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in shards.values())
    assert max(shards) < n
    by_text = defaultdict(set)
    for d, t in docs:
        by_text[t or ""].add(d)
    for r in rows:
        where.setdefault(r.doc_id, set()).add(r.shard)
    for ids in by_text.values():
        assert len(set().union(*(where[i] for i in ids))) == 1
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in docs)


def test_nulls_ties_copies_and_clashing_columns(spark):
    docs = [(1, None), (2, ""), (None, "x"), (4, "x"), (5, "long " * 9000), (6, "é"), (6, "é"), (7, "x")] + [
        (i, f"text {i}") for i in range(10, 60)]
    df = spark.createDataFrame([(*d, "a", "b", 3) for d in docs], SCHEMA)
    check(minimax_shards(df, 5, cells=4).collect(), docs, 5)


def test_empty_table(spark):
    assert minimax_shards(spark.createDataFrame([], SCHEMA), 24).count() == 0


def test_query_on_whole_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    out = op9_minimax_shards(spark, sf)
    rows = out.collect()
    check(rows, docs, 24)
    assert {r.law for r in rows} == {"bytes"} and out.schema["grown_shard"].dataType == T.IntegerType()
    first, size = {}, Counter()
    for d, t in docs:
        first[t or ""] = min(d, first.get(t or "", d))
        size[t or ""] += len((t or "").encode()) + 8
    sizes = [size[t] for t in sorted(first, key=first.get)]
    got = Counter()
    for r in rows:
        got[r.shard] += r.size
    low, high = max(sizes), sum(sizes)
    while low < high:
        mid, n, at = (low + high) // 2, 1, 0
        for s in sizes:
            n, at = (n + 1, s) if at + s > mid else (n, at + s)
        low, high = (low, mid) if n <= 24 else (mid + 1, high)
    assert max(got.values()) == low
