import random

import pandas as pd
from pyspark.sql import functions as F

from kestrel.operators.ranking import blocked_prefix_sums, dense_index, keyed_prefix_sums, top_k_per_key


def test_dense_index_is_global_rank(spark):
    vals = random.Random(1).sample(range(100000), 3000)
    df = spark.createDataFrame([(v,) for v in vals], "item int")
    want = {v: i for i, v in enumerate(sorted(vals))}
    assert {r.item: r.idx for r in dense_index(df, "item").collect()} == want
    assert {r.item: r.idx for r in dense_index(df, "item").collect()} == want


def test_keyed_prefix_sums_with_hot_key(spark):
    rnd = random.Random(2)
    rows = [(0, i, rnd.randint(0, 3)) for i in range(4000)]          # one hot key: most rows
    rows += [(k, i, rnd.randint(0, 3)) for k in range(1, 60) for i in range(rnd.randint(1, 30))]
    df = spark.createDataFrame(rows, "k int, o int, v int")
    pdf = pd.DataFrame(rows, columns=["k", "o", "v"]).sort_values(["k", "o"])
    pdf["want"] = pdf.groupby("k")["v"].cumsum() - pdf["v"]
    for hot_rows in (0, 100, 1_000_000):      # all range form / hybrid / all window form
        got = keyed_prefix_sums(df, "k", "o", ["v"], num_partitions=7, hot_rows=hot_rows).toPandas()
        m = got.merge(pdf, on=["k", "o", "v"])
        assert len(m) == len(rows) == len(got)
        assert (m["v_before"] == m["want"]).all()


def test_blocked_prefix_sums(spark):
    rnd = random.Random(4)
    rows = [(k, d, rnd.randint(0, 1)) for k in range(5) for d in range(1, (3000 if k == 0 else 40) + 1)]
    df = spark.createDataFrame(rows, "k int, d long, v int")
    got = blocked_prefix_sums(df, "k", "d", ["v"], block=64).toPandas()
    pdf = pd.DataFrame(rows, columns=["k", "d", "v"]).sort_values(["k", "d"])
    pdf["want"] = pdf.groupby("k")["v"].cumsum() - pdf["v"]
    m = got.merge(pdf, on=["k", "d", "v"])
    assert len(m) == len(rows) and (m["v_before"] == m["want"]).all()


def test_top_k_per_key(spark):
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 5), i, float(rnd.randint(0, 20))) for i in range(2000)]
    df = spark.createDataFrame(rows, "user int, item int, score double")
    got = top_k_per_key(df, "user", 5, [F.desc("score"), F.asc("item")], ["item"], salts=4).toPandas()
    pdf = pd.DataFrame(rows, columns=["user", "item", "score"]).sort_values(
        ["user", "score", "item"], ascending=[True, False, True])
    want = pdf.groupby("user").head(5)
    assert sorted(zip(got.user, got.item)) == sorted(zip(want.user, want.item))
