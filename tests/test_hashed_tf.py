from pyspark.sql import functions as F

from kestrel.functions.hashing import jvm_hash_index
from kestrel.operators import features
from kestrel.operators.features import hashed_tf, token_rows

ROWS = [(1, "a b  a"), (1, "b zz"), (2, ""), (3, "   "), (4, None), (None, "x y"), (None, "x"), (5, " lead  and trail   "),
        (6, "\U0001F600 \u00e9t\u00e9 \u6f22\u5b57 tab\there"), (7, "polygenelubricants " + "long" * 5000), (8, "a" * 40 + " " + "\uffff" * 9)]


def test_slots_are_those_of_the_single_tokens(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(3)
    want = (token_rows(df).groupBy("doc_id", jvm_hash_index(F.col("token"), 1000).alias("idx"))
            .agg(F.count(F.lit(1)).cast("double").alias("tf")))
    got = hashed_tf(df, 1000)
    assert got.schema.simpleString() == want.schema.simpleString()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key)
    assert hashed_tf(df.where("doc_id = 3")).count() == 0


def test_one_shuffle_and_no_row_per_token(spark, monkeypatch):
    def rows(*args):
        raise AssertionError("tokens as rows")

    monkeypatch.setattr(features, "token_rows", rows)
    plan = hashed_tf(spark.createDataFrame(ROWS, "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Generate" not in plan
