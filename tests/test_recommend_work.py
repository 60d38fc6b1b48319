"""Work that the recommender's queries no longer do twice or for nothing."""

import numpy as np
from pyspark.sql import functions as F

from kestrel.functions.scalars import parse_int_strict
from kestrel.operators import factors, sampling
from kestrel.plans import q_models, q_relational


def test_draws_follow_the_negatives_needed(spark, monkeypatch):
    """A user with two positives among many items draws about two negatives, not twenty more."""
    asked = []
    real = sampling._draw_rows

    def counted(active, chunk):
        asked.append(active.agg(F.sum(F.col("_end") - F.col("_start"))).first()[0])
        return real(active, chunk)

    monkeypatch.setattr(sampling, "_draw_rows", counted)
    positives = spark.range(200).selectExpr("cast(id div 2 as int) as user", "cast(id % 2 as int) as item")
    items = spark.range(5000).selectExpr("cast(id as int) as item")
    got = sampling.negative_samples(positives, items, 7)
    assert {r["count"] for r in got.groupBy("user").count().collect()} == {2}
    assert sum(x or 0 for x in asked) <= 100 * 2 * 3


def test_an_index_of_items_serves_several_draws(spark):
    positives = spark.createDataFrame([(u, i) for u in range(5) for i in range(u, u + 4)], "user int, item int")
    items = spark.range(12).selectExpr("cast(id as int) as item")
    index = sampling.item_index(items)
    for seed in (1, 2):
        assert sorted(map(tuple, sampling.negative_samples(positives, index, seed).collect())) == \
            sorted(map(tuple, sampling.negative_samples(positives, items, seed, chunk=2).collect()))


def test_the_split_is_computed_once(spark, monkeypatch):
    rows = spark.createDataFrame([(u, i, 1 + u % 3, float(1 + u % 3)) for u in range(20) for i in range(9)], "user int, item int, cnt int, rating double")
    monkeypatch.setattr(q_relational.D, "ratings", lambda *_: rows)
    every, train, held = q_relational.rating_split(spark, "")
    want = sampling.hash_split(rows, q_relational.RATING_SPLIT, q_relational.RATING_SEED, ["user", "item", "cnt"])
    assert [sorted(map(tuple, x.collect())) for x in (every, train, held)] == [sorted(map(tuple, x.collect())) for x in (rows, *want)]
    assert all("md5" not in x._jdf.queryExecution().toString() for x in (train, held))


def test_the_heaviest_user_comes_from_the_ratings(spark, monkeypatch):
    rows = spark.createDataFrame([(1, 1, 1, 1.0), (3, 1, 1, 1.0), (3, 2, 1, 1.0), (2, 1, 1, 1.0), (2, 2, 1, 1.0)], "user int, item int, cnt int, rating double")

    def parsed_again(*_):
        raise AssertionError("the play lines are parsed again")

    monkeypatch.setattr(q_models.D, "ratings", lambda *_: rows)
    monkeypatch.setattr(q_models.D, "plays", parsed_again)
    monkeypatch.setattr(q_models.D, "items", lambda *_: None)
    monkeypatch.setattr(q_models.rec, "fit_als", lambda _: None)
    monkeypatch.setattr(q_models.rec, "spot_check", lambda spark, model, ratings, items, user: user)
    assert [r.user for r in q_models.q_spot_check(spark, "").collect()] == [2]


def test_best_of_many_rows_at_once():
    rng = np.random.default_rng(3)
    scores, ids = rng.integers(0, 6, (50, 17)).astype(float), rng.permutation(17) * 3
    least = rng.integers(-1, 7, 50).astype(float)
    for k in (1, 4, 17, 20):
        row, at = factors._best(scores, ids, k, least)
        for i in range(50):
            want = [j for j in sorted(range(17), key=lambda j: (-scores[i, j], ids[j])) if scores[i, j] >= least[i]][:k]
            assert at[row == i].tolist() == want


def test_strict_integers_at_line_ends(spark):
    texts = ["12", "+7", "-0", "2147483648", "1\n", "1 ", " 1", "1\t", "1.", ".5", "1,2", "+", "", "1\x7f", "\x7f1", None]
    frame = spark.createDataFrame([(t,) for t in texts], "s string")
    pattern = F.when(F.col("s").rlike(r"^[+-]?[0-9]+$"), F.col("s").try_cast("int"))
    got = frame.select(parse_int_strict("s").alias("x"), pattern.alias("y")).collect()
    assert [r.x for r in got] == [r.y for r in got] and [r.x for r in got][:4] == [12, 7, 0, None]
