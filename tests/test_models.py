import pytest
from pyspark.sql import functions as F

from kestrel.operators import classify
from kestrel.operators.features import RECIPES, prepare
from kestrel.plans import derived as D

from testdata_paths import SF_SMALL

def test_text_model_learns_the_labels(spark):
    """Fitted on the labelled documents, the model separates them far better than the larger class."""
    from kestrel.plans.fixtures import view
    rng = __import__("random").Random(4)
    good, bad = ["harvest", "orchard", "meadow", "river"], ["jackpot", "lottery", "winner", "prize"]
    rows = [(i, " ".join(rng.choice(bad if i % 3 == 0 else good) for _ in range(12)), float(i % 3 == 0)) for i in range(90)]
    train = spark.createDataFrame(rows[:60], "doc_id long, text string, label double")
    model, tf = classify.text_classifier(train)
    held = spark.createDataFrame(rows[60:], "doc_id long, text string, label double")
    got = classify.score_texts(model, tf, held).collect()
    assert all(r.prediction == r.label for r in got)
    assert view(spark, SF_SMALL, "messages").count() > 0


@pytest.fixture(scope="module")
def passengers(spark):
    return D.passengers(spark, SF_SMALL).persist()


def test_classifier_scores_every_test_row(spark, passengers):
    recipe = RECIPES["class_gender_sibsp_parch_fare"]
    res = classify.run_classifier(prepare(passengers, recipe), recipe, "lr")
    n_test = passengers.where(F.col("part") == "test").count()
    assert res.predictions.count() == n_test
    assert set(r.Survived for r in res.predictions.collect()) <= {0, 1}
    v = res.validation.collect()[0]
    assert 0.0 <= v.error_rate <= 1.0 and abs(v.precision - v.accuracy) < 1e-12


def test_tree_uses_categorical_splits(spark, passengers):
    recipe = RECIPES["class_gender_family"]
    res = classify.run_classifier(prepare(passengers, recipe), recipe, "dt")
    assert " in {" in res.model.toDebugString


def test_forest_seeded_is_repeatable(spark, passengers):
    recipe = RECIPES["class_gender_fare"]
    a = classify.run_classifier(prepare(passengers, recipe), recipe, "rf").predictions
    b = classify.run_classifier(prepare(passengers, recipe), recipe, "rf").predictions
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_segmented_models_route_by_gender(spark, passengers):
    recipe = RECIPES["class_gender_family"]
    res = classify.run_classifier(prepare(passengers, recipe), recipe, "lr", segment="Gender")
    assert {r.segment for r in res.model.table.collect()} == {0.0, 1.0}
    assert res.predictions.count() == passengers.where(F.col("part") == "test").count()


def test_numeric_model_minimises_its_objective(spark):
    # fixed values: four parsed rows and the recorded prediction of one of the two test rows (1.0; the
    # other one's 0.0 came from a descent that stopped early, see the README)
    import numpy as np
    from pyspark.ml.linalg import Vectors
    from kestrel.sources.catalog import rows_to_table
    rows = [(1.0, Vectors.dense([12.0, 15.0])), (1.0, Vectors.dense([17.0, 34.0])),
            (1.0, Vectors.dense([56.0, 67.0])), (0.0, Vectors.dense([24.0, 45.0]))]
    model = classify._fit("lr_sgd", rows_to_table(spark, rows, ["label", "features"]), tol=1e-12)
    test = rows_to_table(spark, [(2, Vectors.dense([14.0, 16.2]))], ["id", "features"])
    assert [r.prediction for r in model.transform(test).collect()] == [1.0]
    w, x, y = model.coefficients.toArray(), np.array([r[1].toArray() for r in rows]), np.array([r[0] for r in rows])
    p = 1 / (1 + np.exp(-x @ w))
    assert np.allclose(x.T @ (p - y) / len(y) + 0.01 * w, 0, atol=1e-4)


def test_als_large_ids_are_reindexed(spark):
    from kestrel.operators import recommend as rec
    big = 2 ** 33
    rows = [(big + u, big * 3 + i, float(1 + (u * i) % 5)) for u in range(30) for i in range(20) if (u + i) % 3]
    ratings = spark.createDataFrame(rows, "user long, item long, rating double")
    rm = rec.fit_als(ratings, rank=3, max_iter=3)
    assert rm.users is not None and rm.users.count() == 30
    pairs = ratings.select("user", "item").limit(50)
    scored = rec.als_scorer(rm)(pairs).collect()
    assert len(scored) == 50 and all(r.user >= big and r.item >= 3 * big for r in scored)
    recs = rec.recommend(rm, ratings.select("user").distinct().orderBy("user").limit(4), 2).collect()
    assert len(recs) == 8 and all(r.item >= 3 * big for r in recs)
    small = rec.fit_als(ratings.select((F.col("user") - big).alias("user"), (F.col("item") - 3 * big).alias("item"),
                                       "rating"), rank=3, max_iter=3)
    assert small.users is None
