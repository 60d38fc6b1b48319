"""Queries: classification and recommender models.

Predictions themselves have no SQL counterpart; those queries are checked on
row counts and schema by the driver and on invariants by the tests.  What SQL
can know of a model has queries of its own: the likelihood equations of the
logistic regressions, the pairs, users and items that a recommender may score,
the rows each run validates on and scores, and the cross-validation of the
popularity scorer.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.operators import classify
from kestrel.operators import recommend as rec
from kestrel.operators.features import RECIPES, prepare
from kestrel.plans import derived as D
from kestrel.plans.derived import oracle
from kestrel.plans.fixtures import view
from kestrel.plans.q_relational import SQL_HEAVY, SQL_SPLIT, heaviest_user, rating_split
from kestrel.plans.q_sampling import FOLD_SEED, FOLDS, SQL_CV
from kestrel.plans.q_stats import _recipe_sql
from kestrel.plans.registry import query
from kestrel.session import concurrently, cut_lineage, scratch_path, written
from kestrel.sources.tables import load

LR_RECIPES = ("class_gender", "class_gender_sibsp", "class_gender_sibsp_parch_fare", "class_gender_fare",
              "class_gender_sibsp_fare", "class_gender_family", "class_gender_age")
RUNS = {  # name -> (recipe, estimator kind, segment column)
    **{f"lr_{r}": (r, "lr", None) for r in LR_RECIPES},
    "lr_segmented_family": ("class_gender_family", "lr", "Gender"),
    "dt_class_gender_family": ("class_gender_family", "dt", None),
    "rf_class_gender_family": ("class_gender_family", "rf", None),
    "rf_class_gender_fare": ("class_gender_fare", "rf", None),
}


def _run(spark, sf, name, write: bool = True, refit: bool = True, prepared=None):
    recipe_name, kind, segment = RUNS[name]
    recipe = RECIPES[recipe_name]
    prepared = prepare(D.passengers(spark, sf), recipe) if prepared is None else prepared
    out = scratch_path(spark, f"pred-{name}") if write else None
    return classify.run_classifier(prepared, recipe, kind, out, segment, refit=refit)


def _prediction_query(name):
    def build(spark, sf):
        return _run(spark, sf, name).predictions

    build.__name__ = f"q_{name}"
    return build


_RUN_OPS = {"lr": "M04 M10 M17 S11 M03", "dt": "M06 M10 M17 S11", "rf": "M07 M10 M17 S11"}
for _n, (_r, _k, _s) in RUNS.items():
    query(_n, None, _RUN_OPS[_k] + (" M08" if _s else ""))(_prediction_query(_n))


@query("classifier_validation", None, "E01 E02 M17 X01")
def q_classifier_validation(spark, sf):
    """Validation metrics of every model run that has a validation split; each recipe is prepared once."""
    passengers = cut_lineage(D.passengers(spark, sf))
    judged = [n for n in RUNS if RECIPES[RUNS[n][0]].split]
    recipes = {r: cut_lineage(prepare(passengers, RECIPES[r])) for r in {RUNS[n][0] for n in judged}}

    def run(name):
        return _run(spark, sf, name, write=False, refit=False, prepared=recipes[RUNS[name][0]]).validation.select(F.lit(name).alias("run"), "*")

    return reduce(DataFrame.unionByName, concurrently(spark, [partial(run, n) for n in judged]))


@query("model_weights", None, "M19")
def q_model_weights(spark, sf):
    parts = []
    for name in ("lr_class_gender_sibsp_parch_fare", "lr_segmented_family", "rf_class_gender_fare"):
        recipe = RECIPES[RUNS[name][0]]
        parts.append(classify.weights(spark, _run(spark, sf, name, write=False).model, recipe.features, name))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("score_messages", None, "M01 M05 M18 U02 P08")
def q_score_messages(spark, sf):
    """Fitted on the labelled messages, applied to all documents."""
    model, tf = classify.text_classifier(view(spark, sf, "messages"))
    docs = load(spark, sf, "documents").select("doc_id", "text")
    return classify.score_texts(model, tf, docs).select("doc_id", "prediction")


@query("scored_messages", "select doc_id from documents", "M18")
def q_scored_messages(spark, sf):
    """The documents that get a prediction of 0 or 1: all."""
    return q_score_messages(spark, sf).where(F.col("prediction").isin(0.0, 1.0)).select("doc_id")


def _equations(spark, sf, name):
    """Mean of p * x per feature (and of p) over the training rows, from the weights report."""
    recipe_name, kind, segment = RUNS[name]
    recipe = RECIPES[recipe_name]
    rows = cut_lineage(prepare(D.passengers(spark, sf), recipe).where(F.col("split") != "test"))
    model = classify.fit_model(kind, classify.assemble(rows, recipe.features), segment, tol=1e-12)
    weights: dict[str, dict[str, float]] = {}
    for r in classify.weights(spark, model, recipe.features, name).collect():  # a row per feature
        weights.setdefault(r.model, {})[r.feature] = r.weight
    out = None
    for label, w in weights.items():
        linear = sum((F.lit(w[f]) * F.col(f) for f in recipe.features), F.lit(w["intercept"]))
        p = 1 / (1 + F.exp(-linear))
        part = rows if segment is None else rows.where(F.col(segment) == float(label.split("=")[1][:-1]))
        means = part.agg(F.avg(p).alias("intercept"), *[F.avg(p * F.col(f)).alias(f) for f in recipe.features])
        stack = ", ".join(f"'{f}', {f}" for f in ("intercept", *recipe.features))
        long = means.selectExpr(f"stack({1 + len(recipe.features)}, {stack}) as (feature, m)") \
            .select(F.lit(label).alias("model"), "feature", F.round("m", 3).alias("moment"))
        out = long if out is None else out.unionByName(long)
    return out


def _equations_sql() -> str:
    """At the optimum the same means of y * x."""
    parts = []
    for name, (recipe_name, kind, segment) in RUNS.items():
        if kind != "lr":
            continue
        for value in (None,) if segment is None else (0.0, 1.0):
            label = name if value is None else f"{name}[{segment}={value}]"
            where = "" if value is None else f" and {segment} = {value}"
            for f in ("intercept", *RECIPES[recipe_name].features):
                x = "" if f == "intercept" else f" * {f}"
                parts.append(f"select '{label}' as model, '{f}' as feature, round(avg(Survival{x}), 3) as moment "
                             f"from ({_recipe_sql(recipe_name)}) where split <> 'test'{where}")
    return " union all ".join(parts)


@query("lr_score_equations", _equations_sql(), "M03 M04 M08 M19")
def q_lr_score_equations(spark, sf):
    """Likelihood equations of every logistic regression, at full convergence."""
    out = None
    for name, (_, kind, _) in RUNS.items():
        if kind == "lr":
            rows = _equations(spark, sf, name)
            out = rows if out is None else out.unionByName(rows)
    return out


@query("scored_passengers", oracle(
    "select run, Id as PassengerId from passengers, (select unnest([" + ", ".join(f"'{n}'" for n in RUNS)
    + "]) as run) where part = 'test'", "passengers"), "M10 S11")
def q_scored_passengers(spark, sf):
    """The rows every run predicts and writes: the test rows."""
    out = None
    for name in RUNS:
        rows = _run(spark, sf, name).predictions.where(F.col("Survived").isin(0, 1)).select(F.lit(name).alias("run"), "PassengerId")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("validated_rows", " union all ".join(
    f"select '{n}' as run, count(*) as n from ({_recipe_sql(r)}) where split = 'valid30'"
    for n, (r, _, _) in RUNS.items() if RECIPES[r].split), "M17 X01")
def q_validated_rows(spark, sf):
    """Rows that each run's validation metrics are taken over."""
    return q_classifier_validation(spark, sf).select("run", "n")


# ------------------------------------------------------------------ recommender


def _als(spark, sf, **kw):
    _, train, held = rating_split(spark, sf)
    return rec.fit_als(train, **kw), train, held


@query("als_pairs", None, "M09 M11 J07")
def q_als_pairs(spark, sf):
    model, _, held = _als(spark, sf)
    return rec.als_scorer(model)(held.select("user", "item"))


@query("als_scored_pairs", oracle("""
select s."user", s.item from split s
where s.part = 1 and s."user" in (select "user" from split where part = 0) and s.item in (select item from split where part = 0)""",
                                  "ratings", ctes=SQL_SPLIT), "M09 M11 J07")
def q_als_scored_pairs(spark, sf):
    """The held-out pairs that get a score: user and item both occur in the training rows."""
    return q_als_pairs(spark, sf).where(F.col("score").isNotNull()).select("user", "item")


@query("als_auc", None, "M09 E03 X04")
def q_als_auc(spark, sf):
    ratings, train, held = rating_split(spark, sf)
    return rec.evaluate_auc(held, ratings.select("item").distinct(), rec.als_scorer(rec.fit_als(train)), seed=7)


#: Users that the report lists, a feature of the original; None: all users.
REPORT_USERS = 100


def _first_users(ratings, n: int | None = REPORT_USERS):
    # distinct().take(n) made deterministic: the n smallest user ids
    users = ratings.select("user").distinct()
    return users if n is None else users.orderBy("user").limit(n)


@query("recommend_top5", None, "M13 L03")
def q_recommend_top5(spark, sf):
    ratings = written(D.ratings(spark, sf), "ratings")
    return rec.recommend(rec.fit_als(ratings), _first_users(ratings), 5)


@query("recommended_ranks", oracle("""
select u."user", cast(r.rank as int) as rank
from (select distinct "user" from ratings) u,
     (select unnest(generate_series(1, least(5, (select count(distinct item) from ratings)))) as rank) r""", "ratings"),
       "M13 L03")
def q_recommended_ranks(spark, sf):
    """Every user gets five recommendations (or as many as there are items)."""
    ratings = written(D.ratings(spark, sf), "ratings")
    out = rec.recommend(rec.fit_als(ratings), _first_users(ratings, None), 5)
    return out.select("user", F.col("rank").cast("int").alias("rank"))


@query("recommend_text", None, "M13 C12")
def q_recommend_text(spark, sf):
    return rec.format_recommendations(q_recommend_top5(spark, sf))


@query("spot_check", None, "M12 F08 J05 L03")
def q_spot_check(spark, sf):
    ratings = written(D.ratings(spark, sf), "ratings")
    model = rec.fit_als(ratings)
    # a play line is one rating: the ratings know whose are most, and are not parsed again
    return rec.spot_check(spark, model, ratings, D.items(spark, sf), written(heaviest_user(ratings), "heaviest-user"))


@query("spot_check_played", oracle("""
select 'played' as kind, i.item, i.name from items i
where i.item in (select r.item from ratings r join heavy h on r."user" = h."user")""", "items", "ratings", ctes=SQL_HEAVY),
       "M12 F08 J05")
def q_spot_check_played(spark, sf):
    return q_spot_check(spark, sf).where(F.col("kind") == "played")


@query("cv_auc_popularity", oracle("""
select fold, round(avg(auc), 6) as mean_auc, count(*) as users from per group by fold""", "ratings", ctes=SQL_CV), "M15 X03 A17 E03")
def q_cv_auc_popularity(spark, sf):
    """The same cross-validation with the popularity scorer, which SQL can follow draw by draw."""
    ratings = written(D.ratings(spark, sf), "ratings")
    folds = rec.cross_validated_auc(ratings, ratings.select("item").distinct(), FOLDS, FOLD_SEED, rec.popularity_scorer)
    return folds.select("fold", F.round("mean_auc", 6).alias("mean_auc"), "users")


@query("cv_auc", None, "M15 X03 A17")
def q_cv_auc(spark, sf):
    ratings = written(D.ratings(spark, sf), "ratings")
    folds = rec.cross_validated_auc(ratings, ratings.select("item").distinct(), k=10, seed=500)
    return folds.agg(F.avg("mean_auc").alias("cv_mean_auc"), F.count(F.lit(1)).alias("folds"))


# fixed values: the grid the original evaluation runs (rank, lambda, alpha; 10 iterations)
GRID_RANKS, GRID_LAMBDAS, GRID_ALPHAS = (300,), (1000.0,), (40.0,)
# fixed values: from the wider grid whose results the original records in comments
SEARCH_RANKS, SEARCH_LAMBDAS = (5, 10), (0.01, 1.0)


@query("grid_auc", None, "M16 L05")
def q_grid_auc(spark, sf):
    ratings, train, held = rating_split(spark, sf)
    items = ratings.select("item").distinct()
    return rec.grid_search(train, held, items, GRID_RANKS, GRID_LAMBDAS, GRID_ALPHAS, max_iter=10)


@query("grid_ranking", None, "M16 L05")
def q_grid_ranking(spark, sf):
    """Four settings, judged on the same negatives, best first."""
    ratings, train, held = rating_split(spark, sf)
    return rec.grid_search(train, held, ratings.select("item").distinct(), SEARCH_RANKS, SEARCH_LAMBDAS, GRID_ALPHAS)
