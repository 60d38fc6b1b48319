"""Queries: what SQL can follow of descents, of models by segment and of factor models."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators import classify
from kestrel.operators import recommend as rec
from kestrel.operators.descent import ITERATIONS, REG, STEP, TOL, dense_rows, fit_descent
from kestrel.operators.factors import normal_equation_residuals, top_products
from kestrel.operators.features import RECIPES, prepare
from kestrel.operators.segments import SegmentedModel, fit_segments
from kestrel.plans import derived as D
from kestrel.plans.derived import oracle
from kestrel.plans.q_models import _als
from kestrel.plans.q_relational import SQL_SPLIT
from kestrel.plans.q_stats import _recipe_sql
from kestrel.plans.registry import query
from kestrel.session import cut_lineage

RECIPE = "class_gender_family"
FEATURES = RECIPES[RECIPE].features


def _train(spark, sf):
    return prepare(D.passengers(spark, sf), RECIPES[RECIPE]).where(F.col("split") != "test")


def _descent_sql() -> str:
    """The same steps by recursion over the distinct rows."""
    k = range(len(FEATURES))
    w, d, a = ([f"{x}{i}" for i in k] for x in "wda")
    margin = " + ".join(f"w{i} * x{i}" for i in k)
    size = f"{STEP} / sqrt(i + 1)"
    return f"""
with recursive g as (
  select {', '.join(f'{f} as x{i}' for i, f in enumerate(FEATURES))}, cast(Survival as double) as y, cast(count(*) as double) as n
  from ({_recipe_sql(RECIPE)}) where split <> 'test' group by all),
steps(i, {', '.join(w)}, stop) as (
  select 0, {', '.join('cast(0 as double)' for _ in k)}, false
  union all
  select i + 1, {', '.join(a)}, sqrt({' + '.join(f'(a{i} - w{i}) * (a{i} - w{i})' for i in k)}) < {TOL} * greatest(sqrt({' + '.join(f'a{i} * a{i}' for i in k)}), 1.0)
  from (select i, {', '.join(w)}, {', '.join(f'w{j} * (1 - {size} * {REG}) - {size} * d{j} / t as a{j}' for j in k)}
        from (select i, {', '.join(w)}, sum(n) as t, {', '.join(f'sum((1 / (1 + exp(-({margin}))) - y) * n * x{j}) as d{j}' for j in k)}
              from steps, g where not stop and i < {ITERATIONS} group by i, {', '.join(w)}))),
last as (select * from steps order by i desc limit 1)
""" + " union all ".join(f"select '{f}' as feature, round(w{i}, 6) as weight, i as steps from last" for i, f in enumerate(FEATURES))


@query("descent_weights", _descent_sql(), "M05 M19")
def q_descent_weights(spark, sf):
    """Weights and steps of the gradient descent with the recorded solver's settings."""
    rows = dense_rows(_train(spark, sf).groupBy("Survival", *FEATURES).agg(F.count(F.lit(1)).alias("n")), FEATURES, F.col("Survival").alias("label"), "n")
    model = fit_descent(rows, len(FEATURES))
    out = [(f, round(float(w), 6), model.steps) for f, w in zip(FEATURES, model.weights)]
    return spark.createDataFrame(out, "feature string, weight double, steps int")


#: Segments of the equations below: many, and none of them tied to the label.
SEGMENTS = 49


@query("segment_equations", " union all ".join(
    f"select cast(Id % {SEGMENTS} as int) as segment, '{f}' as feature, round(avg(Survival{'' if f == 'intercept' else f' * {f}'}), 3) as moment "
    f"from ({_recipe_sql(RECIPE)}) where split <> 'test' group by Id % {SEGMENTS}" for f in (*FEATURES, "intercept")), "M08")
def q_segment_equations(spark, sf):
    """Likelihood equations of one model per segment, all segments fitted at once: the mean of p * x is that of y * x."""
    rows = _train(spark, sf).withColumn("segment", F.pmod("Id", F.lit(SEGMENTS)))
    data = cut_lineage(classify.assemble(rows, FEATURES))
    scored = SegmentedModel("segment", fit_segments(data, "segment")).transform(data)
    means = scored.groupBy("segment").agg(F.avg("probability").alias("intercept"), *[F.avg(F.col("probability") * F.col(f)).alias(f) for f in FEATURES])
    stack = ", ".join(f"'{f}', {f}" for f in (*FEATURES, "intercept"))
    return means.selectExpr("segment", f"stack({1 + len(FEATURES)}, {stack}) as (feature, m)").select("segment", "feature", F.round("m", 3).alias("moment"))


#: Single-precision factors: what remains of a solved equation.
SOLVED = 1e-3


@query("als_solved_users", oracle("""
select "user", count(*) as n, true as solved from split where part = 0 group by "user\"""", "ratings", ctes=SQL_SPLIT), "M09")
def q_als_solved_users(spark, sf):
    """Every user of the training rows: their ratings, and whether their factors solve the normal equations of the last half-step."""
    model, train, _ = _als(spark, sf)
    users, items = rec.factor_tables(model)
    found = normal_equation_residuals(train, users, items, rec.DEFAULT_RANK, rec.DEFAULT_REG, rec.DEFAULT_ALPHA)
    return found.select("user", "n", (F.col("residual") < SOLVED).alias("solved"))


@query("top_product_share", None, "M13")
def q_top_product_share(spark, sf):
    """How many of all user-item products the exact search for the five best items of every user computes."""
    ratings = cut_lineage(D.ratings(spark, sf))
    return top_products(*rec.factor_tables(rec.fit_als(ratings)), 5)[1]
