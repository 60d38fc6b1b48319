"""Queries: statistics, record linkage, recipes, imputation and rule metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions.hashing import hash_bucket
from kestrel.operators import stats
from kestrel.operators.evaluate import (
    error_rate,
    linkage_score,
    micro_metrics,
    per_class_metrics,
    threshold_counts,
)
from kestrel.operators.features import RECIPES, SPLIT_SEED, SPLIT_WEIGHTS, prepare
from kestrel.operators.impute import impute_group_mean
from kestrel.plans import derived as D
from kestrel.plans.derived import oracle
from kestrel.plans.q_relational import SQL_SCORE
from kestrel.plans.registry import query


def _r6(df, cols):
    return df.select(*[F.round(c, 6).alias(c) if c in cols else F.col(c) for c in df.columns])


# ------------------------------------------------------------------ group means


@query("mean_by_class", oracle("""
select Class, round(avg(Price), 6) as mean_price from passengers group by Class""", "passengers"), "A03")
def q_mean_by_class(spark, sf):
    return _r6(stats.mean_by(D.passengers(spark, sf), ["Class"], "Price", "mean_price"), ["mean_price"])


@query("mean_by_class_gender", oracle("""
select Class, Gender, round(avg(AgeMash), 6) as mean_age from passengers group by Class, Gender""",
                                      "passengers"), "A04")
def q_mean_by_class_gender(spark, sf):
    return _r6(stats.mean_by(D.passengers(spark, sf), ["Class", "Gender"], "AgeMash", "mean_age"), ["mean_age"])


@query("impute_group_mean", oracle("""
select Id, Class, Gender, round(coalesce(AgeMash, m.mean_age, (select avg(AgeMash) from passengers)), 6) as AgeMash
from passengers p left join (select Class, Gender, avg(AgeMash) as mean_age from passengers group by Class, Gender) m
  using (Class, Gender)""", "passengers"), "R8 J04 A04")
def q_impute_group_mean(spark, sf):
    p = D.passengers(spark, sf).select("Id", "Class", "Gender", "AgeMash")
    return _r6(impute_group_mean(p, "AgeMash", ["Class", "Gender"]), ["AgeMash"])


# ------------------------------------------------------------------ missing-value statistics

_NA_STATS_SQL = """
select cast(slot as int) as slot, count(v) as n, round(avg(v), 6) as mean, round(stddev_pop(v), 6) as stdev,
       max(v) as max, min(v) as min, count(*) - count(v) as missing
from (select unnest(generate_series(0, 8)) as slot, unnest(scores) as v from pairs)
group by slot"""

_NA_COLS = ["mean", "stdev"]


@query("na_stats", oracle(_NA_STATS_SQL, "pairs"), "A07 UDF03")
def q_na_stats(spark, sf):
    return _r6(stats.na_stats(D.pairs(spark, sf)), _NA_COLS)


@query("na_stats_merge", oracle(_NA_STATS_SQL, "pairs"), "A08")
def q_na_stats_merge(spark, sf):
    p = D.pairs(spark, sf)
    partials = stats.na_partials(p, hash_bucket(16, F.col("id_1"), F.col("id_2"), 0))
    return _r6(stats.merge_partials(partials), _NA_COLS)


@query("class_contrast", oracle("""
select cast(slot as int) as slot, count(*) - count(v) as missing,
       round(avg(v) filter (where matched) - avg(v) filter (where not matched), 6) as mean_diff
from (select matched, unnest(generate_series(0, 8)) as slot, unnest(scores) as v from pairs)
group by slot""", "pairs"), "A14 A07 F10")
def q_class_contrast(spark, sf):
    return _r6(stats.class_contrast(D.pairs(spark, sf)), ["mean_diff"])


# ------------------------------------------------------------------ record linkage scoring


@query("linkage_scores", oracle(f"select id_1, id_2, {SQL_SCORE} as score, matched from pairs", "pairs"),
       "E04 C07 C10")
def q_linkage_scores(spark, sf):
    return D.pairs(spark, sf).select("id_1", "id_2", linkage_score().alias("score"), "matched")


@query("linkage_thresholds", oracle(f"""
select threshold, matched, n from (
  select 4.0::double as threshold, matched, count(*) as n from pairs where {SQL_SCORE} >= 4.0 group by matched
  union all
  select 2.0::double, matched, count(*) from pairs where {SQL_SCORE} >= 2.0 group by matched)""", "pairs"),
       "E04 F05 A05")
def q_linkage_thresholds(spark, sf):
    s = D.pairs(spark, sf).select(linkage_score().alias("score"), "matched")
    return threshold_counts(s)


# ------------------------------------------------------------------ recipes

_SPLIT_SQL = (f"case when part = 'test' then 'test' "
              f"when cast(('0x' || substr(md5(concat_ws('-', cast(Id as varchar), '{SPLIT_SEED}')), 1, 8)) as bigint)"
              f" / 4294967296.0 < {SPLIT_WEIGHTS[0] / sum(SPLIT_WEIGHTS)} then 'train70' else 'valid30' end")


def _recipe_sql(name: str) -> str:
    r = RECIPES[name]
    feats = []
    for f in r.features:
        if r.impute and f == r.impute[0]:
            keys = r.impute[1]
            kl = ", ".join(keys)
            feats.append(f"round(coalesce({f}, (select m from (select {kl}, avg({f}) as m from passengers "
                         f"group by {kl}) g where " + " and ".join(f"g.{k} = p.{k}" for k in keys)
                         + f"), (select avg({f}) from passengers)), 6) as {f}")
        else:
            feats.append(f"round({f}, 6) as {f}")
    split = _SPLIT_SQL if r.split else "case when part = 'test' then 'test' else 'train' end"
    return oracle(f"select Id, Survival, part, {', '.join(feats)}, {split} as split from passengers p",
                  "passengers")


def _recipe_query(name: str):
    recipe = RECIPES[name]

    def build(spark, sf):
        out = prepare(D.passengers(spark, sf), recipe)
        return _r6(out, list(recipe.features))

    build.__name__ = f"q_recipe_{name}"
    return build


_RECIPE_OPS = {
    "class_gender": "R1 X01", "class_gender_sibsp": "R2 X01", "class_gender_sibsp_parch_fare": "R3 U01 A03 J04",
    "class_gender_family": "R4 P05", "class_gender_sibsp_fare": "R5 J04", "class_gender_fare": "R6 J04",
    "class_gender_age": "R7 A04 J04",
}
for _name in RECIPES:
    query(f"recipe_{_name}", _recipe_sql(_name), _RECIPE_OPS[_name])(_recipe_query(_name))


# ------------------------------------------------------------------ rule predictions and metrics

_RULE_SQL = """
rule as (select Id, cast(Survival as double) as label,
                case when Gender = 0.0 then 1.0 else 0.0 end as prediction
         from passengers where part = 'train')"""


def _rule(spark, sf):
    """The gender baseline rule (female → survived) on training rows."""
    p = D.passengers(spark, sf).where(F.col("part") == "train")
    return p.select("Id", F.col("Survival").cast("double").alias("label"),
                    F.when(F.col("Gender") == 0.0, 1.0).otherwise(0.0).alias("prediction"))


@query("rule_error_rate", oracle("""
select round(avg(case when prediction <> label then 1.0 else 0.0 end), 6) as error_rate, count(*) as n from rule""",
                                 "passengers", ctes=_RULE_SQL), "E01 A06 A15 F07")
def q_rule_error_rate(spark, sf):
    return _r6(error_rate(_rule(spark, sf)), ["error_rate"])


@query("rule_mismatches", oracle("select Id, label, prediction from rule where prediction <> label", "passengers",
                                 ctes=_RULE_SQL), "F07")
def q_rule_mismatches(spark, sf):
    return _rule(spark, sf).where(F.col("prediction") != F.col("label"))


@query("rule_metrics", oracle("""
select round(avg(case when prediction = label then 1.0 else 0.0 end), 6) as accuracy,
       round(avg(case when prediction = label then 1.0 else 0.0 end), 6) as precision,
       round(avg(case when prediction = label then 1.0 else 0.0 end), 6) as recall,
       round(1 - avg(case when prediction = label then 1.0 else 0.0 end), 6) as error_rate,
       count(*) as n from rule""", "passengers", ctes=_RULE_SQL), "E02")
def q_rule_metrics(spark, sf):
    return _r6(micro_metrics(_rule(spark, sf)), ["accuracy", "precision", "recall", "error_rate"])


@query("rule_class_metrics", oracle("""
select c.class, coalesce(tp, 0) as tp, coalesce(predicted, 0) as predicted, coalesce(actual, 0) as actual,
       round(coalesce(tp, 0) / nullif(coalesce(predicted, 0), 0), 6) as precision,
       round(coalesce(tp, 0) / nullif(coalesce(actual, 0), 0), 6) as recall
from (select label as class from rule union select prediction from rule) c
left join (select label as class, count(*) as actual from rule group by label) a on a.class = c.class
left join (select prediction as class, count(*) as predicted from rule group by prediction) p on p.class = c.class
left join (select label as class, count(*) as tp from rule where label = prediction group by label) t
  on t.class = c.class""", "passengers", ctes=_RULE_SQL), "E02 A16")
def q_rule_class_metrics(spark, sf):
    return _r6(per_class_metrics(_rule(spark, sf)), ["precision", "recall"])


@query("rule_confusion", oracle("select label, prediction, count(*) as n from rule group by label, prediction",
                                "passengers", ctes=_RULE_SQL), "A16")
def q_rule_confusion(spark, sf):
    return stats.confusion(_rule(spark, sf))
