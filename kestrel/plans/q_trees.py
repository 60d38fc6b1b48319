"""Queries: trees and forests whose every prediction SQL can follow.

The SQL grows the same trees level by level with windows, from the same draws; see ``operators.trees``.
"""

from __future__ import annotations

from math import ceil, sqrt

from pyspark.sql import functions as F

from kestrel.operators.features import RECIPES, prepare
from kestrel.operators.trees import DIGITS, POISSON, grow_forest
from kestrel.plans import derived as D
from kestrel.plans.q_stats import _recipe_sql
from kestrel.plans.registry import query

# fixed values: the settings of the original trees and forests
DEPTH, BINS, TREES = 3, 32, 10
SEED = 42
CATEGORICAL = ("Class", "Gender")


def _settings(recipe_name: str, forest: bool) -> dict:
    """'auto' features of a forest: the square root of their number, rounded up."""
    features = RECIPES[recipe_name].features
    out = {"depth": DEPTH, "bins": BINS, "seed": SEED}
    return out | ({"trees": TREES, "bagging": True, "subset": ceil(sqrt(len(features)))} if forest else {})


def fitted(spark, sf, recipe_name: str, forest: bool):
    recipe = RECIPES[recipe_name]
    rows = prepare(D.passengers(spark, sf), recipe)
    train, test = rows.where(F.col("split") != "test"), rows.where(F.col("split") == "test")
    continuous = [f for f in recipe.features if f not in CATEGORICAL]
    return grow_forest(train, "Id", recipe.features, "Survival", continuous, **_settings(recipe_name, forest)), train, test


def forest_sql(recipe_name: str, final: str, depth: int = DEPTH, bins: int = BINS, seed: int = SEED, trees: int = 1, bagging: bool = False,
               subset: int | None = None) -> str:
    """``final`` is a query over ``votes`` (Id, split, y, tree, w, vote): every row of the recipe in every tree."""
    features = RECIPES[recipe_name].features
    u = f"cast(('0x' || substr(md5(concat_ws('-', cast(Id as varchar), cast(tree as varchar), '{seed}')), 1, 8)) as bigint) / 4294967296.0"
    w = " + ".join(f"cast({u} >= {p} as int)" for p in POISSON) if bagging else "1"
    parts = [f"base as (select * from ({_recipe_sql(recipe_name)}))", "train as (select * from base where split <> 'test')"]
    cols = []
    for f in features:
        if f in CATEGORICAL:
            cols.append(f"cast(b.{f} as int)")
            continue
        parts.append(f"values_{f} as (select {f} as v, count(*) as n from train group by {f})")
        parts.append(f"upto_{f} as (select v, n, sum(n) over (order by v) as c, sum(n) over () as total, count(*) over () as d, max(v) over () as top from values_{f})")
        # the last bin has no upper end
        parts.append(f"""cuts_{f} as (select v from (select v, max(v) over () as last from upto_{f}
          where d <= {bins} or (c - n) * {bins} // total <> c * {bins} // total) where v < last)""")
        cols.append(f"(select count(*) from cuts_{f} c where c.v < b.{f})")
    slots = ", ".join(f"b{i}" for i in range(len(features)))
    parts.append("binned as (select Id, split, cast(Survival as int) as y, " + ", ".join(f"{c} as b{i}" for i, c in enumerate(cols)) + " from base b)")
    parts.append(f"at_1 as (select *, {w} as w, 1 as node from binned, (select unnest(range({trees})) as tree))")
    names = ", ".join(f"'{f}'" for f in features)
    ordered = ", ".join(str(f in CATEGORICAL).lower() for f in features)
    pure = lambda n, k: f"((({k}) * ({k}) + (({n}) - ({k})) * (({n}) - ({k}))) / cast({n} as double))"
    for d in range(1, depth + 1):
        parts.append(f"""stats_{d} as (
  select tree, node, f, [{names}][f] as name, [{ordered}][f] as cat, [{slots}][f] as bin, cast(sum(w) as bigint) as n, cast(sum(w * y) as bigint) as n1
  from at_{d}, (select unnest(range(1, {len(features)} + 1)) as f) where split <> 'test' and w > 0 and node >= {1 << (d - 1)} group by all)""")
        parts.append(f"""usable_{d} as (
  select * from stats_{d} qualify dense_rank() over (partition by tree, node order by md5(concat_ws('-', cast(tree as varchar), cast(node as varchar), name, '{seed}')))
    <= {subset or len(features)})""")
        parts.append(f"""sums_{d} as (
  select *, sum(n) over o as l, sum(n1) over o as l1, row_number() over o as place,
    sum(n) over (partition by tree, node, f) as t, sum(n1) over (partition by tree, node, f) as t1
  from usable_{d} window o as (partition by tree, node, f order by case when cat then n1 / cast(n as double) else bin end, bin))""")
        parts.append(f"""best_{d} as (
  select * from (select *, round({pure('l', 'l1')} + {pure('t - l', 't1 - l1')}, {DIGITS}) as score, round({pure('t', 't1')}, {DIGITS}) as whole
    from sums_{d} where l < t) where score > whole
  qualify row_number() over (partition by tree, node order by score desc, f, place) = 1)""")
        parts.append(f"""left_{d} as (
  select s.tree, s.node, s.bin from sums_{d} s join best_{d} b on s.tree = b.tree and s.node = b.node and s.f = b.f and s.place <= b.place)""")
        parts.append(f"""at_{d + 1} as (
  select a.* exclude (node), case when b.f is null then a.node when case when b.cat then l.bin is not null else [{slots}][b.f] <= b.bin end
    then 2 * a.node else 2 * a.node + 1 end as node
  from at_{d} a left join best_{d} b on a.tree = b.tree and a.node = b.node
  left join left_{d} l on b.cat and l.tree = a.tree and l.node = a.node and l.bin = [{slots}][b.f])""")
    last = f"at_{depth + 1}"
    parts.append(f"leaves as (select tree, node, sum(w * y) * 2 > sum(w) as positive from {last} where split <> 'test' group by all)")
    parts.append(f"votes as (select a.Id, a.split, a.y, a.tree, a.w, cast(v.positive as int) as vote from {last} a join leaves v on a.tree = v.tree and a.node = v.node)")
    return "with " + ",\n".join(parts) + "\n" + final


@query("tree_predictions", forest_sql("class_gender_family", "select Id as PassengerId, cast(vote as int) as Survived from votes where split = 'test'",
                                      **{k: v for k, v in _settings("class_gender_family", False).items()}), "M06 M10")
def q_tree_predictions(spark, sf):
    """Predictions of the depth-3 gini tree for the test rows."""
    tree, _, test = fitted(spark, sf, "class_gender_family", False)
    return tree.votes(test).select(F.col("Id").alias("PassengerId"), F.col("prediction").cast("int").alias("Survived"))


def _forest_queries(recipe_name: str) -> None:
    settings = _settings(recipe_name, True)

    @query(f"forest_votes_{recipe_name}", forest_sql(
        recipe_name, "select Id as PassengerId, cast(sum(vote) as int) as votes, cast(2 * sum(vote) > count(*) as int) as Survived "
        "from votes where split = 'test' group by Id", **settings), "M07 M10")
    def votes(spark, sf):
        """How many of the forest's trees vote for each test row."""
        forest, _, test = fitted(spark, sf, recipe_name, True)
        return forest.votes(test).select(F.col("Id").alias("PassengerId"), "votes", F.col("prediction").cast("int").alias("Survived"))

    @query(f"forest_out_of_bag_{recipe_name}", forest_sql(
        recipe_name, "select count(*) as n, cast(sum(cast(wrong as int)) as bigint) as wrong from (select Id, (2 * sum(vote) > count(*)) <> (any_value(y) = 1) as wrong "
        "from votes where split <> 'test' and w = 0 group by Id)", **settings), "M07 E01")
    def out_of_bag(spark, sf):
        """Out-of-bag error of the forest: judged rows and wrong ones."""
        forest, train, _ = fitted(spark, sf, recipe_name, True)
        return forest.out_of_bag(train, "Survival")


for _name in ("class_gender_family", "class_gender_fare"):
    _forest_queries(_name)
