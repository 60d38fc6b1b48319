import random

import duckdb
import pytest
from pyspark.sql import functions as F

from kestrel.operators import classify, trees
from kestrel.operators.features import RECIPES, prepare
from kestrel.operators.trees import Forest, best_split, grow_forest, quantile_cuts
from kestrel.plans import derived as D
from testdata_paths import SF_SMALL


def sample(spark, n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        c, g, x = rng.randrange(3), rng.randrange(2), rng.choice([rng.random() * 50, rng.randrange(5)])
        rows.append((i, c, g, float(x), int(rng.random() < 0.15 + 0.5 * (g == 1) + 0.3 * (x > 20) * (c != 1))))
    return spark.createDataFrame(rows, "Id long, c int, g int, x double, y int"), rows


def gini_loss(rows, left):
    out = 0.0
    for part in ([r for r in rows if left(r)], [r for r in rows if not left(r)]):
        if not part:
            return None
        p = sum(r[4] for r in part) / len(part)
        out += len(part) * 2 * p * (1 - p)
    return out


def test_root_split_is_the_best_of_all_sets_and_cuts(spark):
    df, rows = sample(spark)
    rows = [(i, c, g, float(int(x) % 7), y) for i, c, g, x, y in rows]
    df = spark.createDataFrame(rows, "Id long, c int, g int, x double, y int")
    tree = grow_forest(df, "Id", ["c", "g", "x"], "y", ["x"], depth=1)
    split = tree.splits[0, 1]
    losses = [gini_loss(rows, lambda r, s=s: r[1] in s) for s in ({0}, {1}, {2}, {0, 1}, {0, 2}, {1, 2})]
    losses += [gini_loss(rows, lambda r: r[2] == 0)] + [gini_loss(rows, lambda r, v=v: r[3] <= v) for v in range(7)]
    column = {"c": 1, "g": 2, "x": 3}[split.feature]
    own = gini_loss(rows, (lambda r: r[column] in split.left) if split.cut is None else lambda r: r[3] <= tree.cuts["x"][split.cut])
    assert own == pytest.approx(min(x for x in losses if x is not None))


def test_exact_quantiles(spark):
    values = [float(i * i % 101) for i in range(500)]
    cuts = quantile_cuts(spark.createDataFrame([(v,) for v in values], "v double").repartition(4), "v", 8)
    assert len(cuts) <= 8 and cuts[-1] == max(values)
    most = max(values.count(v) for v in values)
    for i, c in enumerate(cuts[:-1], 1):  # an end is the value at which an eighth is reached
        assert 0 <= sum(v <= c for v in values) - 500 * i / 8 < most
    assert quantile_cuts(spark.createDataFrame([(1.0,), (3.0,), (1.0,)], "v double"), "v", 8) == [1.0, 3.0]


def test_tree_predicts_like_the_other_implementation(spark):
    """Same gini, depth and categories as the library classifier: the same predictions on the same rows."""
    recipe = RECIPES["class_gender_family"]
    rows = prepare(D.passengers(spark, SF_SMALL), recipe).where(F.col("split") != "test")
    tree = grow_forest(rows, "Id", recipe.features, "Survival", ["FamilySize"], depth=3)
    other = classify.fit_model("dt", classify.assemble(rows, recipe.features))
    theirs = {r.Id: r.prediction for r in other.transform(classify.assemble(rows, recipe.features)).select("Id", "prediction").collect()}
    ours = {r.Id: r.prediction for r in tree.votes(rows).select("Id", "prediction").collect()}
    label = {r.Id: r.Survival for r in rows.select("Id", "Survival").collect()}
    agree = sum(ours[i] == theirs[i] for i in ours) / len(ours)
    right = lambda got: sum(got[i] == label[i] for i in label)
    assert agree > 0.97 and right(ours) >= right(theirs) - 2


def test_votes_follow_from_the_extracted_trees(spark):
    """SQL over the trees as rows gives every row's votes again."""
    df, rows = sample(spark)
    forest = grow_forest(df, "Id", ["c", "g", "x"], "y", ["x"], trees=7, bagging=True, subset=2, seed=5)
    con = duckdb.connect()
    con.execute("create table data (Id bigint, c int, g int, x double, y int)")
    con.executemany("insert into data values (?, ?, ?, ?, ?)", rows)
    con.execute("create table nodes (tree int, node int, feature varchar, upper double, cats int[], positive boolean)")
    con.executemany("insert into nodes values (?, ?, ?, ?, ?, ?)", forest.rows())
    want = dict(con.execute("""
      with recursive walk as (
        select Id, c, g, x, tree, 1 as node from data, (select distinct tree from nodes)
        union all
        select w.Id, w.c, w.g, w.x, w.tree, case when case n.feature when 'x' then round(w.x, 6) <= n.upper when 'c' then list_contains(n.cats, w.c) else list_contains(n.cats, w.g) end
          then 2 * w.node else 2 * w.node + 1 end
        from walk w join nodes n on n.tree = w.tree and n.node = w.node where n.feature is not null)
      select Id, sum(cast(n.positive as int)) from walk w join nodes n on n.tree = w.tree and n.node = w.node where n.feature is null group by Id""").fetchall())
    got = {r.Id: r.votes for r in forest.votes(df).collect()}
    assert got == want and len(set(got.values())) > 3


def test_out_of_bag_rows_and_draws(spark):
    df, rows = sample(spark, 600)
    forest = grow_forest(df, "Id", ["c", "g", "x"], "y", ["x"], trees=10, bagging=True, subset=2)
    drawn = df.select("Id", *[forest.weight(t).alias(f"w{t}") for t in range(10)]).collect()
    weights = [r[f"w{t}"] for r in drawn for t in range(10)]
    assert 0.95 < sum(weights) / len(weights) < 1.05 and 0.34 < weights.count(0) / len(weights) < 0.40
    binned = {r.Id: r for r in forest.binned(df).select("Id", *[forest.vote(t).alias(f"v{t}") for t in range(10)]).collect()}
    wrong = n = 0
    for r in drawn:
        free = [t for t in range(10) if r[f"w{t}"] == 0]
        if free:
            n += 1
            wrong += (2 * sum(binned[r.Id][f"v{t}"] for t in free) > len(free)) != (rows[r.Id][4] == 1)
    got = forest.out_of_bag(df, "y").first()
    assert (got.n, got.wrong) == (n, wrong) and wrong / n < 0.4


def test_pure_and_empty_data(spark):
    pure = spark.createDataFrame([(i, i % 3, 1) for i in range(9)], "Id long, c int, y int")
    tree = grow_forest(pure, "Id", ["c"], "y", [])
    assert not tree.splits and {r.prediction for r in tree.votes(pure).collect()} == {1.0}
    none = grow_forest(pure.limit(0), "Id", ["c"], "y", [])
    assert {r.prediction for r in none.votes(pure).collect()} == {0.0}
    assert none.out_of_bag(pure.limit(0), "y").first().n == 0
    assert best_split({"c": [(0, 5, 5), (1, 5, 5)]}, ["c"], {}) is None
    assert Forest(("c",), {}, 1, False, 1, "Id").rows() == []


def test_levels_read_cells_and_draws_hash_once(spark, monkeypatch):
    """However many rows are alike in bins and label, a level reads one of them a tree; a draw computes its hash once."""
    df = spark.range(3000).selectExpr("id as Id", "cast(id % 3 as int) as c", "cast(id % 5 as double) as x", "cast(id % 2 as int) as y")
    written = []
    keep = trees.cut_lineage
    monkeypatch.setattr(trees, "cut_lineage", lambda d: written.append(keep(d)) or written[-1])
    forest = grow_forest(df, "Id", ["c", "x"], "y", ["x"], trees=4, bagging=True, seed=3)
    assert max(d.count() for d in written) <= 4 * 3 * 5 * 2 and sum(n for n in (r.w for r in written[-1].collect())) > 3000
    plan = df.select(forest.weight(0).alias("w")).where("w > 0")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") <= 2  # the condition and the column


def test_places_of_nulls_ends_and_values(spark):
    df = spark.createDataFrame([(None,), (0.5,), (1.0,), (2.5,), (9.0,)], "x double")
    got = df.select(trees._place(F.col("x"), [1.0, 2.0, 3.0]).alias("a"), trees._place(F.col("x"), [1.0, 2.0, 3.0], reached=True).alias("b"),
                    trees._place(F.col("x"), []).alias("c")).collect()
    assert [tuple(r) for r in got] == [(None, None, 0), (0, 0, 0), (0, 1, 0), (2, 2, 0), (3, 3, 0)]
