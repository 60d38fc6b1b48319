"""Queries: projections, filters, joins, unions and simple aggregates."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from kestrel.operators.evaluate import linkage_score
from kestrel.operators.joins import anti, lookup_with_default, semi
from kestrel.operators.sampling import split_column, split_parts
from kestrel.operators.stats import histogram, keyed_sum
from kestrel.plans import derived as D
from kestrel.plans.derived import oracle
from kestrel.plans.fixtures import view
from kestrel.plans.registry import query
from kestrel.session import written

RATING_SPLIT = (0.9, 0.1)  # fixed values: train / held-out weights of the recommender evaluation
RATING_SEED = 42

SQL_HEAVY = """
heavy as (select "user" from plays group by "user" order by count(*) desc, "user" limit 1)"""


def heaviest_user(plays):
    """The user with most play lines (ties: smallest id) as a one-row table:
    the default spot-check user (F08)."""
    return (plays.groupBy("user").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "user").limit(1).select("user"))


def rating_split_sql(alias: str = "ratings") -> str:
    return ("case when cast(('0x' || substr(md5(concat_ws('-', cast(r.\"user\" as varchar), cast(r.item as varchar), "
            f"cast(r.cnt as varchar), '{RATING_SEED}')), 1, 8)) as bigint) / 4294967296.0 < {RATING_SPLIT[0]} "
            "then 0 else 1 end")


def rating_split(spark, sf):
    """(all, train, held-out) ratings, split 90/10 by a hash of the rating line (X02): parsed, hashed and written once."""
    parts = split_column(["user", "item", "cnt"], RATING_SPLIT, RATING_SEED)
    tagged = written(D.ratings(spark, sf).withColumn("_split", parts), "ratings")
    return tagged.drop("_split"), *split_parts(tagged, len(RATING_SPLIT))


# ------------------------------------------------------------------ projections


@query("select_prune", oracle("select Id, Survival, Class, Gender from passengers", "passengers"), "P01 P06")
def q_select_prune(spark, sf):
    return D.passengers(spark, sf).select("Id", "Survival", "Class", "Gender")


@query("family_size", oracle("select Id, SibSpouse, ParCh, FamilySize from passengers", "passengers"), "P02 P05")
def q_family_size(spark, sf):
    return D.passengers(spark, sf).select("Id", "SibSpouse", "ParCh", "FamilySize")


@query("encode_categories", oracle("""
select cast(PassengerId as int) as Id, Pclass, Sex, cast(Pclass as double) - 1.0 as Class,
       case when Sex = 'male' then 1.0 else 0.0 end as Gender from bookings""", views=("bookings",)),
       "C08 C09 UDF01")
def q_encode_categories(spark, sf):
    from kestrel.functions.scalars import category_offset, gender_code
    b = view(spark, sf, "bookings")
    return b.select(F.col("PassengerId").cast("int").alias("Id"), "Pclass", "Sex",
                    category_offset("Pclass").alias("Class"), gender_code("Sex").alias("Gender"))


@query("vector_slot", oracle("select Id, Gender as gender_slot from passengers", "passengers"), "P07 M03")
def q_vector_slot(spark, sf):
    p = D.passengers(spark, sf)
    v = VectorAssembler(inputCols=["Class", "Gender", "FamilySize"], outputCol="features").transform(p)
    return v.select("Id", vector_to_array("features")[1].alias("gender_slot"))


# ------------------------------------------------------------------ unions


@query("union_train_test", oracle("""
select Class, Price, part from passengers where part = 'train'
union all select Class, Price, part from passengers where part = 'test'""", "passengers"), "U01")
def q_union_train_test(spark, sf):
    p = D.passengers(spark, sf)
    train = p.where(F.col("part") == "train").select("Class", "Price", "part")
    test = p.where(F.col("part") == "test").select("Class", "Price", "part")
    return train.unionByName(test)


@query("union_labelled", oracle("""
select doc_id, 1.0 as label from messages where label = 1.0
union all select doc_id, 0.0 as label from messages where label = 0.0""", views=("messages",)), "U02 P08")
def q_union_labelled(spark, sf):
    m = view(spark, sf, "messages")
    pos = m.where(F.col("label") == 1.0).select("doc_id", F.lit(1.0).alias("label"))
    neg = m.where(F.col("label") == 0.0).select("doc_id", F.lit(0.0).alias("label"))
    return pos.unionByName(neg)


# ------------------------------------------------------------------ filters


@query("user_filter", oracle("""
select p."user", p.item, p.cnt from plays p join heavy h on p."user" = h."user\"""", "plays", ctes=SQL_HEAVY),
       "F08")
def q_user_filter(spark, sf):
    plays = D.plays(spark, sf)
    return plays.join(heaviest_user(plays), "user").select("user", "item", "cnt")


@query("drop_missing", oracle("select id_1, id_2, scores[1] as s0 from pairs where scores[1] is not null",
                              "pairs"), "F06")
def q_drop_missing(spark, sf):
    p = D.pairs(spark, sf).select("id_1", "id_2", F.get("scores", 0).alias("s0"))
    return p.where(F.col("s0").isNotNull() & ~F.isnan("s0"))


SQL_SCORE = ("coalesce(scores[3], 0.0) + coalesce(scores[6], 0.0) + coalesce(scores[7], 0.0) "
             "+ coalesce(scores[8], 0.0) + coalesce(scores[9], 0.0)")


@query("score_threshold", oracle(f"""
select id_1, id_2, {SQL_SCORE} as score, matched from pairs where {SQL_SCORE} >= 4.0""", "pairs"), "F05 C07 C10")
def q_score_threshold(spark, sf):
    s = D.pairs(spark, sf).select("id_1", "id_2", linkage_score().alias("score"), "matched")
    return s.where(F.col("score") >= 4.0)


@query("class_filter", oracle("select id_1, id_2 from pairs where matched", "pairs"), "F10")
def q_class_filter(spark, sf):
    return D.pairs(spark, sf).where(F.col("matched")).select("id_1", "id_2")


# ------------------------------------------------------------------ joins and lookups


@query("resolve_alias", oracle('select "user", item, cnt from ratings', "ratings"), "J02 S04")
def q_resolve_alias(spark, sf):
    return D.ratings(spark, sf).select("user", "item", "cnt")


@query("last_alias", oracle("select bad_id, good_id from alias", "alias"), "A13")
def q_last_alias(spark, sf):
    return D.alias(spark, sf)


@query("user_items_semi", oracle("""
select i.item, i.name from items i
where i.item in (select p.item from plays p join heavy h on p."user" = h."user")""", "items", "plays",
                 ctes=SQL_HEAVY), "J05 F09 P10")
def q_user_items_semi(spark, sf):
    plays = D.plays(spark, sf)
    touched = plays.join(heaviest_user(plays), "user").select("item")
    return semi(D.items(spark, sf), touched, "item").select("item", "name")


@query("not_positive_anti", oracle("""
select i.item from items i
where i.item not in (select p.item from plays p join heavy h on p."user" = h."user")""", "items", "plays",
                   ctes=SQL_HEAVY), "J06")
def q_not_positive_anti(spark, sf):
    plays = D.plays(spark, sf)
    touched = plays.join(heaviest_user(plays), "user").select("item")
    return anti(D.items(spark, sf), touched, "item").select("item")


SQL_SPLIT = f"""
split as (select r.*, {rating_split_sql()} as part from ratings r),
listens as (select item, sum(rating) as total from split where part = 0 group by item)"""


@query("popularity_score", oracle("""
select s."user", s.item, coalesce(l.total, 0.0) as score
from split s left join listens l on s.item = l.item where s.part = 1""", "ratings", ctes=SQL_SPLIT),
       "J03 M14 A02 X02")
def q_popularity_score(spark, sf):
    from kestrel.operators.recommend import popularity_scores
    _, train, held = rating_split(spark, sf)
    return popularity_scores(train, held.select("user", "item"))


@query("listens_per_item", oracle("select item, sum(rating) as total from ratings group by item", "ratings"),
       "A02")
def q_listens_per_item(spark, sf):
    return keyed_sum(D.ratings(spark, sf), "item", "rating", "total")


@query("distinct_items", oracle("select distinct item from ratings", "ratings"), "A11")
def q_distinct_items(spark, sf):
    return D.ratings(spark, sf).select("item").distinct()


@query("match_histogram", oracle("select matched, count(*) as n from pairs group by matched", "pairs"), "A05")
def q_match_histogram(spark, sf):
    return histogram(D.pairs(spark, sf), "matched")


@query("default_lookup", oracle("""
select p.Id, coalesce(p.Price, m.mean_price, 0.0) as Price
from passengers p left join (select Class, avg(Price) as mean_price from passengers group by Class) m
  on p.Class = m.Class""", "passengers"), "J04")
def q_default_lookup(spark, sf):
    p = D.passengers(spark, sf)
    means = p.groupBy("Class").agg(F.avg("Price").alias("mean_price"))
    out = lookup_with_default(p.select("Id", "Class", "Price"), means, "Class", "mean_price", F.lit(0.0),
                              "Price", keep=F.col("Price").isNotNull())
    return out.select("Id", "Price")


@query("user_baskets", oracle("""
select "user", count(distinct item) as n_items, count(*) as n_plays, sum(rating) as total
from ratings group by "user\"""", "ratings"), "A10")
def q_user_baskets(spark, sf):
    """Per-user gathering (``groupByKey``) re-aimed as aggregates: the basket
    is summarised, never collected into one row, so a hot user stays a
    partially aggregated group."""
    r = D.ratings(spark, sf)
    return r.groupBy("user").agg(F.countDistinct("item").alias("n_items"), F.count(F.lit(1)).alias("n_plays"),
                                 F.sum("rating").alias("total"))
