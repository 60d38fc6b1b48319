"""Queries: splits, folds, negative sampling, per-user AUC, top-k and hashed TF."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.operators.features import SPLIT_SEED, char_tf, hashed_tf
from kestrel.operators.recommend import evaluate_auc, format_recommendations, popularity_scorer, top_k_items
from kestrel.operators.sampling import fold_column, negative_samples, split_column
from kestrel.plans import derived as D
from kestrel.plans.derived import oracle
from kestrel.plans.q_relational import RATING_SEED, RATING_SPLIT, rating_split, rating_split_sql
from kestrel.plans.registry import query
from kestrel.sources.tables import load

NEG_SEED = 7  # seed of the negative draws
FOLDS, FOLD_SEED = 10, 500  # fixed values: 10-fold cross-validation with seed 500


def _md5_u32(*parts: str) -> str:
    return ("cast(('0x' || substr(md5(concat_ws('-', " + ", ".join(parts) + ")), 1, 8)) as bigint)")


@query("split_70_30", oracle(f"""
select Id, case when {_md5_u32('cast(Id as varchar)', f"'{SPLIT_SEED}'")} / 4294967296.0 < 0.7 then 0 else 1 end
  as split from passengers where part = 'train'""", "passengers"), "X01")
def q_split_70_30(spark, sf):
    p = D.passengers(spark, sf).where(F.col("part") == "train")
    return p.select("Id", split_column(["Id"], (0.7, 0.3), SPLIT_SEED).alias("split"))


@query("split_90_10", oracle(f'select r."user", r.item, r.cnt, {rating_split_sql()} as split from ratings r',
                             "ratings"), "X02")
def q_split_90_10(spark, sf):
    r = D.ratings(spark, sf)
    return r.select("user", "item", "cnt", split_column(["user", "item", "cnt"], RATING_SPLIT, RATING_SEED)
                    .alias("split"))


@query("kfold_10", oracle(f"""
select "user", item, cnt,
       cast({_md5_u32('cast("user" as varchar)', 'cast(item as varchar)', 'cast(cnt as varchar)', f"'{FOLD_SEED}'")}
            % {FOLDS} as int) as fold
from ratings""", "ratings"), "X03")
def q_kfold_10(spark, sf):
    r = D.ratings(spark, sf)
    return r.select("user", "item", "cnt", fold_column(["user", "item", "cnt"], FOLDS, FOLD_SEED).alias("fold"))


_SQL_NEG = f"""
split as (select r.*, {rating_split_sql()} as part from ratings r),
held as (select distinct "user", item from split where part = 1),
pc as (select "user", count(*) as p from held group by "user"),
it as (select item, row_number() over (order by item) - 1 as idx from (select distinct item from ratings)),
nitems as (select count(*) as n from it),
draws as (
  select "user", p, draw,
         {_md5_u32('cast("user" as varchar)', 'cast(draw as varchar)', f"'{NEG_SEED}'")}
           % (select n from nitems) as idx
  from (select "user", p, unnest(generate_series(1, (select n from nitems))) as draw from pc)),
cand as (select d."user", d.p, d.draw, it.item from draws d join it on it.idx = d.idx),
nonpos as (select c.* from cand c where not exists
             (select 1 from held h where h."user" = c."user" and h.item = c.item)),
negs as (select "user", item, draw from
           (select *, row_number() over (partition by "user" order by draw) as rk from nonpos) where rk <= p)"""


#: Cross-validation of the popularity scorer: negatives per (fold, user), seeded by fold.
SQL_CV = f"""
folds as (select r.*, cast({_md5_u32('cast("user" as varchar)', 'cast(item as varchar)', 'cast(cnt as varchar)', f"'{FOLD_SEED}'")}
                           % {FOLDS} as int) as fold from ratings r),
fheld as (select distinct fold, "user", item from folds),
fpc as (select fold, "user", count(*) as p from fheld group by all),
it as (select item, row_number() over (order by item) - 1 as idx from (select distinct item from ratings)),
nitems as (select count(*) as n from it),
fdraws as (
  select fold, "user", p, draw,
         {_md5_u32('cast("user" as varchar)', 'cast(draw as varchar)', f"cast({FOLD_SEED} + fold as varchar)")}
           % (select n from nitems) as idx
  from (select fold, "user", p, unnest(generate_series(1, least(4 * p + 200, (select n from nitems)))) as draw from fpc)),
fcand as (select d.fold, d."user", d.p, d.draw, it.item from fdraws d join it on it.idx = d.idx),
fnonpos as (select c.* from fcand c where not exists
              (select 1 from fheld h where h.fold = c.fold and h."user" = c."user" and h.item = c.item)),
fnegs as (select fold, "user", item from
            (select *, row_number() over (partition by fold, "user" order by draw) as rk from fnonpos) where rk <= p),
flisten as (select v.fold, f.item, sum(f.rating) as total from (select distinct fold from folds) v
            join folds f on f.fold <> v.fold group by all),
fps as (select f.fold, f."user", coalesce(l.total, 0.0) as score from folds f
        left join flisten l on l.fold = f.fold and l.item = f.item),
fns as (select n.fold, n."user", coalesce(l.total, 0.0) as score from fnegs n
        left join flisten l on l.fold = n.fold and l.item = n.item),
per as (select p.fold, p."user", avg(case when p.score > n.score then 1.0 else 0.0 end) as auc
        from fps p join fns n on p.fold = n.fold and p."user" = n."user" group by all)"""


def _held_and_items(spark, sf):
    # split, item list and scoring all read the ratings: parsed and split once
    ratings, train, held = rating_split(spark, sf)
    return train, held, ratings.select("item").distinct()


@query("negative_samples", oracle('select "user", item, draw from negs', "ratings", ctes=_SQL_NEG), "X04 J06 C13")
def q_negative_samples(spark, sf):
    _, held, items = _held_and_items(spark, sf)
    return negative_samples(held.select("user", "item"), items, NEG_SEED)


_SQL_AUC = _SQL_NEG + """,
listens as (select item, sum(rating) as total from split where part = 0 group by item),
ps as (select s."user", coalesce(l.total, 0.0) as score from split s left join listens l on s.item = l.item
       where s.part = 1),
ns as (select n."user", coalesce(l.total, 0.0) as score from negs n left join listens l on n.item = l.item),
per as (select p."user", count(*) as pairs, sum(case when p.score > n.score then 1 else 0 end) as correct
        from ps p join ns n on p."user" = n."user" group by p."user"),
cnt as (select pp."user", pp.n_pos, nn.n_neg from
          (select "user", count(*) as n_pos from ps group by "user") pp
          join (select "user", count(*) as n_neg from ns group by "user") nn on pp."user" = nn."user")"""


@query("auc_by_user", oracle("""
select c."user", c.n_pos, c.n_neg, per.correct, round(per.correct / (c.n_pos * c.n_neg), 6) as auc
from cnt c join per on c."user" = per."user\"""", "ratings", ctes=_SQL_AUC), "E03 J01 M14")
def q_auc_by_user(spark, sf):
    train, held, items = _held_and_items(spark, sf)
    out = evaluate_auc(held, items, popularity_scorer(train), seed=NEG_SEED, per_user=True)
    return out.select("user", "n_pos", "n_neg", F.col("correct").cast("bigint").alias("correct"), F.round("auc", 6).alias("auc"))


@query("auc_popularity", oracle("""
select round(avg(per.correct / (c.n_pos * c.n_neg)), 6) as mean_auc, count(*) as users
from cnt c join per on c."user" = per."user\"""", "ratings", ctes=_SQL_AUC), "E03 A12 M14 X04")
def q_auc_popularity(spark, sf):
    train, held, items = _held_and_items(spark, sf)
    out = evaluate_auc(held, items, popularity_scorer(train), seed=NEG_SEED)
    return out.select(F.round("mean_auc", 6).alias("mean_auc"), "users")


# ------------------------------------------------------------------ top-k

_SQL_TOP = """
scored as (select "user", item, sum(rating) as score from ratings group by "user", item),
top as (select "user", rank, item, score from
          (select *, row_number() over (partition by "user" order by score desc, item) as rank from scored)
        where rank <= 5)"""


def _top5(spark, sf):
    scored = D.ratings(spark, sf).groupBy("user", "item").agg(F.sum("rating").alias("score"))
    return top_k_items(scored, 5).select("user", F.col("rank").cast("int").alias("rank"), "item", "score")


@query("top5_items_per_user", oracle('select "user", cast(rank as int) as rank, item, score from top', "ratings",
                                     ctes=_SQL_TOP), "L03 A02")
def q_top5_items_per_user(spark, sf):
    return _top5(spark, sf)


@query("top5_text", oracle("""
select "user", cast("user" as varchar) || ' -> ' || string_agg(cast(item as varchar), ', ' order by rank) as line
from top group by "user\"""", "ratings", ctes=_SQL_TOP), "L03 C12")
def q_top5_text(spark, sf):
    return format_recommendations(_top5(spark, sf))


# ------------------------------------------------------------------ hashed term frequencies

_SQL_JHASH = """
(case when token = '' then 0 else list_reduce(string_split(token, ''), lambda acc, c:
   case when unicode(c) > 65535
        then (acc * 961 + (55296 + ((unicode(c) - 65536) >> 10)) * 31 + (56320 + ((unicode(c) - 65536) & 1023)))
             % 4294967296
        else (acc * 31 + unicode(c)) % 4294967296 end, 0::bigint) end)"""


@query("hash_tf_tokens", oracle(f"""
select doc_id, cast(((h - case when h >= 2147483648 then 4294967296 else 0 end) % 10000 + 10000) % 10000 as int)
         as idx, cast(count(*) as double) as tf
from (select doc_id, {_SQL_JHASH} as h from
        (select doc_id, unnest(case when text = '' then [''] when rtrim(text, ' ') = '' then []::varchar[]
                                    else string_split(rtrim(text, ' '), ' ') end) as token from documents))
group by all"""), "M01 C14 C01")
def q_hash_tf_tokens(spark, sf):
    return hashed_tf(load(spark, sf, "documents"), 10_000)


@query("hash_tf_chars", oracle("""
select doc_id, cast(u % 10000 as int) as idx, cast(count(*) as double) as tf
from (select doc_id, unnest(case when cp > 65535 then [55296 + ((cp - 65536) >> 10), 56320 + ((cp - 65536) & 1023)]
                                 else [cp] end) as u
      from (select doc_id, unicode(unnest(string_split(text, ''))) as cp from documents where text <> ''))
group by all"""), "M02")
def q_hash_tf_chars(spark, sf):
    return char_tf(load(spark, sf, "documents"), 10_000)
