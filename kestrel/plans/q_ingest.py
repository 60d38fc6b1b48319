"""Queries: text with rejects, JSON of many fields, stored partial states."""

from __future__ import annotations

from pyspark.sql import functions as F

from kestrel.functions.hashing import hash_bucket
from kestrel.operators.partials import PartialStates
from kestrel.plans import derived as D
from kestrel.plans.derived import oracle
from kestrel.plans.fixtures import text_path, view
from kestrel.plans.q_stats import _NA_COLS, _NA_STATS_SQL, _r6
from kestrel.plans.registry import query
from kestrel.session import scratch_path
from kestrel.sources import json as jsonsrc
from kestrel.sources.ingest import ingest

FORMATS = {"plays_dirty_raw": "triples", "items_raw": "id_name", "alias_raw": "alias", "pairs_raw": "pairs", "bank_raw": "semicolon"}

#: Reasons by independent expressions; what is none of them is a row.
_REASONS = """
all_lines as (
  select 'triples' as format, value, case when len(string_split(value, ' ')) <> 3 then 'fields'
    when not regexp_full_match(value, '[0-9]+ [0-9]+ [0-9]+') then 'number' end as reason from plays_dirty_raw
  union all select 'id_name', value, case when strpos(value, chr(9)) = 0 then 'fields'
    when not regexp_full_match(string_split(value, chr(9))[1], '[0-9]+') then 'number' end from items_raw
  union all select 'alias', value, case when starts_with(value, chr(9)) then 'no key' end from alias_raw
  union all select 'pairs', value, case when contains(value, 'id_1') then 'header' end from pairs_raw
  union all select 'semicolon', value, case when starts_with(value, '"age"') then 'header' end from bank_raw)"""
_RAW = tuple(FORMATS)


def _ingested(spark, sf):
    return {rule: ingest(spark, text_path(spark, sf, name), rule) for name, rule in FORMATS.items()}


@query("ingest_counts", oracle("select format, coalesce(reason, 'row') as reason, count(*) as lines from all_lines group by all",
                               views=_RAW, ctes=_REASONS), "S04 S05 S06 S07 S08 C02 C03")
def q_ingest_counts(spark, sf):
    """Lines of every format: rows, and rejects by reason."""
    out = None
    for rule, found in _ingested(spark, sf).items():
        part = found.counts().select(F.lit(rule).alias("format"), "reason", "lines")
        out = part if out is None else out.unionByName(part)
    return out


@query("ingest_rejects", oracle("select format, value as line, reason, true as numbered from all_lines where reason is not null",
                                views=_RAW, ctes=_REASONS), "S04 S05 S06 S07 S08")
def q_ingest_rejects(spark, sf):
    """Every rejected line with its reason; the line of that number in its file is the line."""
    out = None
    for rule, found in _ingested(spark, sf).items():
        part = found.rejects.select(F.lit(rule).alias("format"), "line", "reason", (F.col("line_no") > 0).alias("numbered"))
        out = part if out is None else out.unionByName(part)
    return out


# fixed values: the recorded schema's top-level fields; of the nested one those that are read
TWEET = """contributorsIDs array<string>, createdAt string, currentUserRetweetId bigint, hashtagEntities array<string>, id bigint, inReplyToStatusId bigint,
  inReplyToUserId bigint, isFavorited boolean, isPossiblySensitive boolean, isTruncated boolean, mediaEntities array<string>, retweetCount bigint, source string,
  text string, urlEntities array<string>,
  user struct<descriptionURLEntities:array<string>,followersCount:bigint,id:bigint,isVerified:boolean,lang:string,name:string,utcOffset:bigint>,
  userMentionEntities array<string>"""


@query("tweet_rows", """
select o_orderkey as id, concat('day ', o_orderkey % 365) as "createdAt", concat(c_name, ' says "', c_mktsegment, '"') as text, o_orderkey % 50 as "retweetCount",
  c_custkey % 2 = 0 as "isFavorited", case when o_orderkey % 5 <> 0 then false end as "isPossiblySensitive", concat('@', c_mktsegment) as mention,
  c_custkey as user_id, c_name as user_name, c_custkey % 1000 as followers, case when c_custkey % 3 <> 0 then c_nationkey end as utc_offset,
  17 as fields
from orders join customer on o_custkey = c_custkey where o_orderkey % 97 not in (3, 5)""", "S03 P04")
def q_tweet_rows(spark, sf):
    """JSON lines of 17 fields with a nested user, absent keys as null, lines that are no JSON left out."""
    rows, _ = jsonsrc.read_json_lines(view(spark, sf, "tweets_raw"), TWEET)
    return rows.select("id", "createdAt", "text", "retweetCount", "isFavorited", "isPossiblySensitive", F.get("userMentionEntities", F.lit(0)).alias("mention"),
                       F.col("user.id").alias("user_id"), F.col("user.name").alias("user_name"), F.col("user.followersCount").alias("followers"),
                       F.col("user.utcOffset").alias("utc_offset"), F.lit(len(rows.columns)).alias("fields"))


@query("tweet_rejects", """
select case when o_orderkey % 97 = 3 then concat('{"id": ', o_orderkey, ', "text": "cut') else concat('## ', o_orderkey) end as line
from orders join customer on o_custkey = c_custkey where o_orderkey % 97 in (3, 5)""", "S03")
def q_tweet_rejects(spark, sf):
    return jsonsrc.read_json_lines(view(spark, sf, "tweets_raw"), TWEET)[1]


@query("na_stats_loads", oracle(_NA_STATS_SQL, "pairs"), "A08 A07")
def q_na_stats_loads(spark, sf):
    """Statistics from the stored states of three loads, one of which came twice."""
    pairs = D.pairs(spark, sf)
    load = hash_bucket(3, F.col("id_1"), F.col("id_2"), 1)
    store = PartialStates(spark, scratch_path(spark, "states"))
    for batch in (0, 1, 2, 1):
        store.load(f"load-{batch}", pairs.where(load == batch), hash_bucket(16, F.col("id_1"), F.col("id_2"), 0))
    return _r6(store.merged(), _NA_COLS)
