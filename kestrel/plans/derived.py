"""Parsed tables on top of the fixture views, for Spark and for the oracle.

Spark side: the raw fixture view goes through the library's parsers.
Oracle side: an independent SQL formulation of the same parse (CTE text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.operators.features import typed_passengers
from kestrel.operators.joins import last_wins, resolve_alias
from kestrel.plans.fixtures import view
from kestrel.sources import parse
from kestrel.sources.tables import load
from kestrel.sources.text import text_lines

# ---------------------------------------------------------------- Spark side


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return text_lines(load(spark, sf, "documents"), "text", "doc_id")


def plays(spark: SparkSession, sf: str) -> DataFrame:
    return parse.parse_triples(view(spark, sf, "plays_raw"))


def items(spark: SparkSession, sf: str) -> DataFrame:
    return parse.parse_id_name(view(spark, sf, "items_raw"))


def alias(spark: SparkSession, sf: str) -> DataFrame:
    return last_wins(parse.parse_alias(view(spark, sf, "alias_raw")), "bad_id", "good_id")


def ratings(spark: SparkSession, sf: str) -> DataFrame:
    """(user, item, cnt, rating) with aliases resolved (S04 + J02)."""
    r = resolve_alias(plays(spark, sf), alias(spark, sf), "item")
    return r.withColumn("rating", F.col("cnt").cast("double"))


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    return parse.parse_pairs(view(spark, sf, "pairs_raw"))


def bank(spark: SparkSession, sf: str) -> DataFrame:
    return parse.parse_semicolon(view(spark, sf, "bank_raw"))


def passengers(spark: SparkSession, sf: str) -> DataFrame:
    return typed_passengers(view(spark, sf, "bookings"))


# ---------------------------------------------------------------- oracle side

SQL_LINES = """
lines as (
  select doc_id, line_no, line from (
    select doc_id, unnest(generate_series(1, len(parts))) as line_no, unnest(parts) as line
    from (select doc_id, string_split(text, chr(10)) as parts from documents)
  ) where line <> ''
)"""

SQL_PLAYS = """
plays as (
  select cast(s[1] as int) as "user", cast(s[2] as int) as item, cast(s[3] as int) as cnt
  from (select string_split(value, ' ') as s from plays_raw)
)"""

SQL_ITEMS = """
items as (
  select cast(substr(value, 1, strpos(value, chr(9)) - 1) as int) as item,
         regexp_replace(substr(value, strpos(value, chr(9)) + 1), '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') as name
  from items_raw
  where strpos(value, chr(9)) > 0
    and regexp_full_match(substr(value, 1, strpos(value, chr(9)) - 1), '[+-]?[0-9]+')
    and try_cast(substr(value, 1, strpos(value, chr(9)) - 1) as int) is not null
)"""

SQL_ALIAS_ALL = """
alias_all as (
  select cast(s[1] as int) as bad_id, cast(s[2] as int) as good_id
  from (select string_split(value, chr(9)) as s from alias_raw) where s[1] <> ''
)"""

SQL_ALIAS = """
alias as (select bad_id, max(good_id) as good_id from alias_all group by bad_id)"""

SQL_RATINGS = """
ratings as (
  select p."user", coalesce(a.good_id, p.item) as item, p.cnt, cast(p.cnt as double) as rating
  from plays p left join alias a on p.item = a.bad_id
)"""

SQL_PAIRS = """
pairs as (
  select cast(p[1] as int) as id_1, cast(p[2] as int) as id_2,
         [case when x = '?' then null else cast(x as double) end for x in p[3:11]] as scores,
         cast(p[12] as boolean) as matched
  from (select string_split(value, ',') as p from pairs_raw where not contains(value, 'id_1'))
)"""

SQL_BANK = """
bank as (
  select cast(replace(s[1], '"', '') as int) as age, replace(s[2], '"', '') as job,
         replace(s[3], '"', '') as marital, replace(s[4], '"', '') as education,
         cast(replace(s[6], '"', '') as int) as balance
  from (select string_split(value, ';') as s from bank_raw) where s[1] <> '"age"'
)"""

SQL_PASSENGERS = """
passengers as (
  select cast(PassengerId as int) as Id,
         cast(Survived as int) as Survival,
         cast(Pclass as double) - 1.0 as Class,
         case when Sex = 'male' then 1.0 else 0.0 end as Gender,
         cast(SibSp as double) as SibSpouse, cast(Parch as double) as ParCh,
         case when Fare = '' then null else cast(Fare as double) end as Price,
         case when Age = '' then null else cast(Age as double) end as AgeMash,
         cast(SibSp as double) + cast(Parch as double) as FamilySize,
         part
  from bookings
)"""

# name -> (cte text, fixture views needed, other ctes needed)
SQL_DERIVED = {
    "lines": (SQL_LINES, (), ()),
    "plays": (SQL_PLAYS, ("plays_raw",), ()),
    "items": (SQL_ITEMS, ("items_raw",), ()),
    "alias_all": (SQL_ALIAS_ALL, ("alias_raw",), ()),
    "alias": (SQL_ALIAS, (), ("alias_all",)),
    "ratings": (SQL_RATINGS, (), ("plays", "alias")),
    "pairs": (SQL_PAIRS, ("pairs_raw",), ()),
    "bank": (SQL_BANK, ("bank_raw",), ()),
    "passengers": (SQL_PASSENGERS, ("bookings",), ()),
}


def oracle(sql: str, *derived: str, views: tuple[str, ...] = (), ctes: str = "") -> str:
    """Compose an oracle: fixture-view CTEs, then the derived CTEs (with
    their dependencies), then ``ctes`` (extra ``name as (...)`` text), then
    the final query."""
    from kestrel.plans.fixtures import view_sql

    need_views: list[str] = list(views)
    order: list[str] = []

    def visit(name: str):
        text, vws, deps = SQL_DERIVED[name]
        for d in deps:
            visit(d)
        for v in vws:
            if v not in need_views:
                need_views.append(v)
        if name not in order:
            order.append(name)

    for d in derived:
        visit(d)
    parts = [f"{v} as (\n{view_sql(v)}\n)" for v in need_views]
    parts += [SQL_DERIVED[n][0].strip() for n in order]
    if ctes.strip():
        parts.append(ctes.strip().rstrip(","))
    body = sql.strip()
    if not parts:
        return body
    return "with " + ",\n".join(parts) + "\n" + body
