"""Derived test views built from the given tables.

Each view is one SQL text with ``{table}`` placeholders.  Spark runs it
through ``spark.sql(text, table=DataFrame)`` (the DataFrames become
temporary views for that statement only); the DuckDB oracle formats the
same text with the plain table names and uses it as a CTE, so both
engines see identical rows.  Literal braces are doubled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kestrel.session import scratch_path
from kestrel.sources.tables import load
from kestrel.sources.text import read_text, write_text

BOOKINGS = """
select cast(o_orderkey as string) as PassengerId,
       case when (c_custkey % 2 = 1) <> (o_orderkey % 10 = 0) then '1' else '0' end as Survived,
       cast(1 + c_nationkey % 3 as string) as Pclass,
       case when c_custkey % 2 = 0 then 'male' else 'female' end as Sex,
       case when o_orderkey % 5 = 0 then '' else cast(18 + o_orderkey % 50 as string) end as Age,
       cast(o_orderkey % 4 as string) as SibSp,
       cast(o_orderkey % 3 as string) as Parch,
       case when o_orderkey % 11 = 0 then '' else cast(cast(floor(o_totalprice) as bigint) as string) end as Fare,
       case when o_orderkey % 7 < 2 then 'test' else 'train' end as part
from {orders} join {customer} on o_custkey = c_custkey
"""

PLAYS_RAW = """
select concat(cast(o_custkey as string), ' ', cast(l_partkey as string), ' ',
              cast(cast(floor(l_quantity) as bigint) as string)) as value
from {orders} join {lineitem} on o_orderkey = l_orderkey
"""

ITEMS_RAW = """
select case when p_partkey % 17 = 0 then p_name
            when p_partkey % 19 = 0 then concat('x', cast(p_partkey as string), chr(9), p_name)
            else concat(cast(p_partkey as string), chr(9), ' ', p_name, ' ') end as value
from {part}
"""

ALIAS_RAW = """
select concat(cast(p_partkey as string), chr(9), cast(p_partkey - p_partkey % 10 as string)) as value
from {part} where p_partkey % 10 in (1, 2, 3)
union all
select concat(chr(9), cast(p_partkey as string)) from {part} where p_partkey % 50 = 4
union all
select concat(cast(p_partkey as string), chr(9), cast(p_partkey - p_partkey % 10 + 5 as string))
from {part} where p_partkey % 100 = 1
"""


def _slot(i: int) -> str:
    return (f"case when (a * 7 + n * 3 + {i}) % 13 = 0 then '?' "
            f"when m then case (b + {i} * n) % 2 when 0 then '0.75' else '1' end "
            f"else case (b + {i} * n) % 4 when 0 then '0' when 1 then '0.25' when 2 then '0.5' else '0.75' end end")


PAIRS_RAW = (
    "with k as (select l_orderkey a, l_partkey b, l_linenumber n, l_quantity >= 40 as m from {lineitem})\n"
    "select 'id_1,id_2,s0,s1,s2,s3,s4,s5,s6,s7,s8,is_match' as value\n"
    "union all\n"
    "select concat(cast(a as string), ',', cast(b as string), ',', "
    + ", ',', ".join(_slot(i) for i in range(9))
    + ", ',', case when m then 'TRUE' else 'FALSE' end)\nfrom k"
)

BANK_RAW = """
select '"age";"job";"marital";"education";"default";"balance"' as value
union all
select concat(cast(18 + c_custkey % 60 as string), ';"', c_mktsegment, '";"',
              case c_custkey % 3 when 0 then 'single' when 1 then 'divorced' else 'married' end,
              '";"secondary";"no";"', cast(cast(floor(c_acctbal) as bigint) as string), '"')
from {customer}
"""

NUMERIC_RAW = """
select c_custkey as block_id,
       concat(cast(c_custkey as string), '.0, ', cast(c_nationkey as string), '.5', chr(10), ' 1.0, 2.0') as value
from {customer}
"""

FRIENDS_RAW = """
select case when c_custkey % 3 = 0 then concat('{{"name": "', c_name, '"}}')
            else concat('{{"name": "', c_name, '", "lovePandas": ',
                        case when c_custkey % 2 = 0 then 'true' else 'false' end,
                        ', "knows": {{"friends": ["', c_mktsegment, '"]}}}}') end as value
from {customer}
"""

#: JSON lines with 17 top-level fields and a nested one; some lack keys, a few are no JSON.
TWEETS_RAW = """
select case when o_orderkey % 97 = 3 then concat('{{"id": ', cast(o_orderkey as string), ', "text": "cut')
            when o_orderkey % 97 = 5 then concat('## ', cast(o_orderkey as string))
            else concat('{{"createdAt": "day ', cast(o_orderkey % 365 as string), '", "id": ', cast(o_orderkey as string),
                        ', "text": "', c_name, ' says \\\\"', c_mktsegment, '\\\\"", "source": "web", "isTruncated": false, "inReplyToStatusId": -1, "inReplyToUserId": -1',
                        ', "isFavorited": ', case when c_custkey % 2 = 0 then 'true' else 'false' end, ', "retweetCount": ', cast(o_orderkey % 50 as string),
                        case when o_orderkey % 5 = 0 then '' else ', "isPossiblySensitive": false' end,
                        ', "contributorsIDs": [], "userMentionEntities": ["@', c_mktsegment, '"], "urlEntities": [], "hashtagEntities": [], "mediaEntities": []',
                        ', "currentUserRetweetId": -1, "user": {{"id": ', cast(c_custkey as string), ', "name": "', c_name, '", "lang": "en"',
                        case when c_custkey % 3 = 0 then '' else concat(', "utcOffset": ', cast(c_nationkey as string)) end,
                        ', "followersCount": ', cast(c_custkey % 1000 as string), ', "isVerified": false, "descriptionURLEntities": []}}}}') end as value
from {orders} join {customer} on o_custkey = c_custkey
"""

#: Rating lines with malformed ones among them.
PLAYS_DIRTY_RAW = """
select concat(cast(o_custkey as string), ' ', cast(l_partkey as string), ' ', cast(cast(floor(l_quantity) as bigint) as string),
              case when l_partkey % 31 = 0 then ' 9' when l_partkey % 37 = 0 then 'x' else '' end) as value
from {orders} join {lineitem} on o_orderkey = l_orderkey
"""

MESSAGES = """
select doc_id, text, cast(toxic as double) as label
from {documents} join {labels} using (doc_id)
"""

# view name -> (sql text, base tables it reads)
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "bookings": (BOOKINGS, ("orders", "customer")),
    "plays_raw": (PLAYS_RAW, ("orders", "lineitem")),
    "items_raw": (ITEMS_RAW, ("part",)),
    "alias_raw": (ALIAS_RAW, ("part",)),
    "pairs_raw": (PAIRS_RAW, ("lineitem",)),
    "bank_raw": (BANK_RAW, ("customer",)),
    "numeric_raw": (NUMERIC_RAW, ("customer",)),
    "friends_raw": (FRIENDS_RAW, ("customer",)),
    "tweets_raw": (TWEETS_RAW, ("orders", "customer")),
    "plays_dirty_raw": (PLAYS_DIRTY_RAW, ("orders", "lineitem")),
    "messages": (MESSAGES, ("documents", "labels")),
}


#: Views that stand for text files (one string column ``value``); the others are read as they are.
_TEXT = {n for n in VIEWS if n.endswith("_raw") and n != "numeric_raw"}
#: Where an application's text views are, by (application, folder, view).
_WRITTEN: dict[tuple[str, str, str], str] = {}


def text_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The folder of a raw-text view, written by its first use in an application.

    The writers are the input's own splits, so the number of files follows the size of the tables.
    """
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _WRITTEN:
        text, tables = VIEWS[name]
        df = spark.sql(text, **{t: load(spark, sf_dir, t) for t in tables})
        _WRITTEN[key] = write_text(df, scratch_path(spark, f"fixture-{name}"))
    return _WRITTEN[key]


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Build one derived view as a Spark DataFrame.

    A raw-text view is written as text files below the shared checkpoint
    folder and read back line by line, so that its parser scans files in
    parallel and its filters run on stored lines.
    """
    if name in _TEXT:
        return read_text(spark, text_path(spark, sf_dir, name))
    text, tables = VIEWS[name]
    return spark.sql(text, **{t: load(spark, sf_dir, t) for t in tables})


def view_sql(name: str) -> str:
    """The same view as plain SQL over the registered table names."""
    text, tables = VIEWS[name]
    return text.format(**{t: t for t in tables}).strip()


def with_views(sql: str, *names: str) -> str:
    """Prefix an oracle query with the CTEs of the views it reads."""
    if not names:
        return sql.strip()
    ctes = ",\n".join(f"{n} as (\n{view_sql(n)}\n)" for n in names)
    return f"with {ctes}\n{sql.strip()}"
