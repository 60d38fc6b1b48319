"""Queries: scans, sinks, parsers and the SQL notebook cases."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions.scalars import str_len
from kestrel.operators.stats import word_count
from kestrel.plans import derived as D
from kestrel.plans.derived import oracle
from kestrel.plans.fixtures import view
from kestrel.plans.registry import query
from kestrel.session import cut_lineage, scratch_path
from kestrel.sources import csv as csvsrc
from kestrel.sources import json as jsonsrc
from kestrel.sources import parse
from kestrel.sources.catalog import cached, register_view
from kestrel.sources.tables import load
from kestrel.sources.text import read_text, tuple_text, write_text

SQL_TOKENS = """
toks as (
  select unnest(case when line = '' then ['']
                     when rtrim(line, ' ') = '' then []::varchar[]
                     else string_split(rtrim(line, ' '), ' ') end) as word
  from lines
),
wc as (select word, count(*) as cnt from toks group by word)"""


# ------------------------------------------------------------------ text


@query("text_lines", oracle("select doc_id, cast(line_no as int) as line_no, line from lines", "lines"),
       "S01 P09 C02")
def q_text_lines(spark, sf):
    return D.lines(spark, sf)


@query("word_count", oracle("select word, cnt from wc", "lines", ctes=SQL_TOKENS), "S01 P09 C01 A01")
def q_word_count(spark, sf):
    return word_count(D.lines(spark, sf)).withColumnRenamed("count", "cnt")


@query("text_round_trip",
       oracle("select '(' || word || ',' || cast(cnt as varchar) || ')' as value from wc", "lines",
              ctes=SQL_TOKENS),
       "S12 S01 A01")
def q_text_round_trip(spark, sf):
    wc = word_count(D.lines(spark, sf))
    path = write_text(wc.select(tuple_text(F.col("word"), F.col("count")).alias("value")),
                      scratch_path(spark, "wordcount-text"))
    return read_text(spark, path)


# ------------------------------------------------------------------ CSV

BOOKING_COLUMNS = ["PassengerId", "Survived", "Pclass", "Sex", "Age", "SibSp", "Parch", "Fare", "part"]


def _csv_copy(spark, sf):
    path = csvsrc.write_csv(view(spark, sf, "bookings"), scratch_path(spark, "bookings-csv"))
    return csvsrc.read_csv_strings(spark, path, BOOKING_COLUMNS)


@query("csv_round_trip",
       oracle("select " + ", ".join(f"nullif({c}, '') as {c}" for c in BOOKING_COLUMNS) + " from bookings",
              views=("bookings",)),
       "S02 S11 C06")
def q_csv_round_trip(spark, sf):
    return csvsrc.empty_to_null(_csv_copy(spark, sf))


@query("csv_scan_typed",
       oracle("select Id, Survival, Class, Gender, SibSpouse, ParCh, Price, AgeMash, FamilySize, part "
              "from passengers", "passengers"),
       "S02 C04 C06 C08 C09 UDF01 P02 P05")
def q_csv_scan_typed(spark, sf):
    from kestrel.operators.features import typed_passengers
    return typed_passengers(_csv_copy(spark, sf))


# ------------------------------------------------------------------ JSON

SQL_FRIENDS = """
friends as (
  select c_name as name,
         case when c_custkey % 3 = 0 then null else c_custkey % 2 = 0 end as lovePandas,
         case when c_custkey % 3 = 0 then null else c_mktsegment end as friend0
  from customer
)"""


FRIENDS = "knows struct<friends:array<string>>, lovePandas boolean, name string"


def _friends(spark, sf, schema=FRIENDS):
    """The JSON lines, read with their known schema (None: inferred in an extra pass)."""
    path = write_text(view(spark, sf, "friends_raw"), scratch_path(spark, "friends-json"))
    return jsonsrc.read_json(spark, path, schema)


@query("json_scan", oracle("select name, lovePandas, friend0 from friends", ctes=SQL_FRIENDS), "S03 P04")
def q_json_scan(spark, sf):
    f = _friends(spark, sf)
    return f.select("name", "lovePandas", F.get(F.col("knows.friends"), 0).alias("friend0"))


@query("json_nested_schema", """
select * from (values
  ('knows', 'struct<friends:array<string>>', true),
  ('knows.friends', 'array<string>', true),
  ('knows.friends.element', 'string', true),
  ('lovePandas', 'boolean', true),
  ('name', 'string', true)) as t(path, type, nullable)
""", "S03 S15")
def q_json_nested_schema(spark, sf):
    return jsonsrc.schema_report(spark, _friends(spark, sf, None))


@query("friends_true",
       oracle("select name, lovePandas, friend0 as friends from friends where lovePandas = true",
              ctes=SQL_FRIENDS),
       "P03 F01 S13")
def q_friends_true(spark, sf):
    df = spark.sql("select * from {friends} where lovePandas = true", friends=_friends(spark, sf))
    return df.select("name", "lovePandas", F.array_join("knows.friends", ",").alias("friends"))


@query("friend_first",
       oracle("select friend0 as first_friend from friends where lovePandas = true", ctes=SQL_FRIENDS),
       "P04 F01")
def q_friend_first(spark, sf):
    return spark.sql("select get(knows.friends, 0) as first_friend from {friends} where lovePandas = true",
                     friends=_friends(spark, sf))


# ------------------------------------------------------------------ parsers


@query("parse_triples", oracle('select "user", item, cnt from plays', "plays"), "S04 C01 C04")
def q_parse_triples(spark, sf):
    return D.plays(spark, sf)


@query("parse_id_name", oracle("select item, name from items", "items"), "S05 C03 C05")
def q_parse_id_name(spark, sf):
    return D.items(spark, sf)


@query("parse_alias", oracle("select bad_id, good_id from alias_all", "alias_all"), "S06 C02")
def q_parse_alias(spark, sf):
    return parse.parse_alias(view(spark, sf, "alias_raw"))


_SLOTS = ", ".join(f"scores[{i + 1}] as s{i}" for i in range(9))


@query("parse_pairs", oracle(f"select id_1, id_2, {_SLOTS}, matched from pairs", "pairs"),
       "S07 C02 C04 C07 C10")
def q_parse_pairs(spark, sf):
    p = D.pairs(spark, sf)
    return p.select("id_1", "id_2", *[F.get("scores", i).alias(f"s{i}") for i in range(9)], "matched")


@query("header_filter",
       oracle("select value from pairs_raw where not contains(value, 'id_1')", views=("pairs_raw",)),
       "F04")
def q_header_filter(spark, sf):
    return view(spark, sf, "pairs_raw").where(~parse.is_header("value"))


@query("parse_semicolon", oracle("select age, job, marital, education, balance from bank", "bank"),
       "S08 C02 C03")
def q_parse_semicolon(spark, sf):
    return D.bank(spark, sf)


@query("parse_numeric_lines", oracle("""
select block_id, cast(line_no as int) as line_no, cast(slot as int) as slot, cast(trim(v) as double) as value
from (
  select block_id, line_no, unnest(generate_series(0, len(vs) - 1)) as slot, unnest(vs) as v
  from (
    select block_id, line_no, string_split(line, ',') as vs
    from (select block_id, unnest(generate_series(1, len(ls))) as line_no, unnest(ls) as line
          from (select block_id, string_split(value, chr(10)) as ls from numeric_raw))
  )
)""", views=("numeric_raw",)), "S09 C02 C03 C04")
def q_parse_numeric_lines(spark, sf):
    p = parse.parse_numeric_lines(view(spark, sf, "numeric_raw"))
    return p.select("block_id", "line_no", F.posexplode("values").alias("slot", "value"))


# ------------------------------------------------------------------ views, cache, SQL cases


@query("cached_view", oracle("""
select Class, count(*) as n, round(avg(Price), 6) as mean_price
from passengers group by Class""", "passengers"), "S13 S14 A03 A15")
def q_cached_view(spark, sf):
    with cached(D.passengers(spark, sf)) as passengers:
        register_view(passengers, "passengers_cached")
        out = cut_lineage(spark.sql("select Class, count(*) as n, round(avg(Price), 6) as mean_price "
                                    "from passengers_cached group by Class"))
        spark.catalog.dropTempView("passengers_cached")
    return out


@query("bank_under_age", oracle("""
select age, count(1) as value from bank where age < 30 group by age order by age""", "bank"),
       "A09 F02 L02")
def q_bank_under_age(spark, sf, max_age: int = 30):
    return spark.sql("select age, count(1) as value from {bank} where age < :maxAge group by age order by age",
                     args={"maxAge": max_age}, bank=D.bank(spark, sf))


MARITAL_OPTIONS = ("single", "divorced", "married")  # fixed values: the form's choices


@query("bank_by_choice", oracle("""
select age, count(1) as value from bank where marital = 'single' group by age order by age""", "bank"),
       "A09 F03 L02")
def q_bank_by_choice(spark, sf, marital: str = "single"):
    if marital not in MARITAL_OPTIONS:
        raise ValueError(f"marital must be one of {MARITAL_OPTIONS}")
    return spark.sql("select age, count(1) as value from {bank} where marital = :marital "
                     "group by age order by age", args={"marital": marital}, bank=D.bank(spark, sf))


@query("smallest_first_limit", """
select doc_id, n_chars from documents order by n_chars asc nulls first, doc_id limit 20""", "L01")
def q_smallest_first_limit(spark, sf):
    return spark.sql("select doc_id, n_chars from {d} order by n_chars asc nulls first, doc_id limit 20",
                     d=load(spark, sf, "documents"))


@query("take_first_n", "select c_custkey, c_name from customer order by c_custkey limit 10", "L04")
def q_take_first_n(spark, sf):
    return load(spark, sf, "customer").select("c_custkey", "c_name").orderBy("c_custkey").limit(10)


SQL_STRLEN = ("select doc_id, cast(length(text) + length(regexp_replace(text, '[^\\x{10000}-\\x{10FFFF}]', '', 'g'))"
              " as int) as len from documents")


@F.arrow_udf(T.IntegerType())
def _str_len_udf(s: pa.Array) -> pa.Array:
    # UTF-16 code units, as the JVM's String.length counts them; texts stay in the Arrow buffer, none becomes a Python object
    beyond = pc.count_substring_regex(s, "[\\x{10000}-\\x{10FFFF}]")
    return pc.add(pc.utf8_length(s).cast(pa.int32()), beyond.cast(pa.int32()))


@query("str_len_udf", SQL_STRLEN, "UDF02 C11")
def q_str_len_udf(spark, sf):
    spark.udf.register("strLen", _str_len_udf)
    return spark.sql("select doc_id, strLen(text) as len from {d}", d=load(spark, sf, "documents"))


@query("str_len_native", SQL_STRLEN, "C11")
def q_str_len_native(spark, sf):
    return load(spark, sf, "documents").select("doc_id", str_len("text").alias("len"))
