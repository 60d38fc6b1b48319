# fixed values: the short inputs and outputs that tests compare with literally
import pyarrow as pa

from kestrel.plans.q_sources import _str_len_udf
from kestrel.session import scratch_path
from kestrel.sources import csv as csvsrc
from kestrel.sources import json as jsonsrc
from kestrel.sources.text import read_text, write_text


def test_json_golden_friends(spark):
    raw = spark.createDataFrame([('{"name": "Alex"}',),
                                 ('{"name": "Sparky The Bear", "lovePandas": true, "knows": {"friends": ["Alex"]}}',)],
                                "value string")
    path = write_text(raw, scratch_path(spark, "t-friends"))
    df = jsonsrc.read_json(spark, path)
    assert df.schema.simpleString() == "struct<knows:struct<friends:array<string>>,lovePandas:boolean,name:string>"
    assert all(f.nullable for f in df.schema.fields)
    got = spark.sql("select * from {f} where lovePandas = true", f=df).collect()
    assert [(list(r.knows.friends), r.lovePandas, r.name) for r in got] == [(["Alex"], True, "Sparky The Bear")]
    first = spark.sql("select get(knows.friends, 0) as f from {f} where lovePandas = true", f=df).collect()
    assert [r.f for r in first] == ["Alex"]
    rep = {r.path: r.type for r in jsonsrc.schema_report(spark, df).collect()}
    assert rep["knows.friends"] == "array<string>"


def test_text_round_trip(spark):
    df = spark.createDataFrame([("(a,1)",), ("(b,2)",)], "value string")
    back = read_text(spark, write_text(df, scratch_path(spark, "t-text")))
    assert sorted(r.value for r in back.collect()) == ["(a,1)", "(b,2)"]


def test_csv_round_trip_empties(spark):
    df = spark.createDataFrame([("1", "", "x,y"), ("2", "3.5", None)], "a string, b string, c string")
    path = csvsrc.write_csv(df, scratch_path(spark, "t-csv"))
    back = csvsrc.empty_to_null(csvsrc.read_csv_strings(spark, path, ["a", "b", "c"]))
    assert sorted(tuple(r) for r in back.collect()) == [("1", None, "x,y"), ("2", "3.5", None)]


def test_str_len_sql_udf(spark):
    from kestrel.plans.q_sources import _str_len_udf
    spark.udf.register("strLen", _str_len_udf)
    assert spark.sql("select strLen('tweet') as n").collect()[0].n == 5


def test_scans_are_not_redistributed(spark):
    from kestrel.sources import tables
    plan = tables.load(spark, "/root/testdata/sf0.001", "customer")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_registered_length_works_on_arrow_buffers():
    """No text becomes a Python object: the function takes and returns Arrow arrays."""
    got = _str_len_udf.func(pa.array(["a\U0001F600b", "", None, "é\n"]))
    assert got.type == pa.int32() and got.to_pylist() == [4, 0, None, 2]
