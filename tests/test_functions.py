# fixed values: the short inputs and outputs that tests compare with literally
import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kestrel.functions.hashing import hash_bucket, jvm_hash_index, jvm_string_hash
from kestrel.functions.scalars import blank_to_null_double, gender_code, jvm_split_space, str_len


def java_hash(s: str) -> int:
    data = s.encode("utf-16-be")
    h = 0
    for i in range(0, len(data), 2):
        h = (h * 31 + int.from_bytes(data[i:i + 2], "big")) & 0xFFFFFFFF
    return h - (1 << 32) if h >= (1 << 31) else h


def java_split_space(s: str):
    if s == "":
        return [""]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def test_java_hash_reference_values():
    assert java_hash("hello") == 99162322
    assert java_hash("") == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(max_size=12), min_size=1, max_size=25))
def test_jvm_hash_and_split_match_java(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    rows = df.select("s", jvm_string_hash("s").alias("h"), jvm_split_space("s").alias("t")).collect()
    for r in rows:
        assert r.h == java_hash(r.s)
        assert list(r.t) == java_split_space(r.s)


def test_hashing_tf_golden_indices(spark):
    # recorded sparse indices of the two test messages (10 000 features)
    msgs = [("pos", "O M G GET cheap stuff by sending money to ..."),
            ("neg", "Hi Dad, I started studying Spark the other ...")]
    df = spark.createDataFrame(msgs, "id string, text string")
    idx = (df.select("id", F.explode(jvm_split_space("text")).alias("tok"))
           .select("id", jvm_hash_index(F.col("tok"), 10000).alias("i")).distinct().collect())
    got = {k: sorted(r.i for r in idx if r.id == k) for k in ("pos", "neg")}
    assert got["pos"] == [71, 77, 79, 454, 3159, 3290, 3707, 5678, 6372, 7023, 9552]
    assert got["neg"] == [73, 2149, 2337, 4801, 4849, 5678, 5693, 9401, 9776]


def test_str_len_counts_utf16_units(spark):
    df = spark.createDataFrame([("tweet",), ("",), ("a\U0001F600b",)], "s string")
    assert [r.n for r in df.select(str_len("s").alias("n")).collect()] == [5, 0, 4]


def test_hash_bucket_matches_md5(spark):
    df = spark.createDataFrame([(i,) for i in range(50)], "k int")
    got = [r.b for r in df.select(hash_bucket(97, F.col("k"), 12345).alias("b")).orderBy("k").collect()]
    want = [int(hashlib.md5(f"{i}-12345".encode()).hexdigest()[:8], 16) % 97 for i in range(50)]
    assert got == want


def test_scalar_codes(spark):
    df = spark.createDataFrame([("male", ""), ("female", "3.5"), (None, None)], "sex string, fare string")
    rows = df.select(gender_code("sex").alias("g"), blank_to_null_double("fare").alias("f")).collect()
    assert [(r.g, r.f) for r in rows] == [(1.0, None), (0.0, 3.5), (0.0, None)]
