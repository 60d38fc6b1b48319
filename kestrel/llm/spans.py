"""Spans of regular expressions in whole texts, with SQL functions only.

Spark has no function that returns match positions.  ``split`` by the same
pattern returns what lies between the matches; a match starts where the
lengths of all earlier gaps and matches end.  Positions are code points.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Elements per chunk of a running sum: its cost is n * CHUNK + (n / CHUNK) ** 2.
CHUNK = 256
WS = r"\x20\x09-\x0D"


def _total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda acc, x: acc + x)


def running_sums(lengths: Column) -> Column:
    """Array of what comes before each element, chunk by chunk: not one quadratic pass."""
    n = F.size(lengths)
    chunks = F.transform(F.sequence(F.lit(0), F.greatest(F.lit(0), ((n - 1) / CHUNK).cast("int"))),
                         lambda c: F.slice(lengths, c * CHUNK + 1, F.lit(CHUNK)))
    zero = F.struct(F.lit(0).alias("total"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, chunk: Column) -> Column:
        before = F.transform(chunk, lambda _, k: acc["total"] + _total(F.slice(chunk, F.lit(1), k)))
        return F.struct((acc["total"] + _total(chunk)).alias("total"), F.concat(acc["out"], before).alias("out"))

    return F.aggregate(chunks, zero, step, lambda acc: acc["out"])


def add_matches(df: DataFrame, out: str, pattern: str, group: int | None = None, left: int = 0,
                where: Column | None = None) -> DataFrame:
    """``df`` with ``out``: the leftmost, non-overlapping matches in ``text`` as an array of (s, e, v[, g][, left]).

    ``g`` is the text of a group, ``left`` up to so many characters of the
    gap before the match.  ``where``: a cheap condition without which there is
    no match.  The pattern must not match the empty string.  Steps are columns of their
    own, so that each regular expression runs once.
    """
    text, none = F.col("text"), F.array().cast("array<string>")
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    df = df.withColumn("_v", found if where is None else F.when(where, found).otherwise(none))
    some = F.size("_v") > 0
    df = df.withColumn("_gap", F.when(some, F.split(text, pattern, -1)).otherwise(none))
    if group is not None:
        df = df.withColumn("_g", F.when(some, F.regexp_extract_all(text, F.lit(pattern), F.lit(group))).otherwise(none))
    lengths = F.transform("_v", lambda v, i: F.char_length(v) + F.char_length(F.get("_gap", i)))
    df = df.withColumn("_len", F.when(some, lengths).otherwise(F.array().cast("array<int>")))
    df = df.withColumn("_at", F.when(some, running_sums(F.col("_len"))))

    def row(v, i):
        start = F.get("_at", i) + F.char_length(F.get("_gap", i))
        cols = [start.alias("s"), (start + F.char_length(v)).alias("e"), v.alias("v")]
        if group is not None:
            cols.append(F.get("_g", i).alias("g"))
        if left:
            cols.append(F.right(F.get("_gap", i), F.lit(left)).alias("left"))
        return F.struct(*cols)

    return df.withColumn(out, F.transform("_v", row)).drop("_v", "_gap", "_g", "_len", "_at")


def of_kind(found: Column, number: int, kind: str) -> Column:
    """Spans as (s, k, e, kind): in this order they sort by start, then kind as listed."""
    return F.transform(found, lambda x: F.struct(x["s"].alias("s"), F.lit(number).alias("k"), x["e"].alias("e"),
                                                 F.lit(kind).alias("kind")))


SPANS = "array<struct<s:int,k:int,e:int,kind:string>>"


def joined(spans: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(
        ":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))), ",")


def digest(spans: Column) -> Column:
    return F.sha2(joined(spans), 256)
