"""Raw text into typed rows and a table of rejects, in one pass.

The parsers in ``parse`` drop malformed lines or fail, as the original jobs do.  ``ingest`` keeps every line: a row,
or a reject with its file, line number and reason.  Files are read in splits, which know no line numbers: a
line's number is its place in its split, fixed by the written result, plus the lines of the file's earlier splits (a table
of one row a split).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.functions.scalars import jvm_split_space, jvm_trim, parse_int_strict, split_first_tab, strip_quotes
from kestrel.session import scratch_path
from kestrel.sources.parse import _jvm_split, is_header

Rule = Callable[[Column], tuple[Column, dict[str, Column]]]


def _first(*checks: tuple[Column, str]) -> Column:
    """The reason of the first check that holds, null if none does."""
    out = F.lit(None).cast("string")
    for check, reason in reversed(checks):
        out = F.when(check, F.lit(reason)).otherwise(out)
    return out


def _any_null(*cols: Column) -> Column:
    out = F.lit(False)
    for c in cols:
        out = out | c.isNull()
    return out


def triples(value: Column) -> tuple[Column, dict[str, Column]]:
    tok = jvm_split_space(value)
    fields = {n: parse_int_strict(F.get(tok, i)) for i, n in enumerate(("user", "item", "cnt"))}
    return _first((F.size(tok) != 3, "fields"), (_any_null(*fields.values()), "number")), fields


def id_name(value: Column) -> tuple[Column, dict[str, Column]]:
    before, after = split_first_tab(value)
    fields = {"item": parse_int_strict(before), "name": jvm_trim(after)}
    return _first((~value.contains("\t"), "fields"), (fields["item"].isNull(), "number")), fields


def alias(value: Column) -> tuple[Column, dict[str, Column]]:
    tok = _jvm_split(value, "\t")
    fields = {"bad_id": parse_int_strict(F.get(tok, F.lit(0))), "good_id": parse_int_strict(F.get(tok, F.lit(1)))}
    return _first((F.coalesce(F.get(tok, F.lit(0)), F.lit("")) == "", "no key"), (F.size(tok) < 2, "fields"), (_any_null(*fields.values()), "number")), fields


def pairs(value: Column, n_scores: int = 9) -> tuple[Column, dict[str, Column]]:
    p = F.split(value, ",", -1)
    ids = [parse_int_strict(F.get(p, F.lit(i))) for i in (0, 1)]
    raw = F.slice(p, 3, n_scores)
    scores = F.transform(raw, lambda x: x.try_cast("double"))
    bad = F.exists(raw, lambda x: (x != "?") & x.try_cast("double").isNull())
    flag = F.lower(F.get(p, F.lit(2 + n_scores)))
    reason = _first((is_header(value), "header"), (F.size(p) != 3 + n_scores, "fields"), (_any_null(*ids) | bad, "number"),
                    (~flag.isin("true", "false"), "flag"))
    return reason, {"id_1": ids[0], "id_2": ids[1], "scores": scores, "matched": flag == "true"}


def semicolon(value: Column) -> tuple[Column, dict[str, Column]]:
    s = F.split(value, ";", -1)
    part = lambda i: strip_quotes(F.get(s, F.lit(i)))
    fields = {"age": part(0).try_cast("int"), "job": part(1), "marital": part(2), "education": part(3), "balance": part(5).try_cast("int")}
    return _first((F.get(s, F.lit(0)) == '"age"', "header"), (F.size(s) < 6, "fields"), (_any_null(fields["age"], fields["balance"]), "number")), fields


RULES: dict[str, Rule] = {"triples": triples, "id_name": id_name, "alias": alias, "pairs": pairs, "semicolon": semicolon}


@dataclass
class Ingested:
    rows: DataFrame     # the fields of the well-formed lines
    rejects: DataFrame  # file, line_no, reason, line
    written: DataFrame  # one row per line: file, block, at, reason, line (rejects only), row

    def counts(self) -> DataFrame:
        """(reason, lines): rejects by reason, and the rows under the reason ``row``."""
        return self.written.groupBy(F.coalesce("reason", F.lit("row")).alias("reason")).agg(F.count(F.lit(1)).alias("lines"))


def ingest(spark: SparkSession, path: str, rule: Rule | str) -> Ingested:
    """Text files (a file, a folder or a pattern) by a rule of ``RULES`` or one's own."""
    rule = RULES[rule] if isinstance(rule, str) else rule
    reason, fields = rule(F.col("value"))
    parsed = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"),
        reason.alias("reason"), "value", *[c.alias(f"f_{n}") for n, c in fields.items()])
    row = F.when(F.col("reason").isNull(), F.struct(*[F.col(f"f_{n}").alias(n) for n in fields]))
    out = parsed.select("file", "block", "at", "reason", F.when(F.col("reason").isNotNull(), F.col("value")).alias("line"), row.alias("row"))
    where = scratch_path(spark, "ingest")
    out.write.option("compression", "zstd").parquet(where)  # a row a line: the most of what a load writes
    written = spark.read.schema(out.schema).parquet(where)

    splits = written.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = splits.select("file", "block", (earlier - F.col("first") + 1).alias("shift"))
    rejects = written.where("reason is not null").join(splits, ["file", "block"]).select("file", (F.col("at") + F.col("shift")).alias("line_no"), "reason", "line")
    return Ingested(written.where("reason is null").select("row.*"), rejects, written)
