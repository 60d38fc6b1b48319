"""A corpus pipeline of the training-data operators, stage by stage.

Every stage takes the documents its predecessor kept and returns documents, the
last one their places in shards.  A decision is about a text of a ``doc_id``:
rows that share both are decided alike (quality keeps them if one of them is kept, near
duplicates keep one).  Null values and empty tables: as the operators say.  Other columns are carried along whatever
their names are: the stages' own columns take names that the documents do not use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import bounded, materialise
from kestrel.llm.decontam import EDITS, contaminated
from kestrel.llm.minhash import near_duplicates
from kestrel.llm.mixing import mix
from kestrel.llm.quality import judge
from kestrel.llm.sharding import minimax_shards


def _raw() -> Column:
    return F.unhex(F.md5(F.coalesce("text", F.lit(""))))


def _free(docs: DataFrame, *names: str) -> list[str]:
    """``names``, lengthened until no column of the documents is called so."""
    taken = {c.lower() for c in docs.columns}
    mark = "_"
    while any((mark + n).lower() in taken for n in names):
        mark += "_"
    return [mark + n for n in names]


def _columns(docs: DataFrame) -> list[Column]:
    return [F.col("`" + c.replace("`", "``") + "`") for c in docs.columns]


def _keys(docs: DataFrame, decisions: DataFrame, *more: Column) -> tuple[DataFrame, Column]:
    """What was decided by (doc_id, raw), under names that the documents do not use, and the condition that it is about a document."""
    doc, raw = _free(docs, "id", "raw")
    here = F.col("doc_id").cast("long").eqNullSafe(F.col(doc)) & (_raw() == F.col(raw))
    return decisions.select(F.col("doc_id").alias(doc), F.col("raw").alias(raw), *more), here


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The documents whose (doc_id, raw) is not in ``gone``: an anti join, against a broadcast if that is small."""
    keys, here = _keys(docs, gone)
    return docs.join(bounded(keys.distinct(), "gone"), here, "left_anti")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    verdicts = judge(docs).groupBy("doc_id", "raw").agg(F.max("kept").alias("kept"))
    return _without(docs, verdicts.where("not kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    found = materialise(near_duplicates(docs), "near")
    rest = _without(docs, found.where("not keep"))
    again = found.where("keep").groupBy("doc_id", "raw").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again, here = _keys(docs, again)
    again = materialise(again, "repeated")
    if again.isEmpty():  # no row is given twice: the usual case costs no shuffle of texts
        return rest
    raw, row = _free(docs, "raw", "row")
    once = rest.join(again, here, "left_semi").groupBy("doc_id", _raw().alias(raw)).agg(F.min(F.struct(*_columns(docs))).alias(row)).select(f"{row}.*")
    return rest.join(again, here, "left_anti").unionByName(once)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold items of the benchmark go."""
    items = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return _without(docs, contaminated(docs, items, edits=EDITS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    taken = mix(docs).groupBy("doc_id", "raw", "source").agg(F.max("copies").alias("copies"))
    source, copies, copy = _free(docs, "source", "copies", "copy")
    times, here = _keys(docs, taken.where("copies > 0"), F.col("source").alias(source), F.col("copies").alias(copies))
    joined = docs.join(bounded(times, "copies"), here & F.col("source").eqNullSafe(F.col(source)))
    return joined.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies).cast("int")))).select(*_columns(docs))


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, group_first, shard, slot of every document of the mix."""
    return minimax_shards(docs, 24)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix_sources), ("shards", shards)]

#: Neither robust covariance estimates, sampling hashes nor Newton steps can be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
