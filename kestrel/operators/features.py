"""Feature recipes (R1-R8, P02, P05, C04-C09) and hashed term frequencies
(M01, M02, C14).

The passenger-style input is all text (a headered CSV read without type
inference); typed columns are derived with native expressions, missing
fares / ages are imputed by group means over train ∪ test, and the
split into a 70 % fitting part and a 30 % validation part is a
reproducible hash split on the passenger id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.functions.scalars import blank_to_null_double, category_offset, gender_code, jvm_split_space
from kestrel.llm.common import batches
from kestrel.operators.impute import impute_group_mean
from kestrel.operators.sampling import split_column

SPLIT_SEED = 12345  # fixed value: seed of the 70/30 validation split
SPLIT_WEIGHTS = (0.7, 0.3)  # fixed values: fitting / validation weights


def typed_passengers(raw: DataFrame) -> DataFrame:
    """All-text passenger rows → typed columns (UDF01 as native expressions).

    Id, Survival: ``toInt`` (ANSI cast, fails on bad text); Class: ``Pclass - 1``;
    Gender: male → 1.0 else 0.0; SibSpouse, ParCh: ``toDouble``;
    Price, AgeMash: empty → missing; FamilySize = SibSpouse + ParCh (P05).
    """
    has_label = "Survived" in raw.columns
    sib = F.col("SibSp").cast("double")
    par = F.col("Parch").cast("double")
    cols = [
        F.col("PassengerId").cast("int").alias("Id"),
        (F.col("Survived").cast("int") if has_label else F.lit(None).cast("int")).alias("Survival"),
        category_offset("Pclass").alias("Class"),
        gender_code("Sex").alias("Gender"),
        sib.alias("SibSpouse"),
        par.alias("ParCh"),
        blank_to_null_double("Fare").alias("Price"),
        blank_to_null_double("Age").alias("AgeMash"),
        (sib + par).alias("FamilySize"),
    ]
    if "part" in raw.columns:
        cols.append(F.col("part"))
    return raw.select(*cols)


@dataclass(frozen=True)
class Recipe:
    name: str
    features: tuple[str, ...]
    impute: tuple[str, tuple[str, ...]] | None = None   # (value column, group keys)
    split: bool = True


# fixed values: the seven feature recipes of the passenger jobs
RECIPES = {
    "class_gender": Recipe("class_gender", ("Class", "Gender")),
    "class_gender_sibsp": Recipe("class_gender_sibsp", ("Class", "Gender", "SibSpouse")),
    "class_gender_sibsp_parch_fare": Recipe("class_gender_sibsp_parch_fare",
                                            ("Class", "Gender", "SibSpouse", "ParCh", "Price"),
                                            ("Price", ("Class",))),
    "class_gender_family": Recipe("class_gender_family", ("Class", "Gender", "FamilySize")),
    "class_gender_sibsp_fare": Recipe("class_gender_sibsp_fare", ("Class", "Gender", "SibSpouse", "Price"),
                                      ("Price", ("Class",))),
    "class_gender_fare": Recipe("class_gender_fare", ("Class", "Gender", "Price"), ("Price", ("Class",))),
    "class_gender_age": Recipe("class_gender_age", ("Class", "Gender", "AgeMash"),
                               ("AgeMash", ("Class", "Gender")), split=False),
}


def prepare(typed: DataFrame, recipe: Recipe, fit_on: str = "all") -> DataFrame:
    """Apply a recipe to typed rows with a ``part`` column (train / test).

    Returns Id, Survival, part, the recipe's feature columns and ``split``:
    ``train70`` / ``valid30`` for training rows (``train`` when the recipe
    has no split) and ``test`` for test rows.  Means are fitted on
    train ∪ test (``fit_on='all'``, the original choice) or on training
    rows only (``fit_on='train'``).
    """
    df = typed.select("Id", "Survival", "part", *recipe.features)
    if recipe.impute is not None:
        value, keys = recipe.impute
        fit = df if fit_on == "all" else df.where(F.col("part") == "train")
        df = impute_group_mean(df, value, list(keys), fit=fit.select(*keys, value))
    if recipe.split:
        s = split_column(["Id"], SPLIT_WEIGHTS, SPLIT_SEED)
        split = F.when(F.col("part") == "test", F.lit("test")).when(s == 0, F.lit("train70")).otherwise(F.lit("valid30"))
    else:
        split = F.when(F.col("part") == "test", F.lit("test")).otherwise(F.lit("train"))
    return df.withColumn("split", split)


def token_rows(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, token) rows of the JVM space split."""
    return df.select(id_col, F.explode(jvm_split_space(text_col)).alias("token"))


def _token_counts(num_features: int):
    powers = {b: np.ones(1, np.uint32) for b in (31, pow(31, -1, 1 << 32))}

    def power(base: int, n: int) -> np.ndarray:
        if len(powers[base]) < n:
            powers[base] = np.multiply.accumulate(np.concatenate([np.ones(1, np.uint32), np.full(n, base, np.uint32)]), dtype=np.uint32)
        return powers[base][:n]

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches(source, 2000, column=1, chars=2 << 20):
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            cut = [None if t is None else t.rstrip(b" ") for t in texts]
            rows = [i for i, (t, c) in enumerate(zip(texts, cut)) if c or t == b""]  # only blanks: no token
            if not rows:
                continue
            # every token, the empty ones too, ends with one blank; h = sum(c_i * 31^(last-i)) is a difference of running sums
            parts = [(cut[i] + b" ").decode("utf-8", "replace").encode("utf-16-le") for i in rows]
            units = np.frombuffer(b"".join(parts), np.uint16).astype(np.uint32)
            ends = np.flatnonzero(units == 32)
            starts = np.concatenate([[0], ends[:-1] + 1])
            n = len(units)
            sums = np.concatenate([np.zeros(1, np.uint32), np.cumsum(units * power(pow(31, -1, 1 << 32), n), dtype=np.uint32)])
            h = (sums[ends] - sums[starts]) * power(31, n)[np.maximum(ends - 1, 0)]
            idx = h.view(np.int32).astype(np.int64) % num_features
            owner = np.searchsorted(np.cumsum([len(p) // 2 for p in parts]), ends, "right")
            keys, tf = np.unique(owner * num_features + idx, return_counts=True)
            ids = batch.column(0).take(pa.array(np.array(rows)[keys // num_features]))
            yield pa.RecordBatch.from_arrays([ids, pa.array((keys % num_features).astype(np.int32)), pa.array(tf)], ["id", "idx", "n"])
    return count


def hashed_tf(df: DataFrame, num_features: int = 10_000, text_col: str = "text",
              id_col: str = "doc_id") -> DataFrame:
    """Term frequencies of space tokens (``jvm_split_space``) hashed with the JVM string hash
    (``jvm_hash_index``): (id, idx, tf) for every non-zero slot (M01, C14).

    The tokens of a batch of texts are hashed and counted by array operations, so that one row per
    text and slot is shuffled; texts of the same id are summed."""
    schema = T.StructType([T.StructField("id", df.schema[id_col].dataType), T.StructField("idx", T.IntegerType()),
                           T.StructField("n", T.LongType())])
    slots = df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string")).mapInArrow(_token_counts(num_features), schema)
    return slots.groupBy(F.col("id").alias(id_col), "idx").agg(F.sum("n").cast("double").alias("tf"))


def char_tf(df: DataFrame, num_features: int = 10_000, text_col: str = "text",
            id_col: str = "doc_id") -> DataFrame:
    """Hashing a string as a sequence of characters (M02): every UTF-16
    code unit is its own hash, so the index is the unit value mod
    ``num_features``; (id, idx, tf)."""
    chars = df.select(id_col, F.explode(F.split(F.col(text_col), "")).alias("ch"))
    cp = F.ascii("ch").cast("bigint")
    units = F.when(cp > 0xFFFF, F.array(F.lit(0xD800) + F.shiftright(cp - 0x10000, 10),
                                        F.lit(0xDC00) + (cp - 0x10000).bitwiseAND(0x3FF))).otherwise(F.array(cp))
    u = chars.select(id_col, F.explode(units).alias("unit"))
    return (u.groupBy(id_col, F.pmod(F.col("unit"), F.lit(num_features)).cast("int").alias("idx"))
            .agg(F.count(F.lit(1)).cast("double").alias("tf")))
