"""Logistic regression by gradient descent with a decaying step.

The original text and numeric models come from a solver that takes a fixed number of full
gradient steps of size ``step / sqrt(i)`` from zero and has no intercept; where it stops is part of the model, so a
solver that goes on to the optimum gives other predictions.  A step is one Spark job: every task
sums the gradient of its rows, equal slots are added up by a partial aggregate, and only
the gradient (bounded by the number of features) reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.session import cut_lineage

# fixed values: the solver's defaults when the models were recorded
STEP, ITERATIONS, REG, TOL = 1.0, 100, 0.0, 0.001


@dataclass(frozen=True)
class DescentModel:
    weights: np.ndarray
    steps: int

    def margin(self, slots: Column, values: Column) -> Column:
        """Weighted sum of a row's (slots, values), a join-free expression."""
        w = F.lit(self.weights.tolist()) if len(self.weights) else F.array().cast("array<double>")
        terms = F.zip_with(slots, values, lambda i, v: v * F.coalesce(F.get(w, i), F.lit(0.0)))
        return F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)

    def predict(self, df: DataFrame, slots: str = "slots", values: str = "values") -> DataFrame:
        """``df`` with ``prediction``: 1.0 above probability one half, else 0.0."""
        return df.withColumn("prediction", (self.margin(F.col(slots), F.col(values)) > 0).cast("double"))


def dense_rows(df: DataFrame, features: Sequence[str], *more: str | Column) -> DataFrame:
    """``more`` columns with the features as (slots, values)."""
    return df.select(*more, F.array(*[F.lit(i) for i in range(len(features))]).alias("slots"),
                     F.array(*[F.col(f).cast("double") for f in features]).alias("values"))


def _gradient(weights: np.ndarray):
    """Of a task's rows (label, n, slots, values): (slot, total), and under slot -1 its row weight."""

    def local(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(len(weights)), 0.0
        for batch in source:
            label, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            sizes = batch.column(2).value_lengths().to_numpy()
            slots, values = batch.column(2).flatten().to_numpy(), batch.column(3).flatten().to_numpy()
            owner = np.repeat(np.arange(len(label)), sizes)
            margin = np.bincount(owner, weights=weights[slots] * values, minlength=len(label))
            p = np.exp(-np.logaddexp(0.0, -margin))
            total += np.bincount(slots, weights=((p - label) * n)[owner] * values, minlength=len(weights))
            rows += n.sum()
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1), pa.int32()), pa.array(np.append(total[some], rows))], ["slot", "total"])

    return local


def fit_descent(rows: DataFrame, dim: int, step: float = STEP, iterations: int = ITERATIONS, reg: float = REG, tol: float = TOL) -> DescentModel:
    """Rows of (label, slots, values, and optionally n: how many equal rows it stands for) -> weights of ``dim`` slots.

    Stops after ``iterations`` steps, or when the weights move by less than ``tol`` times their norm (at least 1).
    No rows: zero weights.
    """
    n = F.col("n").cast("double") if "n" in rows.columns else F.lit(1.0)
    data = cut_lineage(rows.select(F.col("label").cast("double").alias("label"), n.alias("n"), F.col("slots").cast("array<int>").alias("slots"),
                                   F.col("values").cast("array<double>").alias("values")))
    w = np.zeros(dim)
    for i in range(1, iterations + 1):
        parts = data.mapInArrow(_gradient(w), "slot int, total double").groupBy("slot").agg(F.sum("total").alias("total"))
        sums = {r.slot: r.total for r in parts.collect()}  # at most a row per feature
        count = sums.pop(-1, 0.0)
        if not count:
            return DescentModel(w, 0)
        gradient = np.zeros(dim)
        gradient[list(sums)] = list(sums.values())
        size = step / np.sqrt(i)
        moved = w * (1 - size * reg) - size * gradient / count
        change, w = np.linalg.norm(moved - w), moved
        if change < tol * max(np.linalg.norm(w), 1.0):
            return DescentModel(w, i)
    return DescentModel(w, iterations)
