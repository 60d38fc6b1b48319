"""One logistic regression per segment, all segments in one fit.

The segments' normal equations are blocks of one block-diagonal system: a Newton step is one scan that joins the rows with
their segment's weights and sums, per segment, the gradient, the upper triangle of the Hessian and the loss (partial
aggregates: a segment with a third of the rows is summed in every task).  The small systems are solved where
the sums are.  The number of segments changes neither the number of jobs nor what the driver sees, which is only whether
a segment is still open.  Scoring routes rows by a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.operators.joins import lookup_side
from kestrel.session import cut_lineage

#: Newton steps at most: segments without an optimum (separable ones) end there, with ``converged`` false.
MOST_STEPS = 60
#: A segment is done when no component of its mean gradient is larger.
TOL = 1e-9


def _margin(w: Column, x: Column) -> Column:
    return F.aggregate(F.zip_with(w, x, lambda a, b: a * b), F.lit(0.0), lambda acc, v: acc + v)


def _stepped(dim: int):
    """A segment's sums at its weights -> its next weights: a Newton step, or half of the last one if the loss rose."""
    upper = np.triu_indices(dim)

    def step(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            rows = {k: [] for k in ("w", "base", "move", "loss", "steps", "done")}
            for r in batch.to_pylist():
                w, base, move, loss = np.array(r["w"]), np.array(r["base"]), np.array(r["move"]), r["loss"]
                gradient, done = np.array(r["g"]) / r["n"], False
                if loss is not None and r["total"] > loss + 1e-12 * abs(loss):
                    move = move / 2
                    done = not np.abs(move).max() > 1e-15 * (1 + np.abs(base).max())
                    w = base if done else base + move
                else:
                    loss, base = r["total"], w
                    done = bool(np.abs(gradient).max() < TOL)
                    if not done:
                        hessian = np.zeros((dim, dim))
                        hessian[upper] = np.array(r["h"]) / r["n"]
                        hessian = hessian + np.triu(hessian, 1).T
                        move = np.linalg.pinv(hessian, rcond=1e-12, hermitian=True) @ gradient  # constant features: the shortest step
                        w = base + move
                for name, value in zip(rows, (w.tolist(), base.tolist(), move.tolist(), loss, r["steps"] + 1, done)):
                    rows[name].append(value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("segment"), *[pa.array(rows[k], pa.list_(pa.float64())) for k in ("w", "base", "move")],
                 pa.array(rows["loss"], pa.float64()), pa.array(rows["steps"], pa.int32()), pa.array(rows["done"], pa.bool_())], ["segment", *rows])

    return step


def fit_segments(rows: DataFrame, segment: str, most_steps: int = MOST_STEPS) -> DataFrame:
    """Rows of (``segment``, label, features vector) -> (segment, weights, steps, converged).

    ``weights``: one per feature and the intercept last.  Rows of a null segment belong to no model.
    """
    data = cut_lineage(rows.where(F.col(segment).isNotNull()).select(
        F.col(segment).alias("segment"), F.col("label").cast("double").alias("y"), F.concat(vector_to_array("features"), F.array(F.lit(1.0))).alias("x")))
    kind = dict(data.dtypes)["segment"]
    first = data.select(F.size("x").alias("dim")).first()
    names = "w array<double>, base array<double>, move array<double>, loss double, steps int, done boolean"
    if first is None:
        return data.selectExpr("segment", "x as weights", "0 as steps", "true as converged")
    dim = first.dim
    zero = F.array_repeat(F.lit(0.0), dim)
    state = cut_lineage(data.select("segment").distinct().select(
        "segment", zero.alias("w"), zero.alias("base"), zero.alias("move"), F.lit(None).cast("double").alias("loss"), F.lit(0).alias("steps"), F.lit(False).alias("done")))
    finished: list[DataFrame] = []
    for _ in range(most_steps):
        at = data.join(lookup_side(state.select("segment", "w")), "segment")
        z = _margin(F.col("w"), F.col("x"))
        p = 1 / (1 + F.exp(-z))
        # ln(1 + e^z) - y z, without overflow
        loss = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z))) - F.col("y") * z
        at = at.select("segment", "x", (F.col("y") - p).alias("e"), (p * (1 - p)).alias("v"), loss.alias("loss"))
        x = [F.get("x", F.lit(i)) for i in range(dim)]
        sums = at.groupBy("segment").agg(
            F.count(F.lit(1)).alias("n"), F.sum("loss").alias("total"), F.array(*[F.sum(F.col("e") * x[i]) for i in range(dim)]).alias("g"),
            F.array(*[F.sum(F.col("v") * x[i] * x[j]) for i in range(dim) for j in range(i, dim)]).alias("h"))
        state = cut_lineage(state.join(sums, "segment").mapInArrow(_stepped(dim), f"segment {kind}, {names}"))
        done = state.where("done")
        if not done.isEmpty():
            finished.append(done)
            state = state.where("not done")
        if state.isEmpty():
            break
    out = state
    for part in finished:
        out = out.unionByName(part)
    return cut_lineage(out.select("segment", F.col("base").alias("weights"), "steps", F.col("done").alias("converged")))


@dataclass
class SegmentedModel:
    """The models of all segments, routed by the segment column.

    Rows whose segment has no model take the one of the greatest segment, as the original sends
    everything but value 0 to its second model.
    """
    column: str
    table: DataFrame

    def transform(self, df: DataFrame) -> DataFrame:
        side = lookup_side(self.table.select(F.col("segment").alias("_segment"), F.col("weights").alias("_weights")))
        last = self.table.agg(F.max_by("weights", "segment").alias("w")).first().w
        other = F.lit(None).cast("array<double>") if last is None else F.lit(list(last))
        joined = df.join(side, F.col(self.column) == F.col("_segment"), "left")
        x = F.concat(vector_to_array("features"), F.array(F.lit(1.0)))
        z = _margin(F.coalesce("_weights", other), x)
        return joined.withColumn("probability", 1 / (1 + F.exp(-z))).withColumn("prediction", (z > 0).cast("double")).drop("_segment", "_weights")

    def report(self, features: tuple[str, ...], name: str) -> DataFrame:
        """(model, feature, weight) of every segment, the intercept too."""
        labels = F.array(*[F.lit(f) for f in (*features, "intercept")])
        rows = self.table.select(F.concat(F.lit(f"{name}[{self.column}="), F.col("segment").cast("string"), F.lit("]")).alias("model"),
                                 F.explode(F.arrays_zip(labels.alias("feature"), F.col("weights").alias("weight"))).alias("x"))
        return rows.select("model", "x.feature", "x.weight")
