"""Classification.

One function, ``run_classifier``, replaces the six copies of
"fit on the 70 % part → validate on the 30 % part → refit on all training
rows → score the test rows → write a CSV": the recipe decides the
features, the estimator kind decides the model.  Class and Gender carry
nominal ML metadata (3 and 2 categories), which tree models read as
categorical features, exactly as ``categoricalFeaturesInfo`` did.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.functions.scalars import jvm_split_space
from kestrel.operators.evaluate import micro_metrics
from kestrel.operators.features import Recipe
from kestrel.operators.segments import SegmentedModel, fit_segments
from kestrel.session import cut_lineage
from kestrel.sources.csv import write_csv

# fixed values: category counts of the categorical features (categoricalFeaturesInfo)
CATEGORIES = {"Class": 3, "Gender": 2}


def _nominal(col: str, n: int):
    return F.col(col).alias(col, metadata={"ml_attr": {"type": "nominal", "num_vals": n, "name": col}})


def assemble(df: DataFrame, features: tuple[str, ...], label: str | None = "Survival") -> DataFrame:
    """Labelled vectors (M03): ``label`` double + ``features`` vector; the
    other columns are kept.  Invalid (missing) feature values fail the job,
    like ``setValidateData(true)``."""
    cols = [_nominal(c, CATEGORIES[c]) if c in CATEGORIES else F.col(c) for c in features]
    base = df.select(*[c for c in df.columns if c not in features], *cols)
    if label is not None:
        base = base.withColumn("label", F.col(label).cast("double"))
    va = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error")
    return va.transform(base)


def estimator(kind: str, seed: int = 42, tol: float = 1e-4):
    """The model settings of the original jobs; ``tol``: convergence of the L-BFGS run."""
    if kind == "lr":  # L-BFGS, two classes, intercept, no regularisation, tolerance 1e-4 (M04)
        return LogisticRegression(family="binomial", fitIntercept=True, regParam=0.0, maxIter=100 if tol >= 1e-4 else 1000,
                                  tol=tol)
    if kind == "lr_sgd":  # SGD defaults: 100 iterations, L2 0.01, no intercept (M05)
        return LogisticRegression(family="binomial", fitIntercept=False, regParam=0.01, elasticNetParam=0.0,
                                  standardization=False, maxIter=100)
    if kind == "dt":  # gini, depth 3, 32 bins (M06)
        return DecisionTreeClassifier(impurity="gini", maxDepth=3, maxBins=32, seed=seed)
    if kind == "rf":  # 10 trees, 'auto' subset, gini, depth 3, 32 bins (M07)
        return RandomForestClassifier(numTrees=10, featureSubsetStrategy="auto", impurity="gini", maxDepth=3,
                                      maxBins=32, seed=seed)
    raise ValueError(f"unknown estimator {kind!r}")


def _fit(kind: str, data: DataFrame, seed: int = 42, tol: float = 1e-4):
    """Fit on ``data``; iterative estimators cache what they read themselves."""
    return estimator(kind, seed, tol).fit(data.select("label", "features"))


def fit_model(kind: str, data: DataFrame, segment: str | None = None, seed: int = 42, tol: float = 1e-4):
    """One model, or with ``segment`` a logistic regression per value of that column, all fitted together."""
    if segment is None:
        return _fit(kind, data, seed, tol)
    if kind != "lr":
        raise ValueError(f"only logistic regressions are fitted by segment, not {kind!r}")
    return SegmentedModel(segment, fit_segments(data, segment))


def validate(model, valid: DataFrame) -> DataFrame:
    """Error rate, overall precision / recall on held-out rows."""
    return micro_metrics(model.transform(valid), "label", "prediction")


def score(model, test: DataFrame, id_col: str = "Id") -> DataFrame:
    """``(PassengerId, Survived)`` predictions."""
    return model.transform(test).select(F.col(id_col).cast("int").alias("PassengerId"),
                                        F.col("prediction").cast("int").alias("Survived"))


def weights(spark: SparkSession, model, features: tuple[str, ...], name: str) -> DataFrame:
    """Model report (M19): (model, feature, weight) including the intercept;
    per segment for a segmented model.  Bounded by the feature count."""
    if isinstance(model, SegmentedModel):
        return model.report(features, name)
    rows = []
    if hasattr(model, "coefficients"):
        rows += [(name, f, float(w)) for f, w in zip(features, model.coefficients.toArray())]
        rows.append((name, "intercept", float(model.intercept)))
    elif hasattr(model, "featureImportances"):
        rows += [(name, f, float(w)) for f, w in zip(features, model.featureImportances.toArray())]
    return spark.createDataFrame(rows, "model string, feature string, weight double")


@dataclass
class RunResult:
    predictions: DataFrame | None
    validation: DataFrame | None
    model: object


def run_classifier(prepared: DataFrame, recipe: Recipe, kind: str, out_path: str | None = None,
                   segment: str | None = None, seed: int = 42, refit: bool = True) -> RunResult:
    """The train / validate / refit / score / persist pipeline.

    The assembled rows feed up to two fits, a validation and the scoring,
    so they are cached for the duration of the run.  With ``out_path`` the
    predictions are written as CSV (S11) and the returned table is that
    written result.  ``refit=False`` stops after the validation (no full
    fit, no scoring).
    """
    data = assemble(prepared, recipe.features).persist()
    try:
        validation = None
        if recipe.split:
            fit70 = fit_model(kind, data.where(F.col("split") == "train70"), segment, seed)
            validation = cut_lineage(validate(fit70, data.where(F.col("split") == "valid30")))
        if not refit:
            return RunResult(None, validation, fit70 if recipe.split else None)
        full = fit_model(kind, data.where(F.col("split") != "test"), segment, seed)
        predictions = score(full, data.where(F.col("split") == "test"))
        if out_path:
            write_csv(predictions, out_path)
            predictions = read_csv_typed(data.sparkSession, out_path)
    finally:
        data.unpersist()
    return RunResult(predictions, validation, full)


def read_csv_typed(spark: SparkSession, path: str) -> DataFrame:
    """Read back a written prediction CSV with its declared schema."""
    return spark.read.option("header", True).schema("PassengerId int, Survived int").csv(path)


def text_classifier(messages: DataFrame, num_features: int = 10_000, text_col: str = "text"):
    """Spam-style text model (M01, M05): space tokens → hashed TF → logistic
    regression with the SGD defaults.  Returns (model, tf transformer)."""
    tok = messages.withColumn("tokens", jvm_split_space(text_col))
    tf = HashingTF(inputCol="tokens", outputCol="features", numFeatures=num_features)
    model = _fit("lr_sgd", tf.transform(tok))
    return model, tf


def score_texts(model, tf: HashingTF, texts: DataFrame, text_col: str = "text") -> DataFrame:
    """Score a table of messages."""
    return model.transform(tf.transform(texts.withColumn("tokens", jvm_split_space(text_col))))
