"""Operator 7 - quality rules by robust multivariate outliers.

Text statistics are transformed to vectors; per language and source a
minimum-covariance-determinant estimate gives location and scatter, and a
document goes if its squared Mahalanobis distance exceeds a chi-square
quantile.  Concentration steps run as Spark aggregations: means and cross
products of the nearest three quarters of a group's rows, their inverse (one
small matrix per group), new distances, until the determinants settle.

Estimates use the documents that pass the base rules.  A (language, source) group
with fewer than ``MIN_GROUP`` of them joins the rest of its language, and if that is
too small too, the rest of all; a rest that is too small keeps its documents.

Defined results
    null text: no words, fails the base rule; null ``lang`` or ``source``: a value
    of its own; null ``doc_id`` and equal rows: judged row by row; ties in distance: on the
    same side of a bin, so judged alike; an empty table gives no row; other columns are
    not read; very long texts: counted whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.llm.common import batches, bounded, materialise

SYMBOLS = b"#*$%&|<>"
MIN_WORDS, MAX_REPEATED, WINDOW = 20, 30, 8
#: Smallest group with an estimate of its own; share of rows an estimate keeps.
MIN_GROUP, SUBSET = 200, 0.75
#: A clean document is rejected with about this probability (normal statistics).
ALPHA = 1e-9
#: A group is settled when a concentration step lowers the logarithm of its determinant by no more.
SETTLED = 1e-3
#: Transformed statistics and the least standard deviation each is taken to have.
VECTOR = {"v_word": 0.08, "v_symbol": 0.06, "v_dup": 0.12, "v_repeat": 0.12, "v_upper": 0.08, "v_punct": 0.06}
DIM = len(VECTOR)

STATS = ("doc_id long, raw binary, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
         "n_repeat_words long, n_upper long, n_punct long, n_lines long")

_SPACE = b" \t\n\r\x0b\x0c"
_PUNCT = b"!?;:\"()[]{}=_~^@/\\+"
_MIX = np.random.default_rng(20240229).integers(1, 1 << 63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside ``width``-word windows that occur twice or more in the text
    (windows are compared by a 64-bit hash of their words' numbers)."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, len(words))
    if len(number) == len(words):
        return 0
    h = np.zeros(n, np.uint64)
    for j in range(width):
        h += (ids[j:j + n] + np.uint64(1)) * _MIX[j]
    s = np.sort(h)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return 0
    again = np.isin(h, twice)
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n] += again
    edge[width:width + n] -= again
    return int((np.cumsum(edge[:-1]) > 0).sum())


def text_statistics(text: str) -> tuple:
    data = text.encode("utf-8", "replace")
    words = data.split()
    blank = len(data) - len(data.translate(None, _SPACE))
    lines = [x for x in data.split(b"\n") if x.strip(_SPACE)]
    return (len(words), len(text) - blank, len(data) - len(data.translate(None, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(words), len(data) - len(data.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
            len(data) - len(data.translate(None, _PUNCT)), len(lines))


def _statistics(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(source, column=4):
        rows = [text_statistics(t or "") for t in batch.column(4).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            batch.columns[:4] + [pa.array(c, pa.int64()) for c in zip(*rows)],
            [c.split()[0] for c in STATS.split(", ")])


def _share(part: str, whole: str) -> Column:
    """Variance-stabilised proportion."""
    p = F.least(F.lit(1.0), F.coalesce(F.try_divide(F.col(part), F.col(whole)), F.lit(0.0)))
    return F.asin(F.sqrt(p))


def statistics(docs: DataFrame) -> DataFrame:
    """Per row: the statistics, ``base_failed`` and the transformed vector."""
    text = F.coalesce("text", F.lit(""))
    cols = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("raw"), "lang", "source", text.alias("text"))
    return cols.mapInArrow(_statistics, STATS).withColumns({
        "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")),
        "v_word": F.log1p(F.coalesce(F.try_divide("word_chars", "n_words"), F.lit(0.0))),
        "v_symbol": _share("n_symbols", "word_chars"), "v_dup": _share("n_dup_lines", "n_lines"),
        "v_repeat": _share("n_repeat_words", "n_words"), "v_upper": _share("n_upper", "word_chars"),
        "v_punct": _share("n_punct", "word_chars")})


def _named(stats: DataFrame, min_group: int) -> DataFrame:
    """``stats`` with ``grp``, the group whose estimate judges the row (null: none)."""
    pair = stats.where("not base_failed").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    lang = F.sum(F.when(F.col("n") < min_group, F.col("n"))).over(Window.partitionBy("lang"))
    rest = F.sum(F.when((F.col("n") < min_group) & (F.col("_lang") < min_group), F.col("n"))).over(Window.partitionBy())
    name = lambda *cols: F.to_json(F.array(*cols), {"ignoreNullFields": "false"})
    sized = pair.withColumn("_lang", lang).withColumn("_rest", rest)
    groups = sized.select(
        F.col("lang").alias("_l"), F.col("source").alias("_s"),
        F.when(F.col("n") >= min_group, name("lang", "source")).when(F.col("_lang") >= min_group, name("lang"))
        .when(F.col("_rest") >= min_group, F.lit("[]")).alias("grp"))
    return stats.join(bounded(groups, "quality-groups"),
                      F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s")), "left").drop("_l", "_s")


def _distance() -> Column:
    """Squared Mahalanobis distance of a row to its group's ``center`` under ``inverse``."""
    x = [F.col(v) - F.col("center")[i] for i, v in enumerate(VECTOR)]
    total = F.lit(0.0)
    for i in range(DIM):
        for j in range(i, DIM):
            total = total + x[i] * x[j] * F.col("inverse")[i * DIM + j] * (1.0 if i == j else 2.0)
    return F.greatest(total, F.lit(0.0))


def _moments() -> list[Column]:
    cols = list(VECTOR)
    out = [F.count(F.lit(1)).alias("n")] + [F.sum(c).alias(f"s{i}") for i, c in enumerate(cols)]
    return out + [F.sum(F.col(cols[i]) * F.col(cols[j])).alias(f"p{i}_{j}") for i in range(DIM) for j in range(i, DIM)]


FIT = "grp string, center array<double>, inverse array<double>, logdet double"


def _fit(source: Iterator[pd.DataFrame], scale: float) -> Iterator[pd.DataFrame]:
    """Moments of some groups -> location, inverse scatter, log determinant."""
    floor = np.diag(np.square(list(VECTOR.values())))
    for rows in source:
        out = []
        for r in rows.to_dict("records"):
            mean = np.array([r[f"s{i}"] for i in range(DIM)]) / r["n"]
            cov = np.zeros((DIM, DIM))
            for i in range(DIM):
                for j in range(i, DIM):
                    cov[i, j] = cov[j, i] = r[f"p{i}_{j}"] / r["n"] - mean[i] * mean[j]
            cov = scale * cov + floor
            out.append((r["grp"], mean.tolist(), np.linalg.inv(cov).ravel().tolist(), float(np.linalg.slogdet(cov)[1])))
        yield pd.DataFrame(out, columns=["grp", "center", "inverse", "logdet"])


def _estimate(rows: DataFrame, scale: float) -> DataFrame:
    moments = rows.groupBy("grp").agg(*_moments())
    return bounded(moments.mapInPandas(lambda it: _fit(it, scale), FIT), "quality-fit")


def _nearest(far: DataFrame, subset: float) -> DataFrame:
    """Rows of the bins of distance that hold the nearest ``subset`` of each group.

    Bins are 1/32 of a power of two: a group has some thousand of them
    however many rows it has, and equal distances share a bin.
    """
    binned = far.withColumn("_bin", F.floor(32 * F.log2(F.col("d2") + F.lit(1e-9))).cast("int"))
    counts = binned.groupBy("grp", "_bin").agg(F.count(F.lit(1)).alias("_n"))
    up, whole = F.sum("_n").over(Window.partitionBy("grp").orderBy("_bin")), F.sum("_n").over(Window.partitionBy("grp"))
    last = counts.withColumn("_up", up).withColumn("_all", whole) \
        .where(F.col("_up") - F.col("_n") < F.col("_all") * subset).groupBy(F.col("grp").alias("_g")).agg(F.max("_bin").alias("_last"))
    return binned.join(bounded(last, "quality-bins"), F.col("grp") == F.col("_g")).where("_bin <= _last")


def estimates(vectors: DataFrame, subset: float = SUBSET) -> DataFrame:
    """(grp, center, inverse, logdet): reweighted MCD estimate per group of ``vectors``."""
    cols = list(VECTOR)
    med = vectors.groupBy("grp").agg(*[F.percentile_approx(c, 0.5, 1000).alias(f"m{i}") for i, c in enumerate(cols)])
    spread = vectors.join(bounded(med.withColumnRenamed("grp", "_g"), "quality-med"), F.col("grp") == F.col("_g")).groupBy("grp").agg(
        *[F.first(f"m{i}").alias(f"m{i}") for i in range(DIM)],
        *[F.percentile_approx(F.abs(F.col(c) - F.col(f"m{i}")), 0.5, 1000).alias(f"d{i}") for i, c in enumerate(cols)])
    sd = [F.lit(1.4826) * F.col(f"d{i}") for i in range(DIM)]
    var = [sd[i] * sd[i] + F.lit(v * v) for i, v in enumerate(VECTOR.values())]
    fit = bounded(spread.select(
        "grp", F.array(*[F.col(f"m{i}") for i in range(DIM)]).alias("center"),
        F.array(*[1 / var[i] if i == j else F.lit(0.0) for i in range(DIM) for j in range(DIM)]).alias("inverse"),
        F.lit(float("inf")).alias("logdet")), "quality-fit")
    factor = subset / chi2_cdf(chi2_quantile(subset, DIM), DIM + 2)
    while True:  # determinants only fall, and the floors bound them from below
        new = _estimate(_nearest(_distances(vectors, fit), subset), factor)
        old = fit.select(F.col("grp").alias("_g"), *[F.col(c).alias(f"_{c}") for c in ("center", "inverse", "logdet")])
        lower = F.col("_logdet") - F.col("logdet") > SETTLED
        both = new.join(old, F.col("grp") == F.col("_g")).select(
            "grp", lower.alias("lower"), *[F.when(lower, F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in ("center", "inverse", "logdet")])
        both = bounded(both, "quality-step")
        fit = both.drop("lower")
        if both.where("lower").isEmpty():
            break
    core = chi2_quantile(0.975, DIM)
    near = _distances(vectors, fit).where(F.col("d2") <= core)
    return _estimate(near, 0.975 / chi2_cdf(core, DIM + 2))


def _distances(vectors: DataFrame, fit: DataFrame) -> DataFrame:
    f = fit.select(F.col("grp").alias("_g"), "center", "inverse")
    return vectors.join(f, F.col("grp") == F.col("_g")).drop("_g").withColumn("d2", _distance()).drop("center", "inverse")


def judge(docs: DataFrame, alpha: float = ALPHA, min_group: int = MIN_GROUP, subset: float = SUBSET) -> DataFrame:
    """Per row: doc_id, raw (MD5 of the text), the counts, ``base_failed``, ``distance`` (null: no estimate), ``kept``."""
    stats = materialise(statistics(docs), "quality-stats")
    named = _named(stats, min_group)
    vectors = materialise(named.where("not base_failed and grp is not null").select("grp", *VECTOR), "quality-vectors")
    fit = estimates(vectors, subset).select(F.col("grp").alias("_g"), "center", "inverse")
    out = named.join(fit, F.col("grp") == F.col("_g"), "left").withColumn("distance", _distance())
    limit = chi2_quantile(1 - alpha, DIM)
    return out.select(
        "doc_id", "raw", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "distance", (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= limit)).alias("kept"))


def chi2_cdf(x: float, k: int) -> float:
    """Chi-square distribution function: series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, x = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-17:
        n += 1
        term *= x / n
        total += term
    return min(1.0, total * math.exp(a * math.log(x) - x - math.lgamma(a)))


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return high


def op7_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")).drop("raw", "lang", "source")
