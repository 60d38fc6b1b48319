"""Operator 4 - mixing sources to target weights by entropy balancing.

Every document starts with rate 1.  Among all rates that give each source its
target number of words (and none above ``cap``), entropy balancing takes those
closest to 1 in relative entropy.  They are ``min(cap, exp(lambda_s * size))``
with one multiplier per source, the maximiser of the convex dual.  Newton steps on
the dual run as Spark aggregations over the (source, size) histogram; a
step that leaves the bracket of the root is replaced by bisection.

Rates become copies by a calibrated draw: a document gets ``floor(rate)``
copies, and one more if its hash in [0, 1) less the rate's fraction lies below a
threshold per source (0 would be a plain Bernoulli draw).  The greatest threshold that
keeps the source's words within its target is read from three nested histograms
of 1,024 bins; what is left is drawn again among the rows that fit into it.  Hashes
depend on the row alone: reruns agree.

Defined results
    null or wordless text: size 0, takes 0 words; null source: a source of its
    own, ordered last; null ``doc_id`` and equal rows: each row is mixed by itself (equal rows
    draw alike); an empty table gives no row; a source without words has target 0.
    Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.llm.common import bounded, hinted, materialise

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in order, repeating; share of all words; most times a source may be used.
WEIGHTS, SHARE, CAP = (5, 2, 1), 1.5, 2.0
#: Relative error of a source's expected words at which Newton steps end.
TOLERANCE, MAX_STEPS = 1e-9, 60
BIN_BITS, LEVELS = 10, 3
#: Draws per source: the first, then among the rows that still fit into what is left.
TURNS = 4


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """(source, source_size) -> also target: weighted shares, cut at ``cap`` times the
    size, the excess shared anew by weight among the others.

    The fixed point is ``min(cap * size, c * weight)``: in the order of
    cap * size / weight, c is what is left over the weight that is left at the
    first source that stays below it.  The windows run over one row per source.
    """
    ranked = sizes.withColumn("_rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    most = F.col("source_size") * F.lit(float(cap))
    ordered = Window.orderBy("_ratio", "_rank")
    full = ranked.withColumn("_w", w).withColumn("_most", most).withColumn("_ratio", F.col("_most") / F.col("_w")) \
        .withColumn("_total", F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))) \
        .withColumn("_used", F.sum("_most").over(ordered) - F.col("_most")) \
        .withColumn("_left", F.sum("_w").over(Window.partitionBy()) - F.sum("_w").over(ordered) + F.col("_w")) \
        .withColumn("_c", (F.col("_total") - F.col("_used")) / F.col("_left"))
    c = F.min(F.when(F.col("_ratio") >= F.col("_c"), F.struct("_ratio", "_rank", "_c"))).over(Window.partitionBy())
    level = F.coalesce(c["_c"], F.lit(float("inf")))
    return full.select("source", "source_size", F.least("_most", level * F.col("_w")).alias("target"))


def _same(a: str, b: str) -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def balance(histogram: DataFrame, targets: DataFrame, cap: float = CAP) -> DataFrame:
    """Newton's method on the dual: (source, lambda), with null where the rate is constant:
    0 without a target, ``cap`` where the target is the most there is.

    ``histogram``: source, size, n with sizes above 0; ``targets``: source, source_size, target.
    """
    lowest = histogram.groupBy(F.col("source").alias("_s")).agg(F.min("size").alias("_min"))
    t = targets.join(lowest, _same("source", "_s"), "left").drop("_s")
    free = (F.col("target") > 0) & (F.col("target") < F.col("source_size") * (cap * (1 - 1e-12)))
    state = t.select(
        "source", "target", free.alias("free"), F.lit(0.0).alias("lam"),
        F.least(F.lit(0.0), F.log(F.col("target") / F.col("source_size")) / F.col("_min")).alias("low"),
        (F.log(F.lit(float(cap))) / F.col("_min")).alias("high"), F.lit(False).alias("done"))
    state = materialise(state, "balance")
    for _ in range(MAX_STEPS):
        if state.where("free and not done").isEmpty():
            break
        now = state.where("free and not done").select(F.col("source").alias("_s"), "lam", F.col("target").alias("_t"))
        raw = F.exp(F.col("lam") * F.col("size"))
        step = histogram.join(hinted(now, state), _same("source", "_s")).groupBy("_s").agg(
            F.sum(F.col("n") * F.col("size") * F.least(F.lit(float(cap)), raw)).alias("_f"),
            F.sum(F.when(raw < cap, F.col("n") * F.col("size") * F.col("size") * raw).otherwise(0.0)).alias("_d"))
        j = state.join(step, _same("source", "_s"), "left")
        gap = F.col("_f") - F.col("target")
        low = F.when(gap < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("lam")).otherwise(F.col("high"))
        newton = F.col("lam") - F.try_divide(gap, F.col("_d"))
        inside = newton.isNotNull() & (newton > low) & (newton < high)
        nxt = F.when(inside, newton).otherwise((low + high) / 2)
        moved = F.col("_f").isNotNull()
        done = F.abs(gap) <= F.col("target") * TOLERANCE
        state = materialise(j.select(
            "source", "target", "free", F.when(moved & ~done, nxt).otherwise(F.col("lam")).alias("lam"),
            F.when(moved, low).otherwise(F.col("low")).alias("low"),
            F.when(moved, high).otherwise(F.col("high")).alias("high"),
            (F.col("done") | F.coalesce(done, F.lit(False))).alias("done")), "balance")
    return state.select("source", F.when(F.col("free"), F.col("lam")).alias("lam"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Per row: doc_id, raw (MD5 of the text), source, size, source_size, target, rate, copies, taken."""
    text = F.coalesce("text", F.lit(""))
    hashed = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text)
    rows = materialise(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("raw"), "source", F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        (F.shiftrightunsigned(hashed, 11) / F.lit(float(1 << 53))).alias("u")), "mix-rows")
    histogram = materialise(rows.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = materialise(source_targets(sizes, weights, share, cap), "mix-targets")
    lam = balance(histogram, targets, cap).withColumnRenamed("source", "_s")
    sources = bounded(targets.join(lam, _same("source", "_s")).drop("_s").withColumnRenamed("source", "_s"), "mix-sources")

    constant = F.when(F.col("target") > 0, F.lit(float(cap))).otherwise(F.lit(0.0))
    rate = F.least(F.lit(float(cap)), F.coalesce(F.exp(F.col("lam") * F.col("size")), constant))
    rated = rows.join(sources, _same("source", "_s")).drop("_s").withColumn("rate", rate) \
        .withColumn("whole", F.floor("rate").cast("long")).withColumn("part", F.col("rate") - F.col("whole"))
    span = 1 << (BIN_BITS * LEVELS)
    rated = rated.withColumn("z", F.when((F.col("part") > 0) & (F.col("size") > 0), F.least(
        F.lit(span - 1), F.floor((F.col("u") - F.col("part") + 1) / 2 * span).cast("long"))))
    rated = materialise(rated.select(
        "doc_id", "raw", "source", "size", "source_size", "target", "rate", F.col("whole").alias("copies"), "z"), "mix-rates")
    for turn in range(TURNS):
        left = rated.groupBy(F.col("source").alias("_s")).agg(
            (F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("_need"))
        # after the first turn just rows that fit into what is left
        fits = (F.col("size") <= F.col("_need")) if turn else F.lit(True)
        drawn = materialise(rated.where("z is not null").join(bounded(left, "mix-left"), _same("source", "_s")).where(fits)
                            .select("_s", "_need", "size", "z"), "mix-draw")
        if drawn.isEmpty():
            break
        joined = rated.join(hinted(_thresholds(drawn)), _same("source", "_s"), "left")
        more = F.coalesce((F.col("z") < F.col("_cut")) & ((F.col("size") <= F.col("_need")) if turn else F.lit(True)), F.lit(False))
        rated = materialise(joined.select(
            "doc_id", "raw", "source", "size", "source_size", "target", "rate", (F.col("copies") + more.cast("long")).alias("copies"),
            F.when(~more, F.col("z")).alias("z")), "mix-rates")
    rated = _one_more(rated)
    return rated.select("doc_id", "raw", "source", "size", "source_size", "target", "rate", "copies",
                        (F.col("copies") * F.col("size")).alias("taken"))


def _one_more(rated: DataFrame) -> DataFrame:
    """The smallest row that is left goes beyond a source's target if that ends nearer to it."""
    left = rated.groupBy(F.col("source").alias("_s")).agg(
        (F.first("target") - F.sum(F.col("copies") * F.col("size"))).alias("_need"),
        F.min(F.when(F.col("z").isNotNull(), F.struct("size", "z"))).alias("_least"))
    left = bounded(left.where("_least is not null"), "mix-least")
    same = F.struct("size", "z") == F.col("_least")
    alike = rated.where("z is not null").join(left, _same("source", "_s")).where(same).groupBy("_s").agg(
        F.first("_least").alias("_least"), F.first("_need").alias("_need"), F.sum("size").alias("_words"))
    nearer = bounded(alike.where(F.col("_words") < 2 * F.col("_need")).select("_s", "_least"), "mix-more")
    joined = rated.join(nearer, _same("source", "_s"), "left")
    return joined.withColumn("copies", F.col("copies") + F.coalesce(same, F.lit(False)).cast("long"))


def _thresholds(drawn: DataFrame) -> DataFrame:
    """(_s, _need, _cut): per source the z below which its rows hold at most ``_need`` words.

    Level by level the bin in which the running sum of words crosses what is
    needed is split further; each task holds the bins of some sources.
    """
    found = materialise(drawn.groupBy("_s").agg(F.first("_need").alias("_need")).select(
        "_s", "_need", F.col("_need").alias("_rest"), F.lit(0).cast("long").alias("_cut"), F.lit(False).alias("_done")), "mix-cuts")
    for level in range(LEVELS):
        width = BIN_BITS * (LEVELS - 1 - level)
        upper = F.shiftright("z", width + BIN_BITS) == F.shiftright("_cut", width + BIN_BITS)
        open_ = found.where("not _done").select(F.col("_s").alias("_t"), "_rest", "_cut")
        bins = drawn.join(hinted(open_, found), _same("_s", "_t")).where(upper).groupBy("_t", F.shiftright("z", width).alias("_bin")).agg(
            F.sum("size").alias("_words"), F.first("_rest").alias("_rest"))
        running = bins.withColumn("_up", F.sum("_words").over(Window.partitionBy("_t").orderBy("_bin")))
        # the first bin whose end lies beyond what is needed; without one all bins are taken
        pick = running.groupBy("_t").agg(
            F.min(F.when(F.col("_up") > F.col("_rest"), F.struct(F.col("_bin"), (F.col("_up") - F.col("_words")).alias("_past")))).alias("_hit"),
            F.max("_bin").alias("_last"))
        j = found.join(pick, _same("_s", "_t"), "left")
        hit = F.col("_hit").isNotNull()
        cut = F.when(hit, F.shiftleft(F.col("_hit._bin"), width)).when(F.col("_last").isNotNull(), F.shiftleft(F.col("_last") + 1, width))
        found = materialise(j.select("_s", "_need", F.when(hit, F.col("_rest") - F.col("_hit._past")).otherwise(F.col("_rest")).alias("_rest"),
                                     F.coalesce(cut, "_cut").alias("_cut"), (F.col("_done") | ~hit).alias("_done")), "mix-cuts")
    return found.select("_s", "_need", "_cut")  # of written rows


def op4_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")
