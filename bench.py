"""Benchmark the headline queries.

Runs each query end to end (full execution through the ``noop`` sink, no
collect) on ``local[$BENCH_CPUS]`` against ``$BENCH_SF_DIR`` and prints
one JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query time is the median of ``$BENCH_RUNS`` runs (default 3); ``first``
has the first run of each, with code still cold; ``prepared`` the time that writing each
raw-text view took, before all queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "word_count",            # text scan, JVM split, explode, aggregate
    "hash_tf_tokens",        # JVM string hash over every token
    "parse_pairs",           # raw linkage lines -> typed rows
    "na_stats",              # NA-aware statistics, one pass
    "class_contrast",        # flagship: per-slot class contrast
    "linkage_thresholds",    # linkage scoring, both thresholds in one pass
    "recipe_class_gender_sibsp_parch_fare",  # imputation recipe
    "bank_under_age",        # parameterised SQL
    "top5_items_per_user",   # skew-safe top-k
    "negative_samples",      # exact hash negative sampling
    "auc_popularity",        # mean per-user AUC, popularity scorer
    "lr_class_gender_sibsp_parch_fare",  # train / validate / refit / score / write
    "als_auc",               # implicit ALS + AUC
    "score_messages",        # text model fitted on labels, applied to all documents
    "classifier_validation",  # every run with a validation split
    "grid_ranking",          # four ALS settings on the same negatives
    "cv_auc",                # ten folds, ten fits
]


RAW_VIEWS = ("plays_raw", "items_raw", "alias_raw", "pairs_raw", "bank_raw")
LONG = {"classifier_validation", "grid_ranking", "cv_auc"}  # run once


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="kestrel-bench-")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("kestrel-bench")
             .config("spark.sql.shuffle.partitions", str(max(8, cpus * 2)))
             .config("spark.sql.adaptive.enabled", "true")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
             .config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
             .config("spark.driver.memory", "16g")
             .config("spark.local.dir", scratch)
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))

    from kestrel.plans.fixtures import text_path
    from kestrel.plans.registry import all_queries

    qs = all_queries()
    names = only or HEADLINE
    # the raw-text views are inputs: written once, timed apart
    prepared = {}
    for name in RAW_VIEWS:
        t0 = time.perf_counter()
        text_path(spark, sf_dir, name)
        prepared[name] = round(time.perf_counter() - t0, 3)
    times: dict[str, float] = {}
    first: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name in names:
        samples = []
        try:
            for _ in range(1 if name in LONG else runs):
                t0 = time.perf_counter()
                qs[name].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
                samples.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(samples), 3)
            first[name] = round(samples[0], 3)
        except Exception as e:  # noqa: BLE001
            errors[name] = str(e)[:300]
        print(f"# {name}: {times.get(name)} {samples}", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "first": first, "first_total_sec": round(sum(first.values()), 3), "sf": sf, "cpus": cpus,
           "runs": runs, "prepared": prepared}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
