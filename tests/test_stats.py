import math

import numpy as np
from pyspark.sql import functions as F

from kestrel.operators import stats
from kestrel.operators.impute import impute_group_mean


def rows_with_missing():
    nan = float("nan")
    return [(1, [1.0, nan, 2.0], True), (2, [3.0, 4.0, None], False), (3, [nan, 6.0, 1.0], True),
            (4, [5.0, 8.0, 7.0], False), (5, [2.0, nan, nan], True)]


def test_na_stats_nan_and_null(spark):
    data = rows_with_missing()
    df = spark.createDataFrame(data, "id int, scores array<double>, matched boolean")
    got = {r.slot: r for r in stats.na_stats(df, n_slots=3).collect()}
    for slot in range(3):
        vals = [r[1][slot] for r in data if r[1][slot] is not None and not math.isnan(r[1][slot])]
        g = got[slot]
        assert g.n == len(vals) and g.missing == 5 - len(vals)
        assert abs(g.mean - np.mean(vals)) < 1e-12 and abs(g.stdev - np.std(vals)) < 1e-12
        assert g.max == max(vals) and g.min == min(vals)
    merged = {r.slot: r for r in stats.merge_partials(
        stats.na_partials(df, F.col("id") % 2, n_slots=3)).collect()}
    for slot in range(3):
        assert merged[slot].n == got[slot].n and merged[slot].missing == got[slot].missing
        assert abs(merged[slot].stdev - got[slot].stdev) < 1e-12
    contrast = {r.slot: r for r in stats.class_contrast(df, n_slots=3).collect()}
    m = [np.mean([r[1][0] for r in data if r[2] and not math.isnan(r[1][0])]),
         np.mean([r[1][0] for r in data if not r[2] and not math.isnan(r[1][0])])]
    assert abs(contrast[0].mean_diff - (m[0] - m[1])) < 1e-12 and contrast[0].missing == 1


def test_word_count_jvm_tokens(spark):
    lines = spark.createDataFrame([("a b  a",), ("b  ",), ("   ",)], "line string")
    got = {r.word: r["count"] for r in stats.word_count(lines).collect()}
    assert got == {"a": 2, "b": 2, "": 1}


def test_impute_group_mean_with_all_missing_group(spark):
    df = spark.createDataFrame([(1, 0.0, 10.0), (2, 0.0, None), (3, 1.0, None), (4, 2.0, 30.0)],
                               "id int, cls double, price double")
    got = {r.id: r.price for r in impute_group_mean(df, "price", ["cls"]).collect()}
    assert got == {1: 10.0, 2: 10.0, 3: 20.0, 4: 30.0}   # class 1 has no value: overall mean
