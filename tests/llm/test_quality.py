import random
import re
from collections import Counter

import numpy as np
import pytest

from kestrel.llm.quality import DIM, VECTOR, chi2_cdf, chi2_quantile, estimates, judge, op7_robust_outliers

SCHEMA = "doc_id long, lang string, source string, text string, kept int, grp string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    times, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if times[w] > 1:
            covered.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered))


def failed(c):
    return c[0] < 20 or 100 * c[4] > 30 * c[0]


def prose(rng, n):
    return " ".join(rng.choice(["the", "quick", "brown", "foxes", "jumped", "over", "lazy", "dogs.", "And", "then,", "rested"])
                    + rng.choice(["", "", "s", "ly"]) for _ in range(n))


def test_counts_of_hard_texts(spark):
    rng = random.Random(1)
    texts = [None, "", " \n ", "a b\x1cc d\xa0e\x85f", "x\n\nx\nx \n\n", "é# ñ%$ <|>&*", "a b c d e f g h " * 2, "a b c d e f g h i",
             "w " * 30_000, prose(rng, 500) + "\n" + prose(rng, 5), "one two three four five six seven eight nine\n" * 3]
    df = spark.createDataFrame([(i, "en", None, t, 1, "g") for i, t in enumerate(texts)], SCHEMA)
    for r in judge(df).collect():
        c = counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == c
        assert r.base_failed == failed(c) and not (r.base_failed and r.kept)


def test_outliers_go_and_clean_documents_stay(spark):
    rng = random.Random(2)
    rows = [(i, "en", f"s{i % 2}", prose(rng, rng.randrange(30, 900)), 1, "g") for i in range(600)]
    junk = [(10_000 + i, "en", f"s{i % 2}", " ".join(rng.choice(["#$%", "<|>", "&&**", "A1"]) + str(rng.random()) for _ in range(80)), 1, "g")
            for i in range(150)]
    few = [(20_000, "xx", None, prose(rng, 40), 1, "g"), (None, None, None, prose(rng, 40), 1, "g")]
    got = judge(spark.createDataFrame(rows + junk + few + few, SCHEMA), min_group=100).collect()
    assert len(got) == 754
    assert all(r.kept == (r.doc_id is None or not 10_000 <= r.doc_id < 20_000) for r in got)


def test_empty_table(spark):
    assert judge(spark.createDataFrame([], SCHEMA)).count() == 0


def test_estimate_equals_concentration_in_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(0.5, 0.3, (400, DIM)) @ np.triu(np.ones((DIM, DIM)))
    x[:60] += 6
    names = list(VECTOR)
    df = spark.createDataFrame([("g", *map(float, r)) for r in x], "grp string, " + ", ".join(f"{n} double" for n in names))
    fit = estimates(df).first()
    floor = np.diag(np.square(list(VECTOR.values())))
    scale = 0.75 / chi2_cdf(chi2_quantile(0.75, DIM), DIM + 2)
    med = np.median(x, 0)
    mean, inv = med, np.diag(1 / ((1.4826 * np.median(abs(x - med), 0)) ** 2 + np.diag(floor)))
    for _ in range(30):
        d = np.einsum("ij,jk,ik->i", x - mean, inv, x - mean)
        near = x[np.argsort(d)[:300]]
        mean, inv = near.mean(0), np.linalg.inv(scale * np.cov(near.T, bias=True) + floor)
    core = chi2_quantile(0.975, DIM)
    near = x[np.einsum("ij,jk,ik->i", x - mean, inv, x - mean) <= core]
    assert np.allclose(near.mean(0), fit.center, atol=0.1)
    cov = 0.975 / chi2_cdf(core, DIM + 2) * np.cov(near.T, bias=True) + floor
    assert np.allclose(np.linalg.inv(np.array(fit.inverse).reshape(DIM, DIM)), cov, rtol=0.2, atol=0.05)


def test_chi_square():
    assert chi2_quantile(0.95, 1) == pytest.approx(3.841, abs=1e-3) and chi2_quantile(0.975, 6) == pytest.approx(14.449, abs=1e-3)


def test_query_on_whole_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    rows = op7_robust_outliers(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        c = counts(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == c and r.base_failed == failed(c)
