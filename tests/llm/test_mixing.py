import math
import re
from collections import defaultdict

import pytest

from kestrel.llm.mixing import mix, op4_entropy_mix

SCHEMA = "doc_id long, text string, source string, size int, target string, rate double"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def targets(size):
    """Shares by weight with the excess over twice the size shared again, round by round."""
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(size.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 2 * size[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        out |= {s: 2.0 * size[s] for s in over}
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def multiplier(sizes, target):
    low, high = -50.0, 50.0
    for _ in range(300):
        mid = (low + high) / 2
        got = sum(s * min(2.0, math.exp(min(700.0, mid * s))) for s in sizes)
        low, high = (mid, high) if got < target else (low, mid)
    return low


def check(rows, docs, tolerance):
    sizes = defaultdict(list)
    for _, text, source in docs:
        sizes[source].append(len(WORD.findall(text or "")))
    want = targets({s: sum(v) for s, v in sizes.items()})
    taken, most = defaultdict(int), {}
    assert len(rows) == len(docs)
    for r in rows:
        assert r.source_size == sum(sizes[r.source]) and r.target == pytest.approx(want[r.source], rel=1e-9)
        assert r.taken <= 2 * r.size and r.taken == r.copies * r.size
        assert math.floor(r.rate) <= r.copies <= math.ceil(r.rate) or r.size == 0
        taken[r.source] += r.taken
        most[r.source] = max(most.get(r.source, 0), r.size)
    for s in taken:
        assert abs(taken[s] - want[s]) <= tolerance(most[s])
    return sizes, want


def test_rates_solve_the_dual_and_copies_meet_targets(spark):
    docs = [(i, "w " * (1 + i * 7919 % 97), "abcde"[i % 5] if i % 3 else "a") for i in range(900)]
    df = spark.createDataFrame([(*d, 1, "x", 0.5) for d in docs], SCHEMA)
    rows = mix(df).collect()
    sizes, want = check(rows, docs, lambda most: 10)
    for r in rows:
        if want[r.source] < 2 * sum(sizes[r.source]) * (1 - 1e-9):
            lam = multiplier(sizes[r.source], want[r.source])
            assert r.rate == pytest.approx(min(2.0, math.exp(lam * r.size)), rel=1e-6)


def test_nulls_ties_and_long_texts(spark):
    docs = [(1, None, "s"), (2, "", None), (None, "a b c", None), (3, "a b", "s"), (3, "a b", "s"),
            (4, "x " * 50_000, "t"), (5, "é b\x1cc \x0b d", "t")]
    rows = mix(spark.createDataFrame([(*d, 1, "x", 0.5) for d in docs], SCHEMA)).collect()
    check(rows, docs, lambda most: 2 * most)
    again = {(r.doc_id, r.size): r.copies for r in mix(spark.createDataFrame([(*d, 1, "x", 0.5) for d in docs], SCHEMA)).collect()}
    assert again == {(r.doc_id, r.size): r.copies for r in rows}
    assert [r.size for r in rows if r.doc_id == 5] == [2]


def test_empty_table_and_no_words(spark):
    assert mix(spark.createDataFrame([], SCHEMA)).count() == 0
    only = [(1, "", "s", 1, "x", 0.5), (2, None, "t", 1, "x", 0.5)]
    assert [(r.size, r.target, r.taken) for r in mix(spark.createDataFrame(only, SCHEMA)).collect()] == [(0, 0.0, 0)] * 2


def test_query_on_whole_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "source").collect()]
    source = {d: s for d, _, s in docs}
    sizes = defaultdict(int)
    for _, text, s in docs:
        sizes[s] += len(WORD.findall(text))
    want, taken, free = targets(sizes), defaultdict(int), {}
    for r in op4_entropy_mix(spark, sf).collect():
        s = source[r.doc_id]
        assert r.target == pytest.approx(want[s], rel=1e-9)
        taken[s] += r.taken
        if r.copies < math.ceil(r.rate):
            free[s] = min(r.size, free.get(s, r.size))
    # ten documents a source: no document that is left would end nearer
    assert all(abs(want[s] - taken[s]) <= max(0.02 * want[s], free.get(s, 0) / 2) for s in want)
