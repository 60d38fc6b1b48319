import random
import re

import numpy as np
import pytest

import pyarrow as pa

from kestrel.llm import ngram_join
from kestrel.llm.ngram_join import _sharing, common, jaccard_components, key_ranges, linked, most_shared, part_keys, size_edges
from test_linking import components

SCHEMA = "doc_id long, text string"


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < 3:
        return {tuple(words)} if words else set()
    return {tuple(words[i:i + 3]) for i in range(len(words) - 2)}


def brute(docs):
    sets = [shingle_set(t) for _, t in docs]
    pairs = [(i, j) for j in range(len(docs)) for i in range(j) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j])]
    root = components(pairs)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            r = root.get(i, i)
            least[r] = min(d, least.get(r, d))
    return sorted([(d, len(sets[i]), least.get(root.get(i, i))) for i, (d, _) in enumerate(docs)], key=repr), pairs


def check(spark, docs, schema=SCHEMA, rows=None):
    got = sorted([tuple(r) for r in jaccard_components(spark.createDataFrame(rows or docs, schema)).collect()], key=repr)
    want, pairs = brute(docs)
    assert got == want
    return pairs


def edited(rng, words, k, vocabulary):
    out = list(words)
    for _ in range(k):
        i = rng.randrange(len(out))
        match rng.randrange(3):
            case 0:
                out[i] = rng.choice(vocabulary)
            case 1:
                del out[i]
            case _:
                out.insert(i, rng.choice(vocabulary))
    return out


@pytest.mark.parametrize("seed,words,passage", [(1, 40, 0), (2, 200, 0), (3, 12, 0), (4, 60, 54)])
def test_all_links_are_found(spark, seed, words, passage):
    """Chains of near copies, and unrelated texts that are mostly one shared passage."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    shared = [rng.choice(vocabulary) for _ in range(passage)]
    texts = []
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(words - passage)] + shared
        for _ in range(rng.randrange(1, 9)):
            texts.append(" ".join(base))
            base = edited(rng, base, rng.randrange(0, 3), vocabulary)
    docs = [(i, t) for i, t in enumerate(texts)]
    rng.shuffle(docs)
    pairs = check(spark, docs)
    assert len(pairs) > 10


def test_large_group_at_the_threshold(spark):
    """Copies with one or two own edits each: some are linked, some are not, all share nearly everything."""
    rng = random.Random(9)
    vocabulary = [f"w{i}" for i in range(5000)]
    base = [rng.choice(vocabulary) for _ in range(90)]
    docs = [(i, " ".join(edited(rng, base, rng.randrange(1, 4), vocabulary))) for i in range(90)]
    pairs = check(spark, docs)
    assert 0 < len(pairs) < 90 * 89 // 2


def test_edge_cases(spark):
    long_text = " ".join(f"x{i % 9000}" for i in range(30000))
    docs = [(1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "One"), (6, "one two"), (7, "ONE  two"), (8, "one two three"),
            (None, "one two three"), (None, "null doc only here"), (None, "null doc only here"), (9, "é É ß four"), (10, "É é ß four"),
            (11, long_text), (12, long_text + " tail"), (13, "a b c a b c a b c"), (13, "a b c a b c a b c"), (14, " one"), (15, "one")]
    check(spark, docs)


def test_extra_columns_and_empty_table(spark):
    rows = [(3, "a b c d", "x", 1, "y"), (2, "a b c d", "z", 2, "y")]
    check(spark, [r[:2] for r in rows], SCHEMA + ", id string, n int, key string", rows)
    assert jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0
    assert check(spark, [(1, None), (2, "")]) == []


def test_linked_sets_agree_in_a_part():
    """Signatures: pairs at the very edge of the threshold share a key, whatever their sizes."""
    rng = np.random.default_rng(3)
    for n in [*range(1, 60), 99, 100, 101, 333, 1000, 5000]:
        a = np.unique(rng.integers(1, 1 << 63, n, dtype=np.uint64))
        for m in {n, (9 * n + 9) // 10}:
            need = -(-(n + m) * 9 // 19)
            if need > m:
                continue
            b = np.unique(np.concatenate([a[:need], rng.integers(1, 1 << 63, m - need, dtype=np.uint64)]))
            keys, counts = part_keys(np.concatenate([a, b]), np.array([len(a), len(b)]))
            assert set(keys[:counts[0]].tolist()) & set(keys[counts[0]:].tolist()), (n, m)
    edges = size_edges(10_000)
    for m in range(1, 9000):
        assert np.searchsorted(edges, m * 10 // 9, "right") - np.searchsorted(edges, m, "right") <= 1


def test_suffix_filter_never_excludes_a_link():
    rng = np.random.default_rng(5)
    for _ in range(300):
        n = int(rng.integers(1, 120))
        a = np.unique(rng.integers(0, 300, n))
        b = np.unique(np.concatenate([rng.permutation(a)[: int(len(a) * 0.95)], rng.integers(0, 300, int(rng.integers(0, 8)))]))
        shared = len(np.intersect1d(a, b))
        assert common(a, b) == shared <= most_shared(a, b)
        assert linked(len(a), a, len(b), b) == (100 * shared >= 90 * (len(a) + len(b) - shared))


def test_ranges_of_keys_keep_every_set():
    rng = np.random.default_rng(7)
    keys = np.concatenate([rng.integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2), np.array([5, 5, 5, 9, 9, (1 << 64) - 1], np.uint64)])
    lows = np.concatenate([np.arange(500), [1000, -3, 2000, 77, 77, 8]])
    number, cut, owners = key_ranges(keys, lows)
    assert number.tolist() == sorted({int(k) >> 53 for k in keys}) and len(cut) == len(owners) == len(number)
    assert sorted(zip(cut.flatten().to_pylist(), owners.flatten().to_pylist())).count((0, 77)) == 1
    first = pa.table({"range": number[:1], "keys": cut.slice(0, 1), "lows": owners.slice(0, 1)})
    got = set(_sharing(first).column("low").to_pylist())
    assert number[0] == 0 and {1000, -3, 2000} <= got  # each set of a key, not only two of them
    other = pa.table({"range": [3, 3], "keys": pa.array([[1, 4], [4, 4, 6]], pa.list_(pa.int32())), "lows": pa.array([[10, 11], [11, 12, 13]], pa.list_(pa.int64()))})
    assert _sharing(other).column("low").to_pylist() == [11, 12]


def test_only_sets_of_pairs_are_shuffled(spark, monkeypatch):
    """Each round sends the sets of its pairs to them, no others, and a round without pairs none."""
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefghijklmnop") + str(rng.randrange(90)) for _ in range(80)) for _ in range(30)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(100 + i, t + f" x{i}") for i, t in enumerate(texts[:5])]
    seen, verified = [], ngram_join._verified

    def recorded(pairs, sets):
        found = verified(pairs, sets)
        seen.append((pairs.count(), found._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi")))
        return found

    monkeypatch.setattr(ngram_join, "_verified", recorded)
    check(spark, docs)
    assert seen and all(n > 0 and semi == 2 for n, semi in seen), seen
