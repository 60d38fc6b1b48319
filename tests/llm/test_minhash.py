import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.llm import minhash
from kestrel.llm.linking import link_filtered
from kestrel.llm.minhash import Sampler, Weights, frequent, near_duplicates, op10_icws_near_duplicates, vector
from kestrel.llm.words import words_of

SCHEMA = "doc_id long, text string, class_id string, keep int, raw string"


def grams(text):
    w = words_of(text or "")
    n = min(5, len(w))
    return Counter(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else Counter()


def classes(docs, threshold=0.8):
    """Connected groups of all pairs of texts by exact weighted Jaccard similarity."""
    n = len(docs)
    sets = [grams(t) for _, t in docs]
    df = Counter(g for s in sets for g in s)
    idf = lambda g: 1 + math.log(n / df[g])
    weigh = [{g: (1 + math.log(c)) * idf(g) for g, c in s.items()} for s in sets]
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(n):
        for j in range(i):
            keys = weigh[i].keys() & weigh[j].keys()
            if keys:
                shared = sum(min(weigh[i][g], weigh[j][g]) for g in keys)
                if shared / (sum(weigh[i].values()) + sum(weigh[j].values()) - shared) >= threshold:
                    parent[root(i)] = root(j)
    out = {}
    for i in range(n):
        out.setdefault(root(i), set()).add(i)
    return [c for c in out.values()]


def corpus(seed=1):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    docs = []
    for i in range(25):
        words = [rng.choice(vocab) for _ in range(rng.randrange(40, 160))]
        docs.append(" ".join(words))
        for _ in range(rng.randrange(0, 6)):
            copy = list(words)
            for _ in range(rng.randrange(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocab)
            docs.append(" ".join(copy))
    rng.shuffle(docs)
    return list(enumerate(docs))


def test_classes_equal_all_pairs(spark):
    docs = corpus() + [(500, "short one"), (501, "Short  ONE!"), (502, "a"), (503, "repeat me " * 3000), (504, "repeat me " * 3000)]
    df = spark.createDataFrame([(*d, "x", 1, "y") for d in docs], SCHEMA)
    rows = near_duplicates(df).collect()
    got = {}
    for r in rows:
        got.setdefault(r.class_id, set()).add(r.doc_id)
    want = {min(docs[i][0] for i in c): {docs[i][0] for i in c} for c in classes(docs)}
    assert got == want
    kept = [r.doc_id for r in rows if r.keep]
    assert sorted(kept) == sorted(want) and all(r.class_size == len(want[r.class_id]) for r in rows)


def test_nulls_empties_and_repeated_rows(spark):
    rows = [(None, "one two three four five six", "x", 1, "y"), (7, "one two three four five six", "x", 1, "y"),
            (7, "one two three four five six", "x", 1, "y"), (3, None, "x", 1, "y"), (4, "", "x", 1, "y"), (None, "  ", "x", 1, "y"),
            (None, "lonely words", "x", 1, "y")]
    got = near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r.doc_id, r.class_id, r.class_size, r.keep) for r in got), key=str) == sorted(
        [(None, 7, 3, False), (7, 7, 3, True), (7, 7, 3, True), (3, 3, 1, True), (4, 4, 1, True), (None, None, 1, True),
         (None, None, 1, True)], key=str)
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_frequent_counts_are_exact_over_chunks(spark, monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("abcdefg") for _ in range(12)) for _ in range(300)]
    monkeypatch.setattr(minhash, "CANDIDATES", 50)
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(7)
    df_of = Counter(int(h) for t in texts for h in vector(t)[0])
    assert frequent(df, 300, 0.02) == {h: n for h, n in df_of.items() if n >= 6}


def test_agreement_estimates_weighted_jaccard():
    rng = np.random.default_rng(5)
    h = np.sort(rng.integers(0, 1 << 63, 400, dtype=np.uint64))
    w = rng.uniform(1, 4, 400)
    v = w.copy()
    v[:60] *= 2
    a, b = h[:360], h[40:]
    wa, wb = w[:360], v[40:]
    s = Sampler(3000)
    one = s.samples(np.concatenate([a, b]), np.concatenate([wa, wb]), np.array([0, 360]))
    full_a, full_b = np.append(wa, np.zeros(40)), np.append(np.zeros(40), wb)
    want = np.minimum(full_a, full_b).sum() / np.maximum(full_a, full_b).sum()
    assert (one[0] == one[1]).mean() == pytest.approx(want, abs=0.05)
    assert Weights(100, {}).rare == pytest.approx(1 + math.log(100))


def test_query_groups_all_near_copies(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {}
    for r in op10_icws_near_duplicates(spark, sf).collect():
        got.setdefault(r.class_id, set()).add(r.doc_id)
    assert got == {min(docs[i][0] for i in c): {docs[i][0] for i in c} for c in classes(docs)}


def test_word_hashes_are_those_of_single_words():
    from kestrel.llm.words import shingled, word_hashes
    texts = ["One two, TWO!", "", " ", "é über 漢字 two", "x" * (1 << 21) + " two one", "two"]
    h, n = word_hashes(texts)
    assert n.tolist() == [len(words_of(t)) for t in texts]
    flat = [w for t in texts for w in words_of(t)]
    alone = {w: int(word_hashes([w.decode()])[0][0]) for w in flat}
    assert h.tolist() == [alone[w] for w in flat] and len(set(alone.values())) == len(alone)
    one = shingled(*word_hashes(["a b c d e f"]))[0].tolist()
    two = shingled(*word_hashes(["z", "a b c d e f", "q r"]))
    assert two[1].tolist() == one and len(two[0]) == len(two[2]) == 1
    assert word_hashes([])[0].size == 0 and shingled(*word_hashes([""]))[0].size == 0


def test_texts_that_share_a_passage_and_little_else_are_not_paired(spark, monkeypatch):
    rng = random.Random(9)
    passage = [f"p{i}" for i in range(60)]
    docs = [" ".join(passage + [f"u{i}x{k}" for k in range(rng.randrange(18, 50))]) for i in range(150)]
    for i in range(0, 40, 4):  # near copies of some of them, two of each
        for _ in range(2):
            words = docs[i].split()
            words[rng.randrange(60, len(words))] = f"e{rng.random()}"
            docs.append(" ".join(words))
    docs += [" ".join(passage), " ".join(passage[:-1]), " ".join(passage + ["end"])]
    docs = list(enumerate(docs))
    pairs = []

    def counted(members, carried, may_link, verify, links):
        return link_filtered(members, carried, may_link, lambda p: (pairs.append(p.count()), verify(p))[1], links)

    monkeypatch.setattr(minhash, "link_filtered", counted)
    got = {}
    for r in near_duplicates(spark.createDataFrame([(*d, "x", 1, "y") for d in docs], SCHEMA)).collect():
        got.setdefault(r.class_id, set()).add(r.doc_id)
    assert got == {min(c): c for c in classes(docs)}
    assert sum(pairs) < 2 * len(docs)  # all pairs of the bucket: 14,878


def test_filtered_links_equal_all_pairs_and_keep_those_known(spark):
    rng = random.Random(4)
    place = {f"n{i}": rng.randrange(0, 60) for i in range(60)}
    rows = [(rng.randrange(6), n, x) for n, x in place.items() for _ in range(2)]
    members = spark.createDataFrame(sorted(set(rows)), "key long, id string, x int")
    near = F.abs(F.col("x") - F.col("pivot_x")) <= 2
    known = spark.createDataFrame([("n0", "n1")], "a string, b string")
    asked = []

    def verify(pairs):
        asked.extend(tuple(p) for p in pairs.collect())
        return pairs

    links = {tuple(r) for r in link_filtered(members, ["x"], near, verify, known).collect()}
    assert ("n0", "n1") in links and len(asked) == len(set(asked))
    keys = {}
    for k, n, _ in set(rows):
        keys.setdefault(n, set()).add(k)
    want = {("n0", "n1")} | {(a, b) for a in place for b in place if a < b and keys[a] & keys[b] and abs(place[a] - place[b]) <= 2}
    assert links <= want

    def parts(edges):
        root = {n: n for n in place}

        def top(n):
            return n if root[n] == n else top(root[n])

        for a, b in edges:
            root[top(a)] = top(b)
        return {frozenset(m for m in place if top(m) == top(n)) for n in place}

    assert parts(links) == parts(want)


def test_counts_of_every_shingle_reach_its_blocks(spark, monkeypatch):
    rng = random.Random(6)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randrange(3, 30))) for _ in range(200)] + ["", "one of its own kind here"]
    df_of = Counter(int(h) for t in texts for h in vector(t)[0])
    heavy = {h: n for h, n in df_of.items() if n >= 12}
    assert heavy and any(1 < n < 12 for n in df_of.values())
    monkeypatch.setattr(minhash, "SORTED", 100)
    rows = [(i % 7, t) for i, t in enumerate(texts)]
    shared = spark.sparkContext.broadcast(Weights(len(texts), heavy))
    got = {}
    for r in minhash.document_counts(spark.createDataFrame(rows, "block long, text string").repartition(5), shared, 3).collect():
        for h, n in zip(minhash._from_steps([r.h]).tolist(), minhash._numbers([r.df]).tolist()):
            assert (r.block, h) not in got
            got[r.block, h] = n
    assert got == {(b, int(h)): df_of[int(h)] for b, t in rows for h in vector(t)[0] if 1 < df_of[int(h)] < 12}


def test_a_passage_of_few_documents_weighs_less_than_rare_words(spark, monkeypatch):
    # the passage stands in one of 25 documents: by its document counts a pair has 0.75, without them 0.82
    monkeypatch.setattr(minhash, "BLOCK_CHARS", 2000)
    passage = " ".join(f"p{i}" for i in range(75))
    docs = [passage + f" x{k}a x{k}b x{k}c x{k}d x{k}e x{k}f x{k}g x{k}h" for k in range(8)]
    docs += [" ".join(f"o{i}w{k}" for k in range(30)) for i in range(192)]
    docs = list(enumerate(docs))
    rows = near_duplicates(spark.createDataFrame([(*d, "x", 1, "y") for d in docs], SCHEMA)).collect()
    assert {r.doc_id: r.class_id for r in rows} == {i: i for i, _ in docs}
    assert len(classes(docs)) == len(docs)


def test_near_copies_in_a_large_group_of_copies_are_one_class(spark):
    # an edited word's shingles weigh 6.9, those of 301 of 381 texts 1.2: by document counts alone a copy has 0.73 with its original
    base = [f"b{i}" for i in range(96)]
    docs = [" ".join(base)] + [" ".join(f"e{k}" if i == 4 + k % 88 else w for i, w in enumerate(base)) for k in range(300)]
    docs += [" ".join(f"o{i}w{k}" for k in range(12)) for i in range(80)]
    rows = near_duplicates(spark.createDataFrame([(i, t, "x", 1, "y") for i, t in enumerate(docs)], SCHEMA)).collect()
    assert {r.doc_id: r.class_id for r in rows} == {i: 0 if i <= 300 else i for i in range(381)}


def test_only_weights_far_over_the_middle_of_a_text_are_led():
    w = Weights(1000, {})
    df = np.array([1] + [500] * 11 + [1, 1, 1, 500, 500, 7, 40, 1])
    got = w.led(np.ones(len(df), np.int64), df, np.array([0, 12, 17, 19]))
    limit = int(1000 * math.exp(1 - minhash.LEAD * (1 + math.log(2))))
    assert limit > 1 and got.tolist() == [limit] + df[1:].tolist()
