import random
from collections import Counter
from math import log

import pandas as pd
import pytest

from kestrel.llm import decontam
from kestrel.llm.decontam import Part, contaminated, op3_block_max_wand, split_item
from kestrel.llm.words import words_of

DOCS = "doc_id long, text string, item_id string, score int"
ITEMS = "item_id long, text string, doc_id string, part int"


def bm25(items):
    """Per item: term -> share of the item's own BM25 score."""
    words = [words_of(t or "") for _, t in items]
    words = [w for w in words]
    some = [w for w in words if w]
    n, mean = len(some), sum(map(len, some)) / len(some)
    df = Counter(t for w in some for t in set(w))
    out = []
    for w in words:
        raw = {t: log(1 + (n - df[t] + .5) / (df[t] + .5)) * c * 2.2 / (c + 1.2 * (.25 + .75 * len(w) / mean)) for t, c in Counter(w).items()}
        out.append({t: v / sum(raw.values()) for t, v in raw.items()})
    return out


def brute(docs, items, threshold=0.6):
    weights, found = bm25(items), {}
    stride = max(len(words_of(t or "")) for _, t in items)
    for doc_id, text in docs:
        words = words_of(text or "")
        for k in range(max(1, -(-len(words) // stride))):
            window = words[k * stride:(k + 2) * stride]
            for (item_id, item), w in zip(items, weights):
                score = sum(v for t, v in w.items() if t in set(window))
                if w and score >= threshold - 1e-9:
                    shares = []
                    for side in split_item(item):
                        n = min(3, len(side))
                        grams = {tuple(side[i:i + n]) for i in range(len(side) - n + 1)} if side else set()
                        held = {tuple(window[i:i + n]) for i in range(len(window) - n + 1)}
                        shares.append(len(grams & held) / len(grams) if grams else 1.0)
                    if min(shares) >= 0.7:
                        key = (doc_id, item_id)
                        found[key] = max(found.get(key, (0,)), (score, *shares))
    return found


def case(seed=1):
    rng = random.Random(seed)
    vocab = [f"v{i}" for i in range(120)]
    prose = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, f"{prose(rng.randrange(6, 20))}? {prose(rng.randrange(1, 6))}.") for i in range(40)]
    items += [(40, items[0][1]), (41, None), (42, ""), (43, "lone"), (None, "Question: x y z Answer: q r s")]
    docs = []
    for i in range(120):
        text = prose(rng.randrange(0, 90))
        if i % 3 == 0:
            words = rng.choice(items[:40])[1].split()
            if i % 2:
                words[rng.randrange(len(words))] = "other"
            text += " " + " ".join(words).upper() + " " + prose(rng.randrange(0, 50))
        docs.append((i, text))
    return docs + [(None, "see question: x y z answer: q r s"), (500, None), (501, ""), (7, docs[0][1])], items


def test_search_equals_scoring_all_items():
    rng = random.Random(2)
    items = [(i, " ".join(rng.choice("abcdefghijklmnop") * rng.randrange(1, 3) for _ in range(8))) for i in range(90)]
    weights = bm25(items)
    rows = pd.DataFrame([(i, t, v) for i, w in enumerate(weights) for t, v in w.items()], columns=["item", "term", "impact"])
    names = pd.DataFrame([(i, i, t, 8) for i, t in items], columns=["item", "item_id", "text", "length"])
    part = Part(rows, names)
    for threshold in (0.2, 0.45, 0.6, 0.9):
        for _ in range(40):
            query = rng.sample(list(part.vocab), 12)
            got = dict(part.search([part.vocab[t] for t in query], threshold))
            want = {i: s for i, w in enumerate(weights) if (s := sum(w.get(t, 0) for t in query)) >= threshold - 1e-9}
            assert got.keys() == want.keys() and all(got[i] == pytest.approx(want[i]) for i in got)


@pytest.mark.parametrize("postings", [10**6])
def test_hits_equal_brute_force(spark, postings):
    docs, items = case()
    d = spark.createDataFrame([(*x, "c", 1) for x in docs], DOCS)
    i = spark.createDataFrame([(*x, "c", 1) for x in items], ITEMS)
    got = {(r.doc_id, r.item_id): (r.score, r.question_share, r.answer_share) for r in contaminated(d, i, part_postings=postings).collect()}
    want = brute(docs, items)
    assert got.keys() == want.keys() and len(got) > 20
    assert all(got[k] == pytest.approx(want[k]) for k in got)


def test_whole_items_are_found_with_many_parts(spark):
    docs, items = case(3)
    d = spark.createDataFrame([(*x, "c", 1) for x in docs], DOCS)
    i = spark.createDataFrame([(*x, "c", 1) for x in items], ITEMS)
    got = {(r.doc_id, r.item_id) for r in contaminated(d, i, part_postings=150).collect()}
    plain = [(item_id, b" ".join(words_of(t))) for item_id, t in items if t]
    for doc_id, text in docs:
        held = b" " + b" ".join(words_of(text or "")) + b" "
        for item_id, t in plain:
            if b" " + t + b" " in held:
                assert (doc_id, item_id) in got


def test_empty_tables(spark):
    docs, items = case()
    d, i = spark.createDataFrame([], DOCS), spark.createDataFrame([], ITEMS)
    assert contaminated(d, spark.createDataFrame([(*x, "c", 1) for x in items], ITEMS)).count() == 0
    assert contaminated(spark.createDataFrame([(*x, "c", 1) for x in docs], DOCS), i).count() == 0
    assert split_item("") == ([], []) and decontam.NGRAM == 3


def test_query_on_whole_documents(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r.doc_id, r.item_id) for r in op3_block_max_wand(spark, sf).collect()}
    assert got == set(brute(docs, items))
