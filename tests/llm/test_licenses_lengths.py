import random

import numpy as np
import pytest

from kestrel.llm.licenses import TEMPLATES, Templates, find_licenses
from kestrel.llm.words import shingles, words_of


def bigrams(words):
    return {tuple(words[i:i + 2]) for i in range(len(words) - 1)}


def dice(a, b):
    return 2 * len(a & b) / (len(a) + len(b))


def brute(words, templates, longest):
    """Best coefficient per template over all passages of up to so many bigrams."""
    out = {}
    for t, want in enumerate(templates):
        own = bigrams(want)
        score = max((dice(bigrams(words[i:j]), own) for i in range(len(words)) for j in range(i + 2, min(len(words), i + longest[t] + 1) + 1)),
                    default=0)
        if score >= 0.8:
            out[t] = score
    return out


def scanned(templates, words):
    h = shingles(words, 2)
    number = np.minimum(np.searchsorted(templates.bigrams, h), len(templates.bigrams) - 1)
    at = np.flatnonzero(templates.bigrams[number] == h)
    return templates.scan(h, at, number[at])


def test_runs_left_out_or_put_in_equal_brute_force_over_all_passages():
    rng = random.Random(3)
    texts = [("a", " ".join(f"a{i}" for i in range(30))), ("b", "one two three one two four five one two six seven eight"),
             ("c", "x y z x y w v u t s x y"), ("short", "all rights reserved")]
    templates = Templates(texts, every_length=True)
    split = [words_of(t) for _, t in texts]
    longest = [len(w) - 1 + int(1.5 * len(bigrams(w)) + 1e-9) - len(bigrams(w)) for w in split]
    hits = 0
    for _ in range(150):
        words = list(rng.choice(split))
        for _ in range(rng.randrange(1, 3)):
            k, run = rng.randrange(len(words) + 1), rng.randrange(1, 8)
            words[k:k + run * (rng.random() < 0.5)] = [b"q%d" % rng.randrange(9) for _ in range(run * (rng.random() < 0.5))]
        filler = lambda: [b"f%d" % rng.randrange(9) for _ in range(rng.randrange(12))]
        words = filler() + words + filler()
        want = brute(words, split, longest)
        got = [x for x in scanned(templates, words) if not x[4]]
        assert {x[3] for x in got} <= set(want) and bool(got) == bool(want)
        if want:
            hits += 1
            assert max(x[0] for x in got) == pytest.approx(max(want.values()))
    assert hits > 50


def test_cut_and_stretched_licence_inside_a_longer_document(spark):
    words = [f"w{i}" for i in range(100)]
    around = "before " * 150, "after " * 150
    cut, more = words[:40] + words[60:], words[:50] + [f"new{i}" for i in range(20)] + words[50:]
    rows = [(i, f"{around[0]} {' '.join(w)} {around[1]}") for i, w in enumerate((cut, more, words, words[:55]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (round(r.dice, 4), r.first_word, r.n_words) for r in find_licenses(df, [("L", " ".join(words))]).collect()}
    assert got == {0: (round(156 / 178, 4), 150, 80), 1: (round(196 / 218, 4), 150, 120), 2: (1.0, 150, 100)}


def test_neighbours_both_stay_and_whole_templates_are_reported_whole():
    for template in TEMPLATES:
        words = words_of(template[1])
        found = scanned(Templates([template], every_length=True), [b"qq"] + words + [b"zz"])
        assert [x[:3] for x in found] == [(1.0, 1, len(words))], template
    letters = [f"a{i}".encode() for i in range(30)]
    own = Templates([("a", " ".join(x.decode() for x in letters))], every_length=True)
    assert [(x[1], x[2]) for x in scanned(own, letters[:26] + letters)] == [(0, 26), (26, 30)]
