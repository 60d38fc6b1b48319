import random

import pytest

from kestrel.llm.licenses import TEMPLATES, Templates, find_licenses, op8_dice_licenses
from kestrel.llm.words import shingles, words_of

SCHEMA = "doc_id long, text string, license string, dice int"
LINES = {"CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.", "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
         "Apache-2.0": "Licensed under the Apache License, Version 2.0.", "MIT": "Released under the MIT License.",
         "proprietary": "All rights reserved."}


def bigrams(words):
    return {tuple(words[i:i + 2]) for i in range(len(words) - 1)}


def brute(text):
    """Best coefficient per template over every passage of its length that begins in the template, and over the whole text."""
    words, out = words_of(text or ""), {}
    for t, (_, template) in enumerate(TEMPLATES):
        want = words_of(template)
        passages = [words[i:i + len(want)] for i in range(len(words) - 1) if tuple(words[i:i + 2]) in bigrams(want)] + [words]
        best = max((2 * len(bigrams(p) & bigrams(want)) / (len(bigrams(p)) + len(bigrams(want))) for p in passages if len(p) > 1), default=0)
        if best >= 0.8:
            out[t] = best
    return out


def test_coefficients_equal_brute_force():
    rng = random.Random(1)
    templates = Templates()
    for n in range(60):
        t = rng.randrange(len(TEMPLATES))
        words = TEMPLATES[t][1].split()
        for _ in range(rng.randrange(0, 1 + len(words) // 8)):
            words[rng.randrange(len(words))] = "zzz"
        filler = lambda: " ".join(rng.choice("abcdef") * 3 for _ in range(rng.randrange(0, 30)))
        text = f"{filler()} {' '.join(words)} {filler()}"
        h = shingles(words_of(text), 2)
        want = brute(text)
        import numpy as np
        number = np.minimum(np.searchsorted(templates.bigrams, h), len(templates.bigrams) - 1)
        at = np.flatnonzero(templates.bigrams[number] == h)
        got = templates.scan(h, at, number[at])
        assert bool(got) == bool(want)
        if want:
            assert max(x[0] for x in got) == pytest.approx(max(want.values()))
            assert all(want.get(x[3], 0) >= x[0] - 1e-9 for x in got)


def test_edge_cases_and_clashing_columns(spark):
    texts = [None, "", "license", "word", "All rights reserved.\n" * 2000, "x " * 40_000 + "released UNDER the mit-license!"]
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "all rights reserved", "x", 1)] * 2
    got = find_licenses(spark.createDataFrame(rows, SCHEMA)).collect()
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert set(by) == {4, 5, None} and len(by[None]) == 2 and len(by[4]) == 2000
    assert (by[5][0].license, by[5][0].first_word, by[5][0].n_words, by[5][0].dice) == ("MIT", 40_000, 5, 1.0)
    assert find_licenses(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_finds_every_licence_line(spark):
    sf = "/root/testdata/sf0.01"
    docs = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    got = {}
    for r in op8_dice_licenses(spark, sf).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    want = {}
    for d, text in docs.items():
        for name, line in LINES.items():
            if line in text:
                want.setdefault(d, set()).add(name)
    assert got == want
