import hashlib
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kestrel.llm.secrets import CLASSES, WIDTH, find_secrets, op6_window_entropy, window_entropy

SCHEMA = "doc_id long, text string, base string, candidate int"
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    text = text or ""
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def excess(s):
    best = -math.inf
    for i in range(len(s) - WIDTH + 1):
        w = s[i:i + WIDTH]
        bits = next(b for p, b in CLASSES if re.search(p, w))
        h = -sum(c / WIDTH * math.log2(c / WIDTH) for c in Counter(w).values())
        best = max(best, h - bits)
    return best


def test_windows_equal_direct_entropy(spark):
    rng = random.Random(3)
    sets = ["0123456789abcdef", "abcdefghijklmnopqrstuvwxyz", "ABCxyz012+/", "ab", "0123456789", "AbCdEfGhIjKlMnOpQrStUvWx"]
    words = ["".join(rng.choice(a) for _ in range(rng.randrange(20, 70))) for a in sets for _ in range(12)]
    rows = spark.createDataFrame([(w,) for w in words], "v string").select("v", window_entropy(F.col("v")).alias("x")).collect()
    assert all(r.x == pytest.approx(excess(r.v), abs=1e-9) for r in rows)
    short = spark.createDataFrame([("abc",), ("",)], "v string").select(window_entropy(F.col("v")).alias("x")).collect()
    assert [r.x for r in short] == [None, None]


def test_base_equals_the_plain_patterns(spark):
    rng = random.Random(4)
    parts = ["password", "token", "API_KEY", "apikey", "Secret", "=", ":", " ", '"', "'", "abc", "abcdefg", "AKIA", "ABCDEFGH01234567", "AKIA1",
             "0123456789abcdef", "deadbeef", "é", "😀", "\n", "x", "ſecret", "toKen", "passwd = 'a.b.c-d'"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 30))) for _ in range(400)]
    texts += [None, "", "f" * 30_000, "token=" * 3000, "AKIA" * 5000, "token=" + "Ab3" * 10_000]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: sorted(tuple(x) for x in r.base) for r in find_secrets(df).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i] == base(t), t


def test_added_spans_and_allow_list(spark):
    key = "q8Zr1LxW0vTn5KdYp3Hs7BjM"
    texts = [f"é use {key} here", "id 123e4567-e89b-12d3-a456-426614174000 ok", "see path/to/some/documentation/page/of/things ok",
             "donaudampfschifffahrtsgesellschaft", f"token={key}", "abcdefghijklmnopqrstuvwxyz0123456789", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa1B"]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, None, None, None)], SCHEMA)
    got = {r.doc_id: [tuple(x) for x in r.added] for r in find_secrets(df).collect()}
    assert got[0] == [(6, 3, 6 + len(key), "entropy")]
    assert not any(v for k, v in got.items() if k != 0)
    assert find_secrets(df.limit(0)).count() == 0


def test_query_on_whole_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    out = op6_window_entropy(spark, sf)
    rows = out.collect()
    assert len(rows) == len(docs)
    for r in rows:
        want = base(docs[r.doc_id])
        joined = ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in want)
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(x[1] == k for x in want) for k in range(3)]
        assert r.spans == joined  # these texts hold no other secrets
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
