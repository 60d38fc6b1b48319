import hashlib
import random
import re

from pyspark.sql import functions as F

from kestrel.llm.pii import find_pii, op2_contextual_pii

SCHEMA = "doc_id long, text string, base string, seeds int"
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def good(kind, v):
    d = re.sub("[^0-9]", "", v)
    return {"email": True, "ip": all(int(p) <= 255 for p in v.split(".")) if kind == "ip" else True,
            "card": 14 <= len(d) <= 19 and luhn(d), "phone": 10 <= len(d) <= 15}[kind]


def base(text):
    out = []
    for k, (kind, p) in enumerate(PATTERNS.items()):
        out += [(m.start(), k, m.end(), kind) for m in re.finditer(p, text or "") if good(kind, m[0])]
    return sorted(out)


def text_of(spans):
    return ",".join(f"{kind}:{s}:{e}" for s, _, e, kind in sorted(spans))


def hard_texts():
    rng = random.Random(1)
    parts = ["a@b.com", "a@b.com_x@d.org", "x@y", "@", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1", "0000255.01.1.1", "99999999999999999999.1.1.1",
             "4111 1111 1111 1111", "4111-1111-1111-1112", "378282246310005", "+1 (555) 010-2030", "+12", "+49 30 1234567 ", " ",
             "é", "😀", "word", "\n", ".", "-", "%+", "5", "12", "+", "(", "\x1c", "a.b@c-d.e-f.g.", "a@b.c@d.e", "4" * 16]
    out = ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 40))) for _ in range(400)]
    return out + [None, "", "1" * 20_000, "a" * 20_000 + "@b.c", "1.2.3.4 " * 3000, "5 " * 20_000, "+" * 5000 + "1 2" * 40]


def test_base_equals_the_plain_patterns(spark):
    texts = hard_texts()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id: sorted(tuple(x) for x in r.base) for r in find_pii(df, support=10**6).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        assert got[i] == base(t), t


def test_contexts_find_unseen_identifiers(spark):
    rng = random.Random(2)
    rows = [(i, f"filler words here. Client mobile: +49 30 {rng.randrange(10**6, 10**7)} thanks", "x", 1) for i in range(12)]
    rows += [(100, "Client mobile: 030-5551234, please", "x", 1), (101, "order number 030-7771234 was sent", "x", 1),
             (102, "see 030-5551234 again", "x", 1), (103, "Client mobile: none", "x", 1), (104, None, "x", 1), (None, "", "x", 1)]
    rows += [(200 + i, f"order number {rng.randrange(10**6, 10**7)} was sent", "x", 1) for i in range(30)]
    got = {r.doc_id: [tuple(x) for x in r.added] for r in find_pii(spark.createDataFrame(rows, SCHEMA)).collect()}
    at = rows[12][1].index("030")
    assert got[100] == [(at, 3, at + 11, "phone")]
    assert got[102] == [(4, 3, 15, "phone")]
    assert not any(v for k, v in got.items() if k not in (100, 102)) and len(got) == len(rows)


def test_repeated_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "mail a@b.com", "x", 1)] * 3, SCHEMA)
    assert find_pii(df).count() == 3
    assert find_pii(df.limit(0)).count() == 0


def test_query_on_whole_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    out = op2_contextual_pii(spark, sf)
    rows = out.collect()
    assert len(rows) == len(docs)
    more = 0
    for r in rows:
        want = base(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(text_of(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[1] == k for x in want) for k in range(4)]
        assert set(filter(None, text_of(want).split(","))) <= set(r.spans.split(","))
        more += len(list(filter(None, r.spans.split(",")))) - len(want)
    assert more <= 2  # random contexts are no evidence
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and F is not None
