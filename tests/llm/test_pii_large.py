import random

from kestrel.llm.pii import find_pii

SCHEMA = "doc_id long, text string"


def test_one_text_with_very_many_spans_and_runs(spark):
    """Work grows with spans plus runs, not with their product."""
    rng = random.Random(6)
    parts = []
    for _ in range(8000):
        parts.append(f"call +49 {rng.randrange(100, 999)} {rng.randrange(10**6, 10**7)} now")
        parts.append(f"room {rng.randrange(10**3, 10**4)} {rng.randrange(100, 999)} and {rng.randrange(10**3, 10**4)} {rng.randrange(10, 99)} too")
    text = ". ".join(parts)
    row = find_pii(spark.createDataFrame([(1, text), (2, "nothing here")], SCHEMA)).where("doc_id = 1").first()
    phones = [x for x in row.base if x.kind == "phone"]
    assert len(phones) == 8000 and all(text[x.s] == "+" for x in phones)
    spans = sorted((x.s, x.e) for x in row.added)
    assert all(b[0] >= a[0] and not (a[0] <= b[0] and b[1] <= a[1] and a != b) for a, b in zip(spans, spans[1:]))
    covered = sorted((x.s, x.e) for x in row.base)
    for s, e in spans[:200]:  # what is added lies outside the base spans
        assert not any(a < e and b > s for a, b in covered)


def test_an_identifier_inside_a_longer_one_goes(spark):
    """Both numbers of a run are found alone elsewhere after the same words; the run that holds them wins."""
    lines = [f"phone number +49 30 {i}55 1234{i} end" for i in range(10, 99)] + [f"phone number 030 {i}44 777{i} end" for i in range(10, 20)]
    docs = [(i, x) for i, x in enumerate(lines)]
    got = {r.doc_id: [(x.s, x.e) for x in r.added] for r in find_pii(spark.createDataFrame(docs, SCHEMA)).collect()}
    for i, text in docs:
        for s, e in got[i]:
            assert not any(a <= s and e <= b and b - a > e - s for a, b in got[i])
    assert sum(map(len, got.values())) >= 10
