import random

from kestrel.llm.pii import find_pii


def test_numbers_with_blanks_after_a_learned_context_are_found(spark):
    rng = random.Random(4)
    rows = [f"filler words here. Client mobile: +49 30 {rng.randrange(10**6, 10**7)} thanks" for _ in range(12)]
    cards = ["4111 1111 1111 1111", "5500 0000 0000 0004", "4012 8888 8888 1881", "4222-2222-2222-2220", "5105 1051 0510 5100", "6011 1111 1111 1117",
             "3530 1113 3330 0000", "5555 5555 5555 4444"]
    rows += [f"filler words here. Paid by card: {c} thanks" for c in cards]
    rows += [f"order number {rng.randrange(100, 1000)} {rng.randrange(1000, 10000)} was sent" for _ in range(30)]
    plain = len(rows)
    new = [("Client mobile: 030 555 1234, please", "030 555 1234", "phone"), ("Client mobile: (415) 555 2671.", "(415) 555 2671", "phone"),
           ("é 😀 Paid by card: 4111 1111 1111 1112 again", "4111 1111 1111 1112", "card"), ("see 030 555 1234 again", "030 555 1234", "phone"),
           ("Client mobile: 030-5559876 or so", "030-5559876", "phone"), ("call 2 030-5559876 now", "030-5559876", "phone")]
    rows += [t for t, _, _ in new] + ["order number 030 555 7777 was sent", "Client mobile: 5 or 6"]
    got = {r.doc_id: [(x.s, x.e, x.kind) for x in r.added] for r in find_pii(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")).collect()}
    assert len(got) == len(rows)
    for i, (t, v, kind) in enumerate(new, plain):
        assert got[i] == [(t.index(v), t.index(v) + len(v), kind)], t
    assert not any(got[i] for i in got if not plain <= i < plain + len(new))
