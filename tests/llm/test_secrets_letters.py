import random
import string

from kestrel.llm.secrets import CLASSES, find_secrets

WORDS = ["donaudampfschifffahrtsgesellschaft", "internationalization", "counterrevolutionary", "electroencephalographically",
         "antidisestablishmentarianism", "rindfleischetikettierungsueberwachungsaufgabenuebertragungsgesetz", "bundesverfassungsgericht",
         "pneumonoultramicroscopicsilicovolcanoconiosis", "getUserAccountManagerFactory", "AbstractSingletonProxyFactoryBean",
         "setDefaultCharsetEncodingFromByteOrderMark", "quick-brown-fox-jumps-over-lazy-dog", "MAXIMUM-TRANSFER-BLOCK-SIZE-KEY",
         "12345678901234567890123456789012"]


def test_random_keys_of_letters_are_found_and_words_are_not(spark):
    rng = random.Random(8)
    sets = {"lower": string.ascii_lowercase, "upper": string.ascii_uppercase, "mixed": string.ascii_letters}
    rows = [(kind, f"use {''.join(rng.choice(letters) for _ in range(40))} here") for kind, letters in sets.items() for _ in range(100)]
    df = spark.createDataFrame([(i, text) for i, (_, text) in enumerate(rows)] + [(1000 + i, f"use {w} here") for i, w in enumerate(WORDS)],
                               "doc_id long, text string")
    got = {r.doc_id: [tuple(x) for x in r.added] for r in find_secrets(df).collect()}
    found = {kind: sum(got[i] == [(4, 3, 44, "entropy")] for i, (k, _) in enumerate(rows) if k == kind) for kind in sets}
    print(found)
    assert all(n >= 90 for n in found.values()), found
    assert not any(got[1000 + i] for i in range(len(WORDS)))


def test_only_digits_are_left_out():
    assert [p for p, bits in CLASSES if bits > 4.32] == ["^[0-9]*$"]
