import hashlib
import random
import re
import zlib

import duckdb
import pytest

from kestrel.llm.conversation_trie import OP11_SQL, conversation_trie, op11_euler_prefix_trie
from kestrel.llm.list_ranking import prefix_sums
from testdata_paths import SF_SMALL

SCHEMA = "conv_id long, turn int, role string, text string"


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = own.get(c - c % 20, [])[:h] + v[h:]
    members = {}
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members.setdefault(tuple(s[:d]), []).append(c)
    children, leaves, saved = {}, {}, {}
    for p in members:
        if p:
            children[p[:-1]] = children.get(p[:-1], 0) + 1
    for p, m in members.items():
        own_saved = (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] = leaves.get(p[:d], 0) + (p not in children)
            saved[p[:d]] = saved.get(p[:d], 0) + own_saved
    return sorted([(min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children.get(p, 0), leaves[p], saved[p],
                    hashlib.sha256(",".join(str(c) for c in sorted(m) if len(whole[c]) == len(p)).encode()).hexdigest())
                   for p, m in members.items()], key=repr)


def check(spark, rows, schema=SCHEMA, extra=None, **options):
    got = conversation_trie(spark.createDataFrame(extra or rows, schema), **options)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("seed,block", [(1, 1024), (2, 7), (3, 2)])
def test_equals_brute_force(spark, seed, block):
    """Conversations that share beginnings, and equal ones; also with tiny blocks, where the tour shrinks in many steps."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(-30, 120), 60):
        for turn in range(rng.randrange(1, 7)):
            rows.append((c, turn, rng.choice(["user", "assistant"][turn % 2:turn % 2 + 1]), rng.choice(["hi there", "yes", "no way  out", ""])))
    rng.shuffle(rows)
    check(spark, rows, block=block)


def test_many_equal_conversations_and_a_long_one(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(3)]
    rows += [(1000, t, "user" if t % 2 else "bot", f"x {t % 5}") for t in range(700)]
    check(spark, rows, block=64)


def test_edge_cases(spark):
    rows = [(5, None, "user", "a b"), (5, 0, None, None), (5, 0, "", ""), (5, 0, "user", "x"), (5, 0, "user", "x"), (None, 1, "user", "lost"),
            (21, 1, "user", None), (41, None, None, "only"), (40, 3, "user", "w " * 50000), (40, None, "bot", "\x0b\x0c"), (60, 2, "a", "b"), (61, 2, "a", "b"),
            (61, 2, "a", "b"), (61, 3, "ab", ""), (62, 1, "a", "")]
    check(spark, rows)
    check(spark, [(1, 0, "user", "alone")])
    check(spark, [r[:4] for r in rows], SCHEMA + ", no string, depth int, p1 string, conv string", [(*r, "z", 1, "y", None) for r in rows])
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert conversation_trie(spark.createDataFrame([(None, 1, "user", "lost")], SCHEMA)).count() == 0


@pytest.mark.parametrize("n,block,shuffled", [(1, 4, False), (60, 4, False), (200, 16, True)])
def test_list_ranking(spark, n, block, shuffled):
    """Shuffled ids: blocks hold no runs, the coin decides."""
    order = list(range(n))
    if shuffled:
        random.Random(4).shuffle(order)
    rows = [(x, order[i + 1] if i + 1 < n else None, [x, 1]) for i, x in enumerate(order)]
    got = {r.id: list(r.before) for r in prefix_sums(spark.createDataFrame(rows, "id long, next long, w array<long>"), block).collect()}
    assert got == {x: [sum(order[:i]), i] for i, x in enumerate(order)}


def test_query_equals_sql(spark):
    got = op11_euler_prefix_trie(spark, SF_SMALL)
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{SF_SMALL}/conversations.parquet')")
    want = con.execute(OP11_SQL)
    assert got.columns == [d[0] for d in want.description]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)
