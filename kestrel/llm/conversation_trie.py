"""Operator 11 - prefix trie of conversations by the Euler-tour technique.

1. Turns are numbered within their conversation and rebuilt (``rebuilt``).
2. A prefix is known by its depth and the sums, over its turns, of a 128-bit hash of (turn, place), so that prefixes of
   all lengths come from running sums and no conversation has to be in one row.  Equal prefixes are a node.
3. Nodes are numbered by (smallest member, depth).  Each has an arc that enters and one that leaves it.  Entering leads
   to the first child or to the node's own exit, an exit to the next sibling's entry or the parent's exit: one
   list, the Euler tour.  Siblings follow each other by a dense numbering of (parent, node), so that a node with very many
   children is not in one task.
4. The tour is ranked distributedly (``list_ranking``) with leaves and savings as weights of the entries: what a node's subtree has is the
   difference of the sums before its exit and before its entry.
5. The digest of the conversations that end in a node takes their ids in order: runs of ids are joined where they are sorted, the
   task of the node streams these pieces through SHA-256, which is sequential by definition.

Defined results
    null ``conv_id``: of no conversation, left out; null ``turn``: first; ties in ``turn``: by role,
    then text; null role or text: empty; equal rows: turns of their own; very long texts: whole; an empty table gives no row;
    other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import bounded, materialise
from kestrel.llm.list_ranking import BLOCK, prefix_sums
from kestrel.operators.ranking import dense_index, keyed_prefix_sums

#: Conversations share the first turns of the one whose id is the multiple of GROUP below, up to MOST - 1 of them.
GROUP, MOST = 20, 4
SUMS = ["p1", "p2", "p3", "p4"]
#: Characters of joined ids in a piece.
PIECE = 1 << 20


def _halves(name: str, value: Column) -> list[Column]:
    """Two sums' worth of a 64-bit hash: they cannot overflow below 2 ** 31 turns."""
    low = F.lit((1 << 32) - 1)
    return [value.bitwiseAND(low).alias(f"p{2 * int(name) - 1}"), F.shiftrightunsigned(value, 32).alias(f"p{2 * int(name)}")]


def rebuilt(conversations: DataFrame, group: int = GROUP, most: int = MOST) -> tuple[DataFrame, DataFrame]:
    """(turns: conv, place, t1, t2, words; convs: conv, total).

    Conversation c has the first h turns of conversation c - c % group, h = crc32(c) % most, then its own after its first h.
    """
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    hashed = rows.select("conv", "turn", F.xxhash64("role", "text").alias("t1"), F.xxhash64(F.lit(1), "text", "role").alias("t2"),
                         F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"), "role", "text",
                         F.monotonically_increasing_id().alias("rid"), F.lit(1).cast("long").alias("one"))
    hashed = materialise(hashed, "turns")
    numbered = keyed_prefix_sums(hashed, "conv", ["turn", "role", "text", "rid"], ["one"])
    own = materialise(numbered.select("conv", (F.col("one_before") + 1).alias("k"), "t1", "t2", "words"), "own-turns")

    sizes = materialise(own.groupBy("conv").agg(F.max("k").alias("own")), "sizes")
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    heads = sizes.select("conv", "own", h.alias("h"), (F.col("conv") - F.pmod("conv", F.lit(group))).alias("anchor"))
    anchors = sizes.select(F.col("conv").alias("anchor"), F.col("own").alias("there"))
    heads = heads.join(anchors, "anchor", "left").withColumn("shared", F.least("h", F.coalesce("there", F.lit(0))))
    heads = bounded(heads.select("conv", "anchor", "h", "shared", (F.col("shared") + F.greatest(F.lit(0), F.col("own") - F.col("h"))).alias("total")), "heads")
    later = own.join(heads, "conv").where("k > h").select("conv", (F.col("shared") + F.col("k") - F.col("h")).alias("place"), "t1", "t2", "words")
    wanted = heads.where("shared > 0").select("conv", "anchor", F.explode(F.sequence(F.lit(1).cast("long"), F.col("shared"))).alias("place"))
    first = own.where(F.col("k") < most).select(F.col("conv").alias("anchor"), F.col("k").alias("place"), "t1", "t2", "words")
    shared = wanted.join(first, ["anchor", "place"]).select("conv", "place", "t1", "t2", "words")
    return later.unionByName(shared), heads.select("conv", "total")


def _key(depth: Column, sums: list[Column], *names: str) -> list[Column]:
    return [F.xxhash64(F.lit(i), depth, *sums).alias(name) for i, name in enumerate(names)]


def trie_nodes(turns: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes: no, k1, k2, pk1, pk2, conv, depth, n_convs, words; ends: conv, k1, k2)."""
    placed = turns.select("conv", "place", "words", *_halves("1", F.xxhash64("t1", "place")), *_halves("2", F.xxhash64("place", "t2", F.lit(2))))
    sums = keyed_prefix_sums(placed, "conv", "place", SUMS)
    before, upto = [F.col(f"{p}_before") for p in SUMS], [F.col(f"{p}_before") + F.col(p) for p in SUMS]
    rows = sums.select("conv", F.col("place").alias("depth"), "words", *_key(F.col("place"), upto, "k1", "k2"),
                       *_key(F.col("place") - 1, before, "pk1", "pk2"))
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = _key(zero, [zero] * 4, "k1", "k2")
    tops = convs.select("conv", zero.alias("depth"), zero.alias("words"), *root, none.alias("pk1"), none.alias("pk2"))
    rows = materialise(rows.unionByName(tops), "prefixes")
    nodes = rows.groupBy("k1", "k2").agg(F.min("conv").alias("conv"), F.min("depth").alias("depth"), F.count(F.lit(1)).alias("n_convs"),
                                         F.min("words").alias("words"), F.min("pk1").alias("pk1"), F.min("pk2").alias("pk2"))
    ends = rows.join(convs.select("conv", F.col("total").alias("depth")), ["conv", "depth"]).select("conv", "k1", "k2")
    return materialise(dense_index(nodes, ["conv", "depth"], "no"), "nodes"), ends


def euler_tour(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes with parent_conv_id and n_children; arcs: id, next, w).  Arc 2 * no enters a node, 2 * no + 1 leaves it."""
    parents = nodes.select(F.col("k1").alias("pk1"), F.col("k2").alias("pk2"), F.col("no").alias("parent"), F.col("conv").alias("parent_conv_id"))
    hung = materialise(nodes.join(parents, ["pk1", "pk2"], "left").drop("pk1", "pk2"), "hung")
    below = hung.where("parent is not null").groupBy(F.col("parent").alias("no")).agg(F.min("no").alias("first"), F.count(F.lit(1)).alias("n_children"))
    hung = hung.join(bounded(below, "children"), "no", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    children = materialise(dense_index(hung.where("parent is not null").select("parent", "no"), ["parent", "no"], "place"), "siblings")
    after = children.select((F.col("place") - 1).alias("place"), F.col("parent").alias("parent_after"), F.col("no").alias("sibling"))
    following = children.join(after, "place").where("parent = parent_after").select("no", "sibling")
    hung = materialise(hung.join(bounded(following, "following"), "no", "left"), "tour-nodes")
    no, zero = F.col("no"), F.lit(0).cast("long")
    weights = F.array((F.col("n_children") == 0).cast("long"), (F.col("n_convs") - 1) * F.col("words"))
    enter = F.struct((2 * no).alias("id"), F.coalesce(2 * F.col("first"), 2 * no + 1).alias("next"), weights.alias("w"))
    leave = F.struct((2 * no + 1).alias("id"), F.coalesce(2 * F.col("sibling"), 2 * F.col("parent") + 1).alias("next"), F.array(zero, zero).alias("w"))
    return hung, hung.select(F.explode(F.array(enter, leave)).alias("arc")).select("arc.*")


def _joined(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (no, conv) -> (no, first, ids): runs of ids of a node, joined by commas, in pieces of bounded size."""
    now, first, ids, size = None, None, [], 0

    def piece():
        return pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())], ["no", "first", "ids"])

    out: tuple[list, list, list] = ([], [], [])

    def close():
        if ids:
            for column, value in zip(out, (now, first, ",".join(ids))):
                column.append(value)

    for batch in source:
        for no, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if no != now or size >= PIECE:
                close()
                now, first, ids, size = no, conv, [], 0
            ids.append(str(conv))
            size += len(ids[-1]) + 1
        yield piece()
        out = ([], [], [])
    close()
    yield piece()


def _digests(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces sorted by (no, first) -> (no, digest)."""
    now, state = None, None
    for batch in source:
        nos, found = [], []
        for no, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if no != now:
                if state is not None:
                    nos.append(now)
                    found.append(state.hexdigest())
                now, state = no, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(nos, pa.int64()), pa.array(found, pa.string())], ["no", "digest"])
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([state.hexdigest()])], ["no", "digest"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(no, conv) -> (no, digest): SHA-256 of each node's ids in ascending order."""
    pieces = ends.select("no", "conv").repartitionByRange("no", "conv").sortWithinPartitions("no", "conv").mapInArrow(_joined, "no long, first long, ids string")
    return pieces.repartition("no").sortWithinPartitions("no", "first").mapInArrow(_digests, "no long, digest string")


def conversation_trie(conversations: DataFrame, block: int = BLOCK) -> DataFrame:
    """Per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    nodes, ends = trie_nodes(*rebuilt(conversations))
    ended = bounded(ends.join(nodes.select("k1", "k2", "no"), ["k1", "k2"]).select("no", "conv"), "ends")
    hung, arcs = euler_tour(nodes)
    sums = prefix_sums(arcs, block)
    sign = F.when(F.col("id").bitwiseAND(F.lit(1)) == 1, 1).otherwise(-1)
    parts = sums.groupBy(F.shiftright("id", 1).alias("no")).agg(F.sum(sign * F.col("before")[0]).alias("n_leaves"), F.sum(sign * F.col("before")[1]).alias("saved_tokens"))
    out = hung.join(parts, "no").join(bounded(end_digests(ended), "digests"), "no", "left")
    return out.select(F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("digest", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))


def op11_euler_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet"))


#: CRC-32 by bits: of each character's byte an exclusive or, then eight steps.
OP11_SQL = """
with turns as (
  select cast(conv_id as bigint) as c, coalesce(role, '') as role, coalesce(text, '') as text, turn from conversations where conv_id is not null),
own as (select c, list({'role': role, 'text': text} order by turn nulls first, role, text) as s from turns group by c),
stepped as (
  select c, s, c - ((c % 20) + 20) % 20 as anchor, cast(xor(list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(cast(c as varchar), ''),
      lambda ch: [ascii(ch)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))),
      lambda x, b: case when b >= 0 then xor(x, b) else case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end end), 4294967295::bigint) % 4 as int) as h
  from own),
whole as (
  select a.c, list_concat(coalesce(list_slice(b.s, 1, a.h), []), list_slice(a.s, a.h + 1, len(a.s))) as s
  from stepped a left join own b on b.c = a.anchor),
prefixes as (select c, d, list_slice(s, 1, d) as p, d = len(s) as ends from (select c, s, unnest(range(0, len(s) + 1)) as d from whole)),
nodes as (
  select d, p, min(c) as conv, count(*) as n_convs, coalesce(string_agg(case when ends then cast(c as varchar) end, ',' order by c), '') as ids,
    case when d = 0 then 0 else (count(*) - 1) * len(regexp_extract_all(p[d].text, '[^\\x20\\x09-\\x0D]+')) end as saved
  from prefixes group by d, p),
linked as (
  select n.*, q.conv as parent_conv from nodes n left join nodes q on q.d = n.d - 1 and q.p = list_slice(n.p, 1, n.d - 1)),
kids as (select d - 1 as d, parent_conv as conv, count(*) as n from linked where d > 0 group by all),
counted as (select l.*, coalesce(k.n, 0) as n_children from linked l left join kids k on k.d = l.d and k.conv = l.conv),
above as (
  select a, list_slice(p, 1, a) as p, sum(cast(n_children = 0 as bigint)) as n_leaves, sum(saved) as saved
  from (select p, n_children, saved, unnest(range(0, d + 1)) as a from counted) group by a, list_slice(p, 1, a))
select n.conv as conv_id, n.d as depth, n.parent_conv as parent_conv_id, n.n_convs, n.n_children, cast(u.n_leaves as bigint) as n_leaves,
  cast(u.saved as bigint) as saved_tokens, sha256(n.ids) as ends_sha256
from counted n join above u on u.a = n.d and u.p = n.p
"""
