"""Operator 13 - n-gram Jaccard join with rare-first prefix filtering.

A document is the set of its distinct three-word shingles.  Two documents are linked if the sets'
intersection is at least nine tenths of their union; linked documents share a component.

1. Documents of equal sets are one, by a 128-bit digest.  A set is cut into
   as many parts, by a hash of the shingle, as the largest difference of a linked pair of its
   size has shingles, and one part more: linked sets agree in a whole part.  Sets that
   agree with no other in any part have no partner and go no further.  The keys of the parts travel once, in arrays by
   ranges of their hash, with the sets they are of.
2. Document counts of all shingles of the others, over all the others, order each set rare first
   (classes of doubling counts, inside a class by hash).  A shingle that no other set has cannot be shared and
   only counts for the positions.
3. Prefix filter: a linked pair shares a shingle within the first n - ceil(0.9 n) + 1 of the larger and the
   first m - ceil(18 m / 19) + 1 of the smaller set.  Sets meet in the buckets of these
   shingles, under the length filter (sizes within a factor of 0.9) and the positional filter (what the
   first common shingle leaves of both must suffice).  What thousands share is not rare, so it is no one's
   prefix, unless they differ in little else.
4. Some pivots of a bucket meet its members in other components, in rounds; what is linked meets no more, so
   a group of copies costs a few passes and not all its pairs (see ``linking``).  A pair is verified once:
   suffix filter (sizes on both sides of middle shingles bound the difference), then the exact overlap.

Defined results
    null or empty text, no words: no shingles, linked with nothing, also not with equal rows; under
    three words: one shingle of all words; null ``doc_id``: takes part by its text, a
    component's id is the least ``doc_id`` in it, null if none has one; equal rows and
    equal texts: linked; very long texts: whole; an empty table gives no row; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import batches, bounded, fits, hinted, materialise
from kestrel.llm.linking import connected
from kestrel.llm.words import BLANK_WORDS, shingled, word_hashes

WIDTH = 3
#: Sets are linked from a similarity of SHARE / WHOLE.
SHARE, WHOLE = 9, 10
#: Bits of a shingle's hash below its rarity class.
HASH_BITS = 58
BATCH_BYTES = 4 << 20
#: Ranges of the keys of parts; within a range 32 more bits of a key count (what agrees by chance is found unlinked later).
RANGE_BITS = 11
#: Pivots of a bucket in the first round; a round has four times as many as the one before.
PIVOTS = 2
_MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def size_edges(largest: int) -> np.ndarray:
    """First sizes of the size classes: linked sets are of the same or of neighbouring classes."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(max(edges[-1] + 1, edges[-1] * WHOLE // SHARE))
    return np.array(edges, np.int64)


def part_keys(h: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the parts of consecutive sets: (all keys, how many each set has).

    A set of class c is cut for partners of class c and for those of class c - 1.  If the smaller set of a linked pair has
    at most b shingles, the two differ in at most b / 9, so that of b // 9 + 1 parts one agrees.
    """
    edges = size_edges(int(sizes.max(initial=1)) + 1)
    own = np.searchsorted(edges, sizes, "right") - 1
    place = ((h * _MIX[0]) >> np.uint64(33)).astype(np.int64)
    value = (h ^ (h >> np.uint64(29))) * _MIX[1]
    keys, owners = [], []
    for lower in (0, 1):
        family = own - lower
        some = family >= 0
        parts = np.where(some, (edges[np.maximum(family, 0) + 1] - 1) // 9 + 1, 0)
        base = np.cumsum(parts) - parts
        mine = np.repeat(some, sizes)
        sums = np.zeros(int(parts.sum()), np.uint64)
        np.add.at(sums, np.repeat(base, sizes)[mine] + place[mine] % np.repeat(parts, sizes)[mine], value[mine])
        owner = np.repeat(np.arange(len(sizes)), parts)
        number = (np.arange(len(sums)) - base[owner]).astype(np.uint64)
        salt = number * _MIX[2] + family[owner].astype(np.uint64) * _MIX[1]
        keys.append(((sums ^ (sums >> np.uint64(32))) * _MIX[0]) ^ (salt * _MIX[2]))
        owners.append(owner)
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(keys)[order], np.bincount(owner, minlength=len(sizes))


def _sets(texts: list[str]) -> list[np.ndarray]:
    return [np.unique(x) for x in shingled(*word_hashes(texts, BLANK_WORDS), WIDTH)]


def key_ranges(keys: np.ndarray, lows: np.ndarray) -> tuple[np.ndarray, pa.ListArray, pa.ListArray]:
    """Ranges of the keys and for each its keys, cut to 32 bits, and the sets they are of; equal rows once."""
    order = np.lexsort((lows, keys))
    keys, lows = keys[order], lows[order]
    first = np.ones(len(keys), bool)
    first[1:] = (keys[1:] != keys[:-1]) | (lows[1:] != lows[:-1])
    keys, lows = keys[first], lows[first]
    number, at = np.unique(keys >> np.uint64(64 - RANGE_BITS), return_index=True)
    offsets = pa.array(np.append(at, len(keys)), pa.int32())
    cut = (keys >> np.uint64(32 - RANGE_BITS)).astype(np.uint32).view(np.int32)
    return number.astype(np.int32), pa.ListArray.from_arrays(offsets, pa.array(cut)), pa.ListArray.from_arrays(offsets, pa.array(lows))


SETS = "doc_id long, raw binary, id binary, low long, n long, range int, keys array<int>, lows array<long>"
_NAMES = [c.split()[0] for c in SETS.split(", ")]


def _signed(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(source, 1000, column=2, chars=BATCH_BYTES):
        sets = _sets(batch.column(2).to_pylist())
        sizes = np.fromiter(map(len, sets), np.int64, len(sets))
        ids = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        low = [None if d is None else int.from_bytes(d[:8], "little", signed=True) for d in ids]
        rows = batch.num_rows
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(ids, pa.binary()), pa.array(low, pa.int64()), pa.array(sizes),
             pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.list_(pa.int32())), pa.nulls(rows, pa.list_(pa.int64()))], _NAMES)
        keys, counts = part_keys(np.concatenate([*sets, np.zeros(0, np.uint64)]), sizes)
        # rows of the parts have no document of their own
        number, cut, lows = key_ranges(keys, np.repeat(np.array([x or 0 for x in low], np.int64), counts))
        rows = len(number)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.binary()), pa.nulls(rows, pa.binary()), pa.nulls(rows, pa.int64()),
             pa.nulls(rows, pa.int64()), pa.array(number), cut, lows], _NAMES)


def _sharing(group: pa.Table) -> pa.Table:
    """The sets of a range of which a key is of another set too."""
    keys, lows = (group.column(c).combine_chunks().flatten().to_numpy() for c in ("keys", "lows"))
    order = np.lexsort((lows, keys))
    keys, lows = keys[order], lows[order]
    begins = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    several = lows[begins] != lows[np.append(begins[1:], len(keys)) - 1]
    found = np.repeat(several, np.diff(np.append(begins, len(keys))))
    return pa.table({"low": pa.array(np.unique(lows[found]))})


def _grams(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(source, 500, column=1, chars=BATCH_BYTES):
        sets = _sets(batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["id", "grams"])


def _open(signed: DataFrame) -> DataFrame:
    """(id, raw, doc_id) of one row of each set that agrees with another set in a part."""
    shared = signed.where("range is not null").select("range", "keys", "lows").groupBy("range").applyInArrow(_sharing, "low long")
    mine = signed.where("id is not null").select("low", "id", "raw", "doc_id").join(bounded(shared.distinct(), "sharing-sets"), "low", "left_semi")
    return mine.groupBy("id").agg(F.min(F.struct("raw", "doc_id")).alias("row")).select("id", "row.*")


def rare_first(grams: DataFrame) -> DataFrame:
    """(id, grams) -> (id, n, tokens): the shingles that another set has too, in rare-first order.

    A token's upper bits are the logarithm of its shingle's document count, the lower ones its hash.
    """
    rows = grams.select("id", F.explode("grams").alias("h"))
    counts = rows.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    rarity = F.least(F.lit(31), F.floor(F.log2("df"))).cast("long")
    token = F.shiftleft(rarity, HASH_BITS).bitwiseOR(F.shiftrightunsigned("h", 64 - HASH_BITS))
    known = bounded(counts.select("h", token.alias("token")), "shingle-counts")
    tokens = rows.join(known, "h").groupBy("id").agg(F.sort_array(F.collect_list("token")).alias("tokens"))  # one set, no group
    return grams.select("id", F.size("grams").cast("long").alias("n")).join(tokens, "id")


def prefix_members(sets: DataFrame) -> DataFrame:
    """(key, id, n, place): the prefix shingles of each set and their places in it, from 1."""
    n = F.col("n")
    alone = n - F.size("tokens")  # shingles of no other set come first
    prefix = n - F.ceil(n * SHARE / WHOLE) + 1
    rows = sets.select("id", "n", alone.alias("alone"), F.posexplode(F.slice("tokens", F.lit(1), F.greatest(F.lit(0), prefix - alone).cast("int"))).alias("i", "key"))
    return rows.select("key", "id", "n", (F.col("alone") + F.col("i") + 1).alias("place"))


def overlap_needed(n: Column, m: Column) -> Column:
    """Fewest common shingles of linked sets of these sizes."""
    return F.ceil((n + m) * SHARE / (SHARE + WHOLE))


def _may_link() -> Column:
    """Length, prefix and positional filter of a member (n, place, id) and a pivot (m, at, pivot) of a bucket."""
    n, m, place, at = (F.col(c) for c in ("n", "m", "place", "at"))
    smaller = (n < m) | ((n == m) & (F.col("id") < F.col("pivot")))
    low, low_place = F.when(smaller, n).otherwise(m), F.when(smaller, place).otherwise(at)
    indexed = low_place <= low - F.ceil(low * (2 * SHARE) / (SHARE + WHOLE)) + 1
    length = (WHOLE * n >= SHARE * m) & (WHOLE * m >= SHARE * n)
    return length & indexed & (1 + F.least(n - place, m - at) >= overlap_needed(n, m))


def most_shared(a: np.ndarray, b: np.ndarray, depth: int = 3) -> int:
    """Suffix filter: a bound on the common elements of two sorted arrays, from the numbers of elements on
    both sides of middle ones."""
    if depth == 0 or len(a) < 8 or len(b) < 8:
        return min(len(a), len(b))
    middle = a[len(a) // 2]
    i, j = len(a) // 2, int(np.searchsorted(b, middle))
    return most_shared(a[:i], b[:j], depth - 1) + most_shared(a[i:], b[j:], depth - 1)


def common(a: np.ndarray, b: np.ndarray) -> int:
    if not len(a) or not len(b):
        return 0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    return int((b[at] == a).sum())


def linked(n: int, a: np.ndarray, m: int, b: np.ndarray) -> bool:
    """Whether sets of n and m shingles, of which a and b are those with a second owner, are linked."""
    need = -(-(n + m) * SHARE // (SHARE + WHOLE))
    return most_shared(a, b) >= need and common(a, b) >= need


def _score(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(source, 500, column=3, chars=BATCH_BYTES):
        n, m = batch.column(2).to_pylist(), batch.column(4).to_pylist()
        sides = []
        for c in (3, 5):
            values, at = batch.column(c).flatten().to_numpy(), np.cumsum([0, *batch.column(c).value_lengths().to_pylist()])
            sides.append([values[i:j] for i, j in zip(at, at[1:])])
        keep = [linked(*x) for x in zip(n, sides[0], m, sides[1])]
        yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    if fits(pairs):  # only their sets go to the pairs
        ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
        sets = sets.join(hinted(ids, pairs), "id", "left_semi")
    first = sets.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    second = sets.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = second.join(first.join(hinted(pairs), "a"), "b")  # the pairs go to the sets
    return both.select("a", "b", "na", "ta", "nb", "tb").mapInArrow(_score, "a binary, b binary")


def link_prefixes(members: DataFrame, sets: DataFrame) -> DataFrame | None:
    """Components (id, comp) of the sets that are linked; None if no pair is.

    Rounds: pivots of every bucket that is not within one component meet its members in
    other components.  They come from outside the bucket's largest component, those that meet most sets first.  A bucket is done when
    all members outside its largest component were pivots: each of its pairs is then verified, ruled out by a filter, or connected.
    """
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    rows = materialise(members.join(bounded(sizes, "bucket-sizes", factor=3), "key"), "buckets")
    degrees = rows.groupBy("id").agg(F.sum("size").alias("degree"))
    rows = materialise(rows.drop("size").join(hinted(degrees, rows), "id"), "buckets")
    asked, pivoted, links = [], [], []
    comp, pivots_a_bucket = None, PIVOTS
    while True:
        if comp is None:
            outside = rows = rows.withColumn("comp", F.col("id"))
        else:
            rows = rows.drop("comp").join(hinted(comp), "id", "left").withColumn("comp", F.coalesce("comp", "id"))
            parts = rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("rows")).groupBy("key").agg(
                F.count(F.lit(1)).alias("parts"), F.max(F.struct("rows", "comp")).alias("main"))
            split = bounded(parts.where("parts > 1").select("key", F.col("main.comp").alias("main")), "open-buckets")
            rows = materialise(rows.join(split, "key"), "open-rows")
            done = bounded(reduce(DataFrame.unionByName, pivoted), "pivoted")
            outside = rows.where("comp <> main").join(done, ["key", "id"], "left_anti")
            rows = rows.drop("main")
        # the best of each of some groups of a bucket: a partial aggregate, no bucket is ranked in one task
        group = F.pmod(F.xxhash64("id"), F.lit(pivots_a_bucket))
        best = outside.groupBy("key", group.alias("g")).agg(F.max(F.struct("degree", "id", "n", "place", "comp")).alias("x"))
        pivots = materialise(best.select("key", F.col("x.id").alias("pivot"), F.col("x.n").alias("m"),
                                         F.col("x.place").alias("at"), F.col("x.comp").alias("own")), "pivots")
        if pivots.isEmpty():
            return comp
        pivoted.append(pivots.select("key", F.col("pivot").alias("id")))
        met = rows.join(hinted(pivots), "key").where((F.col("comp") != F.col("own")) & _may_link())
        pairs = met.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()
        if asked:
            pairs = pairs.join(bounded(reduce(DataFrame.unionByName, asked), "asked"), ["a", "b"], "left_anti")
        pairs = materialise(pairs, "pairs")
        good = pairs
        if not pairs.isEmpty():
            asked.append(pairs)
            good = materialise(_verified(pairs, sets), "links")
        if not good.isEmpty():
            links.append(good)
            comp = connected(reduce(DataFrame.unionByName, links))
        elif comp is None:
            comp = materialise(members.select("id", F.col("id").alias("comp")).limit(0), "comp")
        pivots_a_bucket *= 4


def jaccard_components(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id."""
    text = F.coalesce("text", F.lit(""))
    inputs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("raw"), text.alias("text"))
    signed = materialise(inputs.mapInArrow(_signed, SETS), "sets")
    wanted = bounded(_open(signed), "open-sets")
    same = (F.col("raw") == F.col("wanted_raw")) & F.col("doc_id").eqNullSafe(F.col("wanted_doc"))
    found = inputs.join(wanted.select("id", F.col("raw").alias("wanted_raw"), F.col("doc_id").alias("wanted_doc")), same).select("id", "text")
    grams = materialise(found.mapInArrow(_grams, "id binary, grams array<long>").dropDuplicates(["id"]), "grams")
    sets = materialise(rare_first(grams), "rare-first")
    comp = link_prefixes(materialise(prefix_members(sets), "prefixes"), sets)
    rows = signed.where("range is null").select("doc_id", F.col("n").alias("n_shingles"), "id")
    if comp is not None:
        rows = rows.join(hinted(comp), "id", "left").withColumn("id", F.coalesce("comp", "id"))
    rows = materialise(rows.select("doc_id", "n_shingles", "id"), "roots")
    named = bounded(rows.where("id is not null").groupBy("id").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows"))
                    .where("rows > 1"), "components")
    out = rows.join(named, "id", "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("rows") > 1, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def op13_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"))


OP13_SQL = """
with recursive texts as (
  select row_number() over () as rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
  from documents),
grams as (
  select distinct rid, g from (
    select rid, array_to_string(list_slice(w, i, i + 2), ' ') as g from (select rid, w, unnest(range(1, len(w) - 1)) as i from texts where len(w) >= 3)
    union all select rid, array_to_string(w, ' ') from texts where len(w) in (1, 2))),
sizes as (select rid, count(*) as n from grams group by rid),
shared as (select g from grams group by g having count(*) > 1),
common as (select rid, g from grams semi join shared using (g)),
pairs as (select a.rid as a, b.rid as b, count(*) as both from common a join common b on a.g = b.g and a.rid < b.rid group by all),
links as (
  select p.a, p.b from pairs p join sizes x on x.rid = p.a join sizes y on y.rid = p.b where 100 * p.both >= 90 * (x.n + y.n - p.both)),
edges as (select a, b from links union all select b, a from links),
reach(a, b) as (select a, b from edges union select r.a, e.b from reach r join edges e on e.a = r.b)
select t.doc_id, coalesce(any_value(s.n), 0) as n_shingles, least(t.doc_id, min(o.doc_id)) as component_id
from texts t left join sizes s on s.rid = t.rid left join reach r on r.a = t.rid left join texts o on o.rid = r.b group by t.rid, t.doc_id
"""
