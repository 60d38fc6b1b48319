"""Operator 10 - near-duplicate documents by improved consistent weighted sampling.

A document is its five-word shingles with TF-IDF weights.  Every hash of improved consistent
weighted sampling picks one (shingle, level) of a document, and two documents
agree with the probability of their weighted Jaccard similarity.  Bands of
such picks are buckets; documents that meet in a bucket are verified by their
exact weighted Jaccard similarity, and links of ``THRESHOLD`` or more make classes.

Pairs of a bucket.  Of up to ``FEW`` members all meet.  The members of larger buckets, of copies or
of texts that share a passage and little else, meet by an exact prefix filter instead: shingles are ordered
by their document counts among these members, rare first; linked texts have a common shingle from which on both hold
enough weight, so a text is a key only by the shingles before less than ``THRESHOLD`` of its weight is left, and what
nobody else has counts for nothing.  A passage that thousands share comes last and is no key, unless the texts
differ in little else.  Sizes and the weights left bound the overlap before a pair is made.

Weights.  ``(1 + ln tf) * (1 + ln(N / df))`` with the document count of every shingle.  The few shingles
in at least ``HEAVY`` of the documents, at most (mean shingles per document) / HEAVY of
them at any corpus size, are counted exactly and broadcast: a first pass keeps what is that frequent in some
chunk of the documents (nothing else can be in all), a second pass counts these over all documents.  All others are
shuffled by their hash and counted there; the counts of two or more go back to the texts, which are spread over blocks of bounded
size by a hash of the row, once for each block that holds the shingle.  What does not come back stands in one document.  A text's counts are kept
with its signature, so that links are verified with the weights its hashes were drawn by.

Copies.  What a group of g copies shares has the weight 1 + ln(N / g), an edited word's shingles have 1 + ln N: as the table and its
groups grow, one edited word outweighs ever more shared ones, and a near copy falls below any threshold.  So no shingle has an
inverse document frequency of more than ``LEAD`` times the one in the middle of its text's weight.  What is common keeps its low weight, and
a text whose weight is mostly its own loses nothing; near copies that differ in few enough shingles (a Jaccard similarity of 0.834,
``THRESHOLD * LEAD / (1 - THRESHOLD + THRESHOLD * LEAD)``, where what they share weighs alike) are linked however large their group is.

Defined results
    null text: like the empty text; a text without words is in no group (class of its own, by
    ``doc_id``); under five words: one shingle of all words; null ``doc_id``: takes part by its
    text, the class id is the least ``doc_id`` of the class, null if none has one;
    equal rows and equal texts: one class; ties: the least ``doc_id``; an empty table gives no
    row; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import batches, bounded, hinted, materialise
from kestrel.llm.linking import connected, link_filtered, shared_buckets
from kestrel.llm.words import shingled, word_hashes

WIDTH, THRESHOLD = 5, 0.8
#: At similarity 0.8 a pair is missed with probability (1 - 0.8 ** 3) ** 12 < 0.0002.
BANDS, ROWS = 12, 3
#: Members of a bucket that meet pair by pair: the least and the greatest id meet the others.
FEW = 3
#: Bits of a shingle's hash below its rarity class; what rounding may take from a bound.
HASH_BITS, SLACK = 58, 1e-9
#: Share of the documents from which a shingle's document count is broadcast, not shuffled.
HEAVY = 0.1
#: How many times the inverse document frequency in the middle of a text's weight one of its shingles has at most.
LEAD = 1.25
#: Characters of the texts of a block, and of those whose shingles a counting task holds (about a sixth as many).
BLOCK_CHARS, BUCKET_CHARS = 8 << 20, 12 << 20
#: Shingles that a task sorts before it hands them on.
SORTED = 1 << 20
#: Distinct shingles a task holds while it looks for frequent ones, and candidates counted in one pass.
CHUNK, CANDIDATES = 3_000_000, 2_000_000
BATCH_BYTES = 4 << 20
#: Random triples (r, ln c, beta) per hash function; a shingle's hash picks one.
TABLE_BITS = 14


class Sampler:
    """The random variables of improved consistent weighted sampling (Gamma(2,1), Gamma(2,1), uniform)."""

    def __init__(self, count: int, seed: int = 1):
        rng, n = np.random.default_rng(seed), 1 << TABLE_BITS
        self.count = count
        self.odd = rng.integers(1, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.r = rng.gamma(2.0, 1.0, (count, n)).astype(np.float32)
        self.log_c = np.log(rng.gamma(2.0, 1.0, (count, n))).astype(np.float32)
        self.beta = rng.random((count, n)).astype(np.float32)

    def samples(self, h: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Per segment of ``h`` (from ``starts``) and hash function, one 64-bit pick."""
        log_w = np.log(weights).astype(np.float32)
        out = np.empty((len(starts), self.count), np.int64)
        low = (h >> np.uint64(32)).astype(np.uint32)
        for k in range(self.count):
            at = ((h * self.odd[k]) >> np.uint64(64 - TABLE_BITS)).astype(np.int32)
            r, beta = self.r[k][at], self.beta[k][at]
            level = np.floor(log_w / r + beta)
            a = self.log_c[k][at] - r * (level - beta) - r
            bits = a.view(np.int32)
            bits = bits ^ ((bits >> 31) & np.int32(0x7FFFFFFF))  # integers in the order of the floats
            pick = low ^ (level.astype(np.int32).view(np.uint32) * np.uint32(2654435761))
            out[:, k] = np.minimum.reduceat((bits.astype(np.int64) << 32) | pick.astype(np.int64), starts)
        return out


class Weights:
    """Weights of shingles by how often they occur in a document and in how many of ``n_docs`` documents they occur.

    ``heavy``: document counts of the most frequent ones."""

    def __init__(self, n_docs: int, heavy: dict[int, int]):
        keys = sorted(heavy)
        self.n_docs = n_docs
        self.keys = np.array(keys, np.uint64)
        self.heavy = np.array([heavy[k] for k in keys], np.int64)
        self.rare = 1 + math.log(max(1, n_docs))

    def light(self, h: np.ndarray) -> np.ndarray:
        """Which shingles are not among the most frequent ones."""
        return ~_found(self.keys, h)[0]

    def counts(self, h: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Document counts, given those of two and more of the other shingles by their sorted ``keys``."""
        df = np.ones(len(h), np.int64)
        for known, n in ((keys, counts), (self.keys, self.heavy)):
            hit, at = _found(known, h)
            df[hit] = n[at[hit]]
        return df

    def led(self, tf: np.ndarray, df: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Document counts, raised where a shingle's weight would be over ``LEAD`` times the middle one of its text's; texts begin at ``starts``."""
        sizes = np.diff(np.append(starts, len(df)))
        order = np.lexsort((-df, np.repeat(np.arange(len(sizes)), sizes)))
        sums = np.cumsum(self(tf[order], df[order]))
        before = np.concatenate([[0.0], sums])[starts]
        half = np.searchsorted(sums, (before + sums[starts + sizes - 1]) / 2)
        middle = df[order][np.clip(half, starts, starts + sizes - 1)]
        least = np.floor(self.n_docs * np.exp(1 - LEAD * (1 + np.log(self.n_docs / middle)))).astype(np.int64)
        return np.maximum(df, np.repeat(least, sizes))

    def __call__(self, tf: np.ndarray, df: np.ndarray) -> np.ndarray:
        return (1 + np.log(tf)) * (1 + np.log(self.n_docs / df))


def _found(keys: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``h`` are among the sorted ``keys``, and where."""
    if not len(keys):
        return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return keys[at] == h, at


def _planes(x: np.ndarray) -> bytes:
    """64-bit numbers, all their first bytes, then all second ones and so on: what is zero in most compresses."""
    return x.view(np.uint8).reshape(-1, 8).T.tobytes()


def _from_planes(parts: list[bytes]) -> list[np.ndarray]:
    return [np.ascontiguousarray(np.frombuffer(p, np.uint8).reshape(8, -1).T).view(np.uint64).ravel() for p in parts]


def _steps(h: np.ndarray) -> bytes:
    """Rising numbers by their differences."""
    return _planes(np.concatenate([h[:1], h[1:] - h[:-1]]))


def _from_steps(parts: list[bytes]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64)] + [np.cumsum(x, dtype=np.uint64) for x in _from_planes(parts)])


def _numbers(parts: list[bytes]) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.uint64)] + _from_planes(parts)).view(np.int64)


def _packed(df: np.ndarray) -> bytes:
    return zlib.compress(df.astype("<i8").tobytes(), 1)


def _unpacked(df: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(df), "<i8")


def vector(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A text's distinct shingles and how often each occurs."""
    return np.unique(shingled(*word_hashes([text]), WIDTH)[0], return_counts=True)


def _distinct(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    return h[np.concatenate([[True], h[1:] != h[:-1]])] if len(h) else h


def _jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    if not len(a) or not len(b):
        return 0.0
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    hit = b[at] == a
    shared = np.minimum(wa[hit], wb[at[hit]]).sum()
    return float(shared / (wa.sum() + wb.sum() - shared))


def _signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def frequent(texts: DataFrame, n_docs: int, share: float = HEAVY) -> dict[int, int]:
    """Exact document counts of the shingles in at least ``share`` of the documents."""

    def local(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, docs, size = [], 0, 0

        def common():
            h, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([_signed(h[n >= share * docs])], ["h"])

        for batch in batches(source, column=0, chars=BATCH_BYTES):
            for h in shingled(*word_hashes(batch.column(0).to_pylist()), WIDTH):
                held.append(_distinct(h))
                docs += 1
                size += len(held[-1])
                if size >= CHUNK:
                    yield common()
                    held, docs, size = [], 0, 0
        if held:
            yield common()

    found = materialise(texts.mapInArrow(local, "h long").distinct(), "frequent")
    parts = -(-found.count() // CANDIDATES)
    heavy: dict[int, int] = {}
    for part in range(parts):
        rows = found.where(F.pmod("h", F.lit(parts)) == part).collect()  # at most about CANDIDATES
        keys = np.sort(np.array([r.h for r in rows], np.int64).view(np.uint64))
        shared = texts.sparkSession.sparkContext.broadcast(keys)

        def counted(source: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            keys = shared.value
            total = np.zeros(len(keys), np.int64)
            for batch in batches(source, column=0, chars=BATCH_BYTES):
                for h in shingled(*word_hashes(batch.column(0).to_pylist()), WIDTH):
                    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                    total[np.unique(at[keys[at] == h])] += 1
            some = total > 0
            yield pa.RecordBatch.from_arrays([_signed(keys[some]), pa.array(total[some])], ["h", "n"])

        counts = texts.mapInArrow(counted, "h long, n long").groupBy("h").agg(F.sum("n").alias("df"))
        heavy |= {r.h % (1 << 64): r.df for r in counts.where(F.col("df") >= share * n_docs).collect()}
        shared.unpersist()
    return heavy


SIGNED = pa.schema([("doc_id", pa.int64()), ("raw", pa.binary()), ("digest", pa.binary()), ("bands", pa.list_(pa.int64())),
                    ("df", pa.binary())])


def document_counts(texts: DataFrame, weights, buckets: int) -> DataFrame:
    """(block, text) -> (block, h, df): per block, in pieces, which shingles of its texts are in two documents or more of all,
    and in how many; those that ``weights`` knows are left out.  ``h`` and ``df`` are packed by ``_steps`` and ``_planes``."""

    def spread(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w, held, blocks, size = weights.value, [], [], 0

        def pieces():
            h, block = np.concatenate(held), np.concatenate(blocks)
            order = np.argsort(h)
            h, block = h[order], block[order]
            bucket = ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            at = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            ends = np.append(at[1:], len(h))
            return pa.RecordBatch.from_arrays(
                [pa.array(bucket[at].astype(np.int64)), pa.array([_steps(h[i:j]) for i, j in zip(at, ends)], pa.binary()),
                 pa.array([_planes(block[i:j]) for i, j in zip(at, ends)], pa.binary())], ["bucket", "h", "block"])

        for batch in batches(source, column=1, chars=BATCH_BYTES):
            for b, h in zip(batch.column(0).to_pylist(), shingled(*word_hashes(batch.column(1).to_pylist()), WIDTH)):
                h = _distinct(h)
                h = h[w.light(h)]
                held.append(h)
                blocks.append(np.full(len(h), b, np.int64))
                size += len(h)
                if size >= SORTED:
                    yield pieces()
                    held, blocks, size = [], [], 0
        if size:
            yield pieces()

    def counted(rows: pa.Table) -> pa.Table:
        h, block = _from_steps(rows.column("h").to_pylist()), _numbers(rows.column("block").to_pylist())
        order = np.argsort(h)
        h, block = h[order], block[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        n = np.diff(np.append(first, len(h)))
        df = np.repeat(n, n)
        several = df > 1
        h, block, df = h[several], block[several], df[several]
        order = np.lexsort((h, block))
        h, block, df = h[order], block[order], df[order]
        once = np.concatenate([[True], (h[1:] != h[:-1]) | (block[1:] != block[:-1])]) if len(h) else several[:0]
        h, block, df = h[once], block[once], df[once]
        at = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]])) if len(h) else np.zeros(0, np.int64)
        ends = np.append(at[1:], len(h))
        return pa.table([pa.array(block[at]), pa.array([_steps(h[i:j]) for i, j in zip(at, ends)], pa.binary()),
                         pa.array([_planes(df[i:j]) for i, j in zip(at, ends)], pa.binary())], ["block", "h", "df"])

    pieces = texts.select("block", "text").mapInArrow(spread, "bucket long, h binary, block binary")
    return pieces.groupBy("bucket").applyInArrow(counted, "block long, h binary, df binary")


def _signed_docs(weights, bands: int, rows: int, seed: int):
    def sign(docs: pa.Table, counts: pa.Table) -> pa.Table:
        sampler, w = Sampler(bands * rows, seed), weights.value
        band_mix = np.random.default_rng(seed + 1).integers(1, 1 << 62, (bands, rows), dtype=np.int64) * 2 + 1
        known, n = _from_steps(counts.column("h").to_pylist()), _numbers(counts.column("df").to_pylist())
        order = np.argsort(known)
        known, n = known[order], n[order]
        out = []
        for batch in batches(docs.select(["doc_id", "raw", "text"]).to_batches(), 400, column=2, chars=BATCH_BYTES):
            hashes, counts = word_hashes(batch.column(2).to_pylist())
            ends = np.cumsum(counts).tolist()
            digests = [hashlib.blake2b(hashes[e - c:e].tobytes(), digest_size=16).digest() if c else None
                       for e, c in zip(ends, counts.tolist())]
            vectors = [np.unique(h, return_counts=True) for h in shingled(hashes, counts, WIDTH)]
            sizes = np.array([len(v[0]) for v in vectors])
            some = np.flatnonzero(sizes)
            keys: list = [None] * len(vectors)
            packed: list = [None] * len(vectors)
            if len(some):
                h = np.concatenate([vectors[i][0] for i in some])
                tf = np.concatenate([vectors[i][1] for i in some])
                starts = np.cumsum(sizes[some]) - sizes[some]
                df = w.led(tf, w.counts(h, known, n), starts)
                picks = sampler.samples(h, w(tf, df), starts).reshape(len(some), bands, rows)
                band = (picks * band_mix).sum(2) + np.arange(bands)
                for k, i in enumerate(some):
                    keys[i] = band[k].tolist()
                    packed[i] = _packed(df[starts[k]:starts[k] + sizes[i]])
            out.append(pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                 pa.array(packed, pa.binary())], SIGNED.names))
        return pa.Table.from_batches(out, SIGNED)
    return sign


def _weighed_docs(weights):
    def weigh(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for batch in batches(source, 500, column=1, chars=BATCH_BYTES):
            vectors = [np.unique(h, return_counts=True) for h in shingled(*word_hashes(batch.column(1).to_pylist()), WIDTH)]
            sizes = np.fromiter((len(h) for h, _ in vectors), np.int64, len(vectors))
            h, tf = (np.concatenate([v[i] for v in vectors]) for i in (0, 1))
            each = w(tf, np.concatenate([_unpacked(df) for df in batch.column(2).to_pylist()]))
            ends = np.cumsum(sizes)
            sums = np.concatenate([[0.0], np.cumsum(each)])
            rows = pa.StructArray.from_arrays([_signed(h), pa.array(each)], ["h", "w"])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sums[ends] - sums[ends - sizes]),
                 pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), rows)], ["id", "total", "grams"])
    return weigh


def prefix_members(grams: DataFrame, threshold: float) -> DataFrame:
    """(id, total, grams of (h, w)) -> (key, id, total, rest): each text's prefix shingles and the weight that
    is left from there on, of shingles that another text has too, rare first."""
    rows = grams.select("id", F.explode("grams").alias("g")).select("id", "g.h", "g.w")
    counts = rows.groupBy("h").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    rarity = F.least(F.lit(31), F.floor(F.log2("df"))).cast("long")
    token = F.shiftleft(rarity, HASH_BITS).bitwiseOR(F.shiftrightunsigned("h", 64 - HASH_BITS))
    known = bounded(counts.select("h", token.alias("token")), "shingle-counts")
    tokens = rows.join(known, "h").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("token", "w"))).alias("tokens"))  # one text, no group

    def cut(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for i in range(batch.num_rows):
                total, row = batch.column(1)[i].as_py(), batch.column(2)[i].values
                rest = np.cumsum(row.field("w").to_numpy()[::-1])[::-1]
                n = int((rest >= threshold * total * (1 - SLACK)).sum())
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [row.field("token")[:n], pa.array([batch.column(0)[i].as_py()] * n, pa.binary()),
                         pa.array(np.full(n, total)), pa.array(rest[:n])], ["key", "id", "total", "rest"])

    joined = tokens.join(grams.select("id", "total"), "id").select("id", "total", "tokens")
    return joined.mapInArrow(cut, "key long, id binary, total double, rest double")


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS,
                    heavy_share: float = HEAVY, seed: int = 1) -> DataFrame:
    """Per row: doc_id, raw (digest of the text), class_id, class_size, keep (the one row kind of its class that stays)."""
    spark = docs.sparkSession
    text = F.coalesce("text", F.lit(""))
    inputs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("raw"), text.alias("text"))
    n_docs, chars = inputs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    weights = Weights(n_docs, frequent(inputs.select("text"), n_docs, heavy_share) if n_docs else {})
    shared = spark.sparkContext.broadcast(weights)
    spread = inputs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(-(-chars // BLOCK_CHARS) or 1)))
    counts = document_counts(spread, shared, -(-chars // BUCKET_CHARS) or 1)
    signed = materialise(spread.groupBy("block").cogroup(counts.groupBy("block")).applyInArrow(
        _signed_docs(shared, bands, rows, seed), "doc_id long, raw binary, digest binary, bands array<long>, df binary"), "signatures")
    texts = signed.where("digest is not null").groupBy("digest").agg(F.min(F.struct("raw", "bands")).alias("x"))
    members = materialise(shared_buckets(texts.select(F.explode("x.bands").alias("key"), F.col("digest").alias("id"))), "buckets")
    wanted = members.groupBy("id").agg(F.max("n").alias("n")).join(texts.select(F.col("digest").alias("id"), F.col("x.raw").alias("raw")), "id")
    wanted = bounded(wanted, "wanted")
    found = inputs.select("raw", "text").join(wanted, "raw").groupBy("id").agg(F.first("text").alias("text"), F.first("n").alias("n"))
    counted = signed.select("raw", "df").join(wanted, "raw").groupBy("id").agg(F.first("df").alias("df"))
    candidates = materialise(found.join(counted, "id"), "candidates")

    def score(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        known: dict = {}

        def weighed(key, text, df):
            if key not in known:
                if len(known) >= 500:
                    known.clear()
                h, tf = vector(text)
                known[key] = h, w(tf, _unpacked(df))
            return known[key]

        for batch in batches(source, 200, column=2):
            keep = [_jaccard(*weighed(a, x, m), *weighed(b, y, n)) >= threshold
                    for a, b, x, y, m, n in zip(*(batch.column(i).to_pylist() for i in range(6)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def verify(pairs: DataFrame) -> DataFrame:
        first = candidates.select(F.col("id").alias("a"), F.col("text").alias("text_a"), F.col("df").alias("df_a"))
        second = candidates.select(F.col("id").alias("b"), F.col("text").alias("text_b"), F.col("df").alias("df_b"))
        # few pairs meet the texts of many documents: the pairs go to the texts
        return second.join(first.join(hinted(pairs), "a"), "b").select("a", "b", "text_a", "text_b", "df_a", "df_b").mapInArrow(score, "a binary, b binary")

    small = members.where(F.col("n") <= FEW).groupBy("key").agg(F.sort_array(F.collect_list("id")).alias("ids"))  # up to FEW
    both = small.select(F.explode(F.array(F.struct(F.element_at("ids", 1).alias("a"), F.element_at("ids", 2).alias("b")),
                                          F.struct(F.element_at("ids", 1).alias("a"), F.element_at("ids", -1).alias("b")),
                                          F.struct(F.element_at("ids", -2).alias("a"), F.element_at("ids", -1).alias("b")))).alias("p"))
    links = materialise(verify(materialise(both.select("p.*").distinct(), "pairs")), "links")

    crowded = candidates.where(F.col("n") > FEW).select("id", "text", "df")
    grams = materialise(crowded.mapInArrow(_weighed_docs(shared), "id binary, total double, grams array<struct<h:long,w:double>>"), "grams")
    total, rest = F.col("total"), F.col("rest")
    overlap = (total + F.col("pivot_total")) * (threshold / (1 + threshold) * (1 - SLACK))
    may_link = F.least(rest, F.col("pivot_rest")) >= overlap
    links = link_filtered(materialise(prefix_members(grams, threshold), "prefixes"), ["total", "rest"], may_link, verify, links)
    comp = connected(links)
    roots = signed.join(hinted(comp.withColumnRenamed("id", "digest"), comp), "digest", "left").select(
        "doc_id", "raw", F.coalesce("comp", "digest").alias("root"))
    roots = materialise(roots, "roots")
    named = roots.where("root is not null").groupBy("root").agg(
        F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"),
        F.min(F.struct(F.col("doc_id").isNull().alias("no"), "doc_id", "raw")).alias("first"))
    out = roots.join(materialise(named, "classes"), "root", "left")
    alone = F.col("root").isNull()
    stays = F.col("first.doc_id").eqNullSafe(F.col("doc_id")) & (F.col("first.raw") == F.col("raw"))
    return out.select("doc_id", "raw", F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                      F.when(alone, F.lit(1)).otherwise(F.col("class_size")).cast("long").alias("class_size"),
                      (alone | stays).alias("keep"))


def op10_icws_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    return near_duplicates(docs).select("doc_id", "class_id", "class_size")
