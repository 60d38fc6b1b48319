"""Operator 3 - benchmark decontamination by a BM25 index and block-max WAND.

The test items are the indexed side.  An item's term weights are BM25 impacts divided by
the item's own score, so a passage that holds all its words scores 1 and one
threshold serves every item.  Postings are in item order, cut into blocks with
the greatest impact of each.  Training texts are queried passage by passage:
windows of twice the longest item's words, half a window apart, so that each item
fits whole into some window.  A passage in which no block's greatest impacts add up to the
threshold needs no search (block-max bounds, computed for a batch of windows at once); the
others run block-max WAND.  Every item above the threshold is then verified by
the shares of its question's and its answer's word n-grams that the passage holds.
With ``edits``, so many words of a side may be other ones whatever its length (a
replaced word takes ``NGRAM`` n-grams with it): the question, an answer that is marked as
one, and the item as a whole each need their share, or all but the n-grams of that
many words.  A last sentence or quarter that only stands for an answer is not asked for
by itself, and a side too short to lose so many is judged by the whole.

The index is cut into parts of at most ``PART_POSTINGS`` postings of items of like
length; each part is collected and broadcast, whatever the number of items, and all
texts are searched part by part.

Defined results
    null or empty text on either side: matches nothing; items with equal texts: each
    is reported; null ``doc_id`` or ``item_id``: reported as null; equal rows: one result row
    each; an empty table gives no row; very long texts: all windows; items too short to lose a
    word's n-grams: by the shares alone; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import batches, materialise
from kestrel.llm.sharding import running_sums
from kestrel.llm.words import word_hashes, words_of

K1, B = 1.2, 0.75
#: Least normalised score; least share of the question's and of the answer's n-grams.
SCORE, QUESTION, ANSWER, NGRAM = 0.6, 0.7, 0.7, 3
#: Words of an item that the queries and the pipeline let be other ones.
EDITS = 1
BLOCK = 4
PART_POSTINGS = 1_000_000
HITS = "doc_id long, raw binary, item_id long, score double, question_share double, answer_share double"


def split_item(text: str) -> tuple[list[bytes], list[bytes]]:
    """(question, answer): an explicit answer mark, else the last question mark, else the
    last sentence; a single sentence's answer is its last quarter of words."""
    m = _marks(text) or list(re.finditer(r"[.!]\s", text))
    if m:
        question, answer = words_of(text[:m[-1].start()]), words_of(text[m[-1].end():])
        if question and answer:
            return question, answer
    words = words_of(text)
    cut = len(words) - max(1, len(words) // 4)
    return words[:cut], words[cut:]


def _marks(text: str) -> list[re.Match]:
    """The marks after which an answer stands: answer marks, else question marks."""
    return list(re.finditer(r"(?i)\banswer\s*:", text)) or list(re.finditer(r"\?\s", text))


def has_answer(text: str) -> bool:
    """Whether what ``split_item`` calls the answer is marked as one."""
    m = _marks(text)
    return bool(m and words_of(text[:m[-1].start()]) and words_of(text[m[-1].end():]))


def _ngrams(words: list, n: int) -> set:
    n = min(n, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set()


class Part:
    """Postings of some items: terms numbered, items in order, blocks with their greatest impacts."""

    def __init__(self, rows: pd.DataFrame, items: pd.DataFrame):
        items = items.sort_values("item")
        number = {k: i for i, k in enumerate(items["item"])}
        self.item_ids = items["item_id"].tolist()
        self.item_ids = [None if pd.isna(x) else int(x) for x in self.item_ids]
        self.texts = items["text"].tolist()
        self.span = int(items["length"].max())
        self.vocab: dict[bytes, int] = {}
        terms = [self.vocab.setdefault(bytes(t), len(self.vocab)) for t in rows["term"]]
        hashes = word_hashes([t.decode() for t in self.vocab])[0]
        self.by_hash = np.argsort(hashes)
        self.hashes = hashes[self.by_hash]
        docs = rows["item"].map(number).to_numpy()
        order = np.lexsort((docs, terms))
        terms, docs, impacts = np.array(terms)[order], docs[order], rows["impact"].to_numpy()[order]
        starts = np.searchsorted(terms, np.arange(len(self.vocab) + 1))
        self.docs = [docs[a:b].tolist() for a, b in zip(starts, starts[1:])]
        self.impacts = [impacts[a:b].tolist() for a, b in zip(starts, starts[1:])]
        self.most = np.array([max(x) for x in self.impacts])
        self.block_last = [[d[min(i + BLOCK, len(d)) - 1] for i in range(0, len(d), BLOCK)] for d in self.docs]
        self.block_most = [[max(x[i:i + BLOCK]) for i in range(0, len(x), BLOCK)] for x in self.impacts]
        # the same blocks by their place in item order, for many queries at once
        self.blocks = -(-len(self.item_ids) // BLOCK)
        key = np.unique(terms.astype(np.int64) * self.blocks + docs // BLOCK, return_index=True)
        self.place_most = np.maximum.reduceat(impacts, key[1])
        self.place = key[0] % self.blocks
        self.place_start = np.searchsorted(key[0] // self.blocks, np.arange(len(self.vocab) + 1))
        self._sides: dict[int, tuple[set, set, set, bool]] = {}

    def sides(self, item: int) -> tuple[set, set, set, bool]:
        """N-grams of the question, the answer and the whole item, and whether the answer is marked as one."""
        if item not in self._sides:
            text = self.texts[item]
            q, a = split_item(text)
            self._sides[item] = (*(_ngrams(word_hashes([b" ".join(x).decode()])[0].tolist(), NGRAM) for x in (q, a, words_of(text))),
                                 has_answer(text))
        return self._sides[item]

    def terms_of(self, hashes: np.ndarray) -> np.ndarray:
        """Term numbers of words by their hashes; -1: not indexed."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.by_hash[at], -1)

    def reach(self, terms: np.ndarray, starts: np.ndarray, threshold: float) -> np.ndarray:
        """Which queries (segments of distinct ``terms``) have a block of items whose greatest
        impacts add up to the threshold."""
        out = np.zeros(len(starts), bool)
        n = (self.place_start[1:] - self.place_start[:-1])[terms]
        query = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(terms))))
        step = max(1, 4_000_000 // self.blocks)
        for a in range(0, len(starts), step):
            b = min(len(starts), a + step)
            lo, hi = starts[a], starts[b] if b < len(starts) else len(terms)
            m = n[lo:hi]
            at = np.repeat(self.place_start[terms[lo:hi]] - (np.cumsum(m) - m), m) + np.arange(m.sum())
            bound = np.bincount(np.repeat(query[lo:hi] - a, m) * self.blocks + self.place[at], self.place_most[at], (b - a) * self.blocks)
            out[a:b] = bound.reshape(b - a, self.blocks).max(1) >= threshold - 1e-9
        return out

    def search(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """Block-max WAND: all (item, score) with score >= threshold for distinct ``terms``."""
        end = len(self.item_ids)
        at = {t: 0 for t in terms}
        live = sorted((self.docs[t][0], t) for t in terms)
        found, slack = [], threshold - 1e-9
        while live:
            total, pivot = 0.0, None
            for i, (_, t) in enumerate(live):
                total += self.most[t]
                if total >= slack:
                    pivot = i
                    break
            if pivot is None:
                return found
            item = live[pivot][0]
            while pivot + 1 < len(live) and live[pivot + 1][0] == item:
                pivot += 1
            bound, skip = 0.0, end
            for _, t in live[:pivot + 1]:
                blocks = self.block_last[t]
                b = at[t] // BLOCK
                while b < len(blocks) and blocks[b] < item:
                    b += 1
                if b < len(blocks):
                    bound += self.block_most[t][b]
                    skip = min(skip, blocks[b] + 1)
            if bound >= slack:
                if live[0][0] == item:
                    score = sum(self.impacts[t][at[t]] for d, t in live[:pivot + 1])
                    if score >= slack:
                        found.append((item, score))
                    goal = item + 1
                else:
                    goal = item
                moved = [t for d, t in live[:pivot + 1] if d < goal]
            else:
                # no item before the nearest block end, or before the next list begins, can reach the threshold
                goal = max(item + 1, min(skip, live[pivot + 1][0] if pivot + 1 < len(live) else end))
                moved = [t for _, t in live[:pivot + 1]]
            for t in moved:
                docs, p = self.docs[t], at[t]
                while p < len(docs) and docs[p] < goal:
                    p += 1
                at[t] = p
            live = sorted((self.docs[t][at[t]], t) for _, t in live if at[t] < len(self.docs[t]))
        return found


def windows_to_search(terms: np.ndarray, docs: np.ndarray, places: np.ndarray, part: Part, threshold: float):
    """(text, window, distinct terms) of the windows that may hold an item: those in which the greatest
    impacts of some block of items, summed over the window's terms, reach the threshold.

    ``terms`` are the indexed words of a batch, in order, ``docs`` their texts and ``places`` their
    word numbers in these; window k of a text holds the words from k * span up to (k + 2) * span.
    """
    n, size = len(terms), len(part.vocab)
    if not n:
        return
    first = places // part.span
    width = int(first.max()) + 2
    entry = np.concatenate([np.arange(n), np.flatnonzero(first > 0)])
    window = np.concatenate([first, first[first > 0] - 1]) + docs[entry].astype(np.int64) * width
    distinct = np.unique(window * size + terms[entry])
    window, t = distinct // size, distinct % size
    ids, starts = np.unique(window, return_index=True)
    ends = np.append(starts[1:], len(t))
    for k in np.flatnonzero(part.reach(t, starts, threshold)):
        yield int(ids[k]) // width, int(ids[k]) % width, t[starts[k]:ends[k]].tolist()


def _search_texts(shared, score: float, question: float, answer: float, edits: int):
    def search(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part: Part = shared.value
        stride = part.span
        for batch in batches(source, 1000, chars=4 << 20):
            hashes, sizes = word_hashes([t or "" for t in batch.column(1).to_pylist()])
            terms = part.terms_of(hashes)
            starts = np.cumsum(sizes) - sizes
            docs = np.repeat(np.arange(len(sizes)), sizes)
            places = np.arange(len(terms)) - np.repeat(starts, sizes)
            known = terms >= 0
            best: dict[tuple[int, int], tuple] = {}
            for doc, window, query in windows_to_search(terms[known], docs[known], places[known], part, score):
                hits = part.search(query, score)
                if not hits:
                    continue
                first, last = starts[doc] + window * stride, starts[doc] + min(sizes[doc], (window + 2) * stride)
                held = _ngrams_by_size(hashes[first:last].tolist())
                for item, s in hits:
                    *sides, marked = part.sides(item)
                    q, a, whole = (_share(side, held) for side in sides)
                    lost = edits * NGRAM
                    if lost and len(sides[2]) > lost:
                        need = [_needed(side, share, lost) for side, share in zip(sides, (question, answer, question))]
                        verified = q >= need[0] and (a >= need[1] or not marked) and whole >= need[2]
                    else:
                        verified = q >= question and a >= answer
                    if verified:
                        best[doc, item] = max(best.get((doc, item), (0.0,)), (s, q, a))
            ids = batch.column(0).to_pylist()
            raw = batch.column(2).to_pylist()
            rows = [(ids[d], raw[d], part.item_ids[i], *v) for (d, i), v in best.items()]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.binary(), pa.int64()] + [pa.float64()] * 3)],
                    ["doc_id", "raw", "item_id", "score", "question_share", "answer_share"])
    return search


def _ngrams_by_size(words: list) -> dict[int, set]:
    return {n: _ngrams(words, n) for n in range(1, NGRAM + 1)}


def _share(side: set, held: dict[int, set]) -> float:
    if not side:
        return 1.0
    return len(side & held[len(next(iter(side)))]) / len(side)


def _needed(side: set, share: float, lost: int) -> float:
    """Share of a side's n-grams that must be held if ``lost`` of them may be missing."""
    return min(share, 1.0 - lost / len(side)) - 1e-9 if side else 0.0


def _terms(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches(source, 500, column=1):
        rows = []
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = words_of(text or "")
            tf: dict[bytes, int] = {}
            for w in words:
                tf[w] = tf.get(w, 0) + 1
            rows += [(item, len(words), w, n) for w, n in tf.items()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                pa.int64(), pa.int64(), pa.binary(), pa.int64()))], ["item", "length", "term", "tf"])


def index_items(items: DataFrame, part_postings: int = PART_POSTINGS) -> tuple[DataFrame, DataFrame]:
    """Written (part, item, item_id, text, length) and postings (part, item, term, impact of the item's own score)."""
    named = materialise(items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"),
                                     "text"), "items")
    terms = materialise(named.select("item", "text").mapInArrow(_terms, "item long, length long, term binary, tf long"), "item-terms")
    lengths = terms.groupBy("item").agg(F.max("length").alias("length"), F.count(F.lit(1)).alias("postings"))
    n, mean = lengths.agg(F.count(F.lit(1)), F.avg("length")).first()
    parts = materialise(running_sums(lengths, "postings", [F.col("length"), F.col("item")]).select(
        "item", "length", F.floor((F.col("end") - 1) / part_postings).alias("part")), "item-parts")
    df = terms.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    idf = F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    raw = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.lit(mean or 1.0)))
    weighed = materialise(terms.join(df, "term").select("item", "term", raw.alias("raw")), "item-weights")
    own = weighed.groupBy("item").agg(F.sum("raw").alias("own"))
    postings = weighed.join(own, "item").join(parts.select("item", "part"), "item") \
        .select("part", "item", "term", (F.col("raw") / F.col("own")).alias("impact"))
    return materialise(named.join(parts, "item"), "item-texts"), materialise(postings, "item-index")


def contaminated(docs: DataFrame, items: DataFrame, score: float = SCORE, question: float = QUESTION, answer: float = ANSWER,
                 part_postings: int = PART_POSTINGS, edits: int = 0) -> DataFrame:
    """(doc_id, raw, item_id, score, question_share, answer_share): one row per leaked item in a
    document; ``raw`` is the MD5 of its text."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.unhex(F.md5("text")).alias("raw")) \
        .where("text is not null")
    entries, postings = index_items(items, part_postings)
    out = spark.createDataFrame([], HITS)
    for r in entries.select("part").distinct().orderBy("part").toLocalIterator():
        # a part's postings: at most PART_POSTINGS and one item's own
        here = F.col("part") == r.part
        shared = spark.sparkContext.broadcast(Part(postings.where(here).toPandas(), entries.where(here).toPandas()))
        out = out.unionByName(texts.mapInArrow(_search_texts(shared, score, question, answer, edits), HITS))
    return out


def op3_block_max_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = sf_dir.rstrip("/")
    docs, items = spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/benchmark.parquet")
    return contaminated(docs, items, edits=EDITS).drop("raw")
