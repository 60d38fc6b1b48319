"""Operator 1 - token ids as one wavelet matrix per shard file.

``write_shards`` tokenises every document, orders documents by ``doc_id``
and writes binary shard files; ``read_documents`` and ``WaveletShard`` read
them back.  A shard answers ``access``, ``rank``, ``count`` and ``select``
(occurrence lookup) from its bit-planes without decoding the sequence.

File layout (little endian)::

    b"KWM1" | u64 tokens | u64 docs | u8 levels | u32 doc-table bytes
    doc table, zlib: i64 doc_id[docs], u8 null[docs], i64 n_tokens[docs]
    per level, most significant bit first:
        u64 zeros | ceil(tokens/8) bytes of bits | u32 ones before each 512-bit block

Defined results
    null text: encoded as the empty text, so just the end id; null ``doc_id``:
    ordered before all others and returned as null; equal ``doc_id``: each row
    is kept, ordered among themselves by a hash of the text; an empty table gives no file
    and no row; other columns of the input are not read.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.llm.common import batches, doc_texts
from kestrel.session import scratch_path

MAGIC = b"KWM1"
HEAD = struct.Struct("<4sQQBI")
BLOCK_BITS = 512
#: Tokens after which a task closes its file and opens the next one: bounds memory, not the data.
SHARD_TOKENS = 2_000_000
#: Entries of the word -> ids memo of one Python worker.
MEMO_WORDS = 700_000


class WordMemo(dict):
    """word -> index into a flat table of token ids, filled by the tokenizers library.

    The tokenizer drops white space and never merges across it, so a text's
    ids are those of its pieces between spaces, in order.  A piece's ASCII
    letters may be lowered (the tokenizer lowers all) and one final '.' or
    ',' after a letter or digit may be cut off (the tokenizer cuts there).
    """

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer = tokenizer
        self.special = [t.content.lower() for t in tokenizer.get_added_tokens_decoder().values()]
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        #: Bytes of a word that a token stands for, if it is written so (``_cuts`` notices where words are changed before).
        self.sizes = np.zeros(max(vocabulary.values(), default=0) + 1, np.int64)
        for token, i in vocabulary.items():
            self.sizes[i] = len(token.removesuffix("</w>"))
        self.reset()

    def reset(self):
        self.clear()
        self.new: list[str] = []
        self.flat = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.lens = np.zeros(1 << 14, np.int32)
        self.n_words = self.n_flat = 0

    def __missing__(self, word):
        at = self.n_words + len(self.new)
        self.new.append(word)
        self[word] = at
        return at

    def _add(self, flat: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> None:
        """The next words: their ids are at ``starts`` of ``flat``, which is appended to the table."""
        n = len(lens)
        self.flat = _room(self.flat, self.n_flat + len(flat))
        self.starts, self.lens = _room(self.starts, self.n_words + n), _room(self.lens, self.n_words + n)
        self.flat[self.n_flat:self.n_flat + len(flat)] = flat
        self.lens[self.n_words:self.n_words + n] = lens
        self.starts[self.n_words:self.n_words + n] = self.n_flat + starts
        self.n_words += n
        self.n_flat += len(flat)

    def learn(self):
        """Encode the words met since the last call, many in one text."""
        words, self.new = self.new, []
        parted = list(map(_stem, words))
        number: dict[str, int] = {}
        stem = np.fromiter((number.setdefault(s, len(number)) for s, _ in parted), np.int64, len(words))
        stems = list(number)
        starts, lens = np.zeros(len(stems), np.int64), np.zeros(len(stems), np.int64)
        flats, at = [], 0
        plain = np.fromiter(map(str.isascii, stems), bool, len(stems))
        chars = np.fromiter(map(len, stems), np.int64, len(stems))
        for group in (np.flatnonzero((chars > 0) & plain), np.flatnonzero((chars > 0) & ~plain)):
            for begin in range(0, len(group), 2000):
                which = group[begin:begin + 2000]
                ids, cuts = self._encoded([stems[i] for i in which.tolist()], chars[which] if plain[which[0]] else None)
                starts[which], lens[which] = at + cuts[:-1], np.diff(cuts)
                flats.append(ids)
                at += len(ids)
        flat = np.concatenate([*flats, np.zeros(0, np.uint32)])
        first, size = starts[stem], lens[stem]
        marks = np.frombuffer("".join([m or " " for _, m in parted]).encode(), np.uint8)
        for mark in (".", ","):  # the ids of the stem and of the mark, one after the other
            own = np.flatnonzero(marks == ord(mark))
            if len(own):
                end = np.array(self.tokenizer.encode(mark, add_special_tokens=False).ids, np.uint32)
                n = size[own]
                begins = np.cumsum(n + len(end)) - (n + len(end))
                out = np.empty(int(n.sum()) + len(own) * len(end), np.uint32)
                inside = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                out[np.repeat(begins, n) + inside] = flat[np.repeat(first[own], n) + inside]
                out[(begins + n)[:, None] + np.arange(len(end))] = end
                first[own], size[own] = len(flat) + begins, n + len(end)
                flat = np.concatenate([flat, out])
        self._add(flat, first, size)

    def _encoded(self, words: list[str], sizes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, and where those of each begin and end; ``sizes``: their bytes, if known."""
        text = " ".join(words)
        ids = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        cuts = self._cuts(ids, words, sizes)
        if cuts is not None:
            return np.array(ids, np.uint32), cuts
        enc = self.tokenizer.encode(text, add_special_tokens=False)
        begins = [o[0] for o in enc.offsets]
        return np.array(enc.ids, np.uint32), np.searchsorted(begins, np.cumsum([0] + [len(s) + 1 for s in words]))

    def _cuts(self, ids: list[int], words: list[str], sizes: np.ndarray | None = None) -> np.ndarray | None:
        """Where the words' ids begin, from the lengths of the tokens; None if these do not add up to the words."""
        ends = np.cumsum(self.sizes[ids])
        if sizes is None:
            sizes = np.fromiter((len(w) if w.isascii() else len(w.encode()) for w in words), np.int64, len(words))
        want = np.cumsum(sizes)
        cuts = np.searchsorted(ends, want) + 1
        if ends[-1] != want[-1] or not np.array_equal(ends[cuts - 1], want):
            return None
        return np.concatenate([[0], cuts])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and the number of each text.

        A special token counts only as it is written: texts that hold one in any case are encoded as they are."""
        low = [_lowered(t) for t in texts]
        raw = [i for i, t in enumerate(low) if any(s in t for s in self.special)]
        if not raw:
            return self._encode(low)
        whole = {i: self.tokenizer.encode(texts[i], add_special_tokens=False).ids for i in raw}
        ids, n = self._encode(["" if i in whole else t for i, t in enumerate(low)])
        pieces = np.split(ids, np.cumsum(n)[:-1])
        for i, own in whole.items():
            pieces[i], n[i] = np.array(own, np.uint32), len(own)
        return np.concatenate(pieces), n

    def _encode(self, low: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.n_words > MEMO_WORDS:
            self.reset()
        # the words of all texts are numbered by Arrow, so that each distinct one is looked up once
        split = pc.split_pattern(pa.array(low, pa.large_string()), " ")
        n = np.diff(split.offsets.to_numpy()).astype(np.int64)
        coded = split.flatten().dictionary_encode()
        # one text of all of them, as they hold no space: far faster than a Python object from each
        distinct = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary), pa.scalar(" ", pa.large_string()))[0].as_py()
        own = np.fromiter(map(self.__getitem__, distinct.split(" ")), np.int64) if len(coded.dictionary) else np.zeros(0, np.int64)
        words = own[coded.indices.to_numpy()]
        if self.new:
            self.learn()
        lens = self.lens[words]
        ends = np.cumsum(lens, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.starts[words] - (ends - lens), lens) + np.arange(total)]
        last = np.concatenate([[0], ends])[np.cumsum(n)]
        return ids, np.diff(last, prepend=0)


def _room(a: np.ndarray, n: int) -> np.ndarray:
    return a if n <= len(a) else np.concatenate([a, np.zeros(max(n - len(a), len(a)), a.dtype)])


def _lowered(text: str) -> str:
    return text.encode("utf-8", "replace").lower().replace(b"\n", b" ").decode("utf-8")


def _stem(word: str) -> tuple[str, str]:
    if len(word) > 1 and word[-1] in ".," and word[-2].isascii() and word[-2].isalnum():
        return word[:-1], word[-1]
    return word, ""


class WaveletShard:
    """A shard file in memory: rank/select over packed bit-planes."""

    def __init__(self, n, zeros, bits, ranks, doc_ids, n_tokens):
        self.n, self.zeros, self.bits, self.ranks = n, zeros, bits, ranks
        self.doc_ids, self.n_tokens = doc_ids, n_tokens

    @staticmethod
    def build(ids: np.ndarray, doc_ids: list, n_tokens: np.ndarray) -> bytes:
        levels = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        seq = ids.astype(np.uint16 if levels <= 16 else np.uint32)
        table = zlib.compress(
            np.array([d or 0 for d in doc_ids], "<i8").tobytes()
            + np.array([d is None for d in doc_ids], "u1").tobytes() + n_tokens.astype("<i8").tobytes(), 1)
        out = [HEAD.pack(MAGIC, len(ids), len(doc_ids), levels, len(table)), table]
        for level in range(levels - 1, -1, -1):
            one = (seq >> level & 1).astype(bool)
            packed = np.packbits(one, bitorder="little")
            rest, ones = seq[~one], seq[one]
            out += [struct.pack("<Q", len(rest)), packed.tobytes(), _rank_samples(packed).tobytes()]
            seq = np.concatenate([rest, ones])
        return b"".join(out)

    @classmethod
    def parse(cls, data: bytes) -> "WaveletShard":
        magic, n, docs, levels, size = HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a wavelet shard")
        at = HEAD.size
        table = zlib.decompress(data[at:at + size])
        ids = np.frombuffer(table, "<i8", docs).tolist()
        nulls = np.frombuffer(table, "u1", docs, 8 * docs)
        n_tokens = np.frombuffer(table, "<i8", docs, 9 * docs)
        at += size
        zeros, bits, ranks, width = [], [], [], (n + 7) // 8
        for _ in range(levels):
            zeros.append(struct.unpack_from("<Q", data, at)[0])
            bits.append(np.frombuffer(data, "u1", width, at + 8))
            blocks = -(-width * 8 // BLOCK_BITS)
            ranks.append(np.frombuffer(data, "<u4", blocks, at + 8 + width))
            at += 8 + width + 4 * blocks
        return cls(n, zeros, bits, ranks, [None if z else d for d, z in zip(ids, nulls)], n_tokens)

    def _rank1(self, level: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        if i <= 0:
            return 0
        block = (i - 1) // BLOCK_BITS
        part = self.bits[level][block * BLOCK_BITS // 8:(i + 7) // 8]
        bits = np.unpackbits(part, bitorder="little", count=i - block * BLOCK_BITS)
        return int(self.ranks[level][block]) + int(bits.sum())

    def _bit(self, level: int, i: int) -> int:
        return int(self.bits[level][i >> 3]) >> (i & 7) & 1

    def access(self, i: int) -> int:
        """The token at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        token = 0
        for level, z in enumerate(self.zeros):
            bit = self._bit(level, i)
            ones = self._rank1(level, i)
            i, token = (z + ones, token << 1 | 1) if bit else (i - ones, token << 1)
        return token

    def _range(self, token: int, i: int, j: int) -> tuple[int, int]:
        levels = len(self.zeros)
        if token >> levels:
            return 0, 0
        for level, z in enumerate(self.zeros):
            a, b = self._rank1(level, i), self._rank1(level, j)
            i, j = (z + a, z + b) if token >> (levels - 1 - level) & 1 else (i - a, j - b)
        return i, j

    def rank(self, token: int, i: int) -> int:
        """Occurrences of ``token`` before position ``i``."""
        a, b = self._range(token, 0, min(i, self.n))
        return b - a

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence of ``token``."""
        a, b = self._range(token, 0, self.n)
        if not 0 <= k < b - a:
            raise IndexError(k)
        i = a + k
        for level in range(len(self.zeros) - 1, -1, -1):
            bit = token >> (len(self.zeros) - 1 - level) & 1
            i = self._select(level, bit, i - (self.zeros[level] if bit else 0))
        return i

    def _select(self, level: int, bit: int, k: int) -> int:
        ranks = self.ranks[level].astype(np.int64)
        before = ranks if bit else np.arange(len(ranks)) * BLOCK_BITS - ranks
        block = int(np.searchsorted(before, k, "right")) - 1
        part = np.unpackbits(self.bits[level][block * BLOCK_BITS // 8:(block + 1) * BLOCK_BITS // 8], bitorder="little")
        return block * BLOCK_BITS + int(np.flatnonzero(part == bit)[k - int(before[block])])

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def decode(self) -> np.ndarray:
        """The whole sequence, undoing the levels from the last to the first."""
        levels = len(self.zeros)
        seq = np.zeros(self.n, np.uint16 if levels <= 16 else np.uint32)
        for level in range(levels - 1, -1, -1):
            one = np.unpackbits(self.bits[level], bitorder="little", count=self.n).astype(bool)
            up = np.empty_like(seq)
            z = self.zeros[level]
            up[~one] = seq[:z]
            up[one] = seq[z:] | seq.dtype.type(1 << (levels - 1 - level))
            seq = up
        return seq.astype("<u4")


def _rank_samples(packed: np.ndarray) -> np.ndarray:
    width = BLOCK_BITS // 8
    full = np.zeros(-(-len(packed) // width) * width, np.uint8)
    full[:len(packed)] = packed
    ones = np.bitwise_count(full).reshape(-1, width).sum(1, dtype=np.int64)
    return (np.cumsum(ones) - ones).astype("<u4")


def filesystem(uri: str):
    """(pyarrow file system, path) of a folder named as Spark names it."""
    from pyarrow import fs

    uri = uri.replace("s3a://", "s3://", 1)
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


_MEMO: dict[str, WordMemo] = {}


def _memo(path: str) -> WordMemo:
    if path not in _MEMO:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        _MEMO[path] = WordMemo(Tokenizer.from_file(path))
    return _MEMO[path]


def write_shards(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int,
                 shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Write the shard files; returns their manifest (shard order, file, n_docs, n_tokens).

    Each task streams one range of ``doc_id`` and closes a file every
    ``shard_tokens`` tokens, so a task holds one shard whatever the range's
    size.  A file gets a new name per attempt and counts only if the
    written manifest names it: a repeated task leaves no mixed result.
    """
    rows = doc_texts(docs).withColumn("_h", F.xxhash64("text"))
    ranged = rows.repartitionByRange(F.col("doc_id").asc_nulls_first(), "_h") \
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "_h")
    schema = "part int, seq int, file string, n_docs long, n_tokens long"

    def write(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        memo, part, made = _memo(tokenizer_path), TaskContext.get().partitionId(), []
        store, root = filesystem(folder)
        store.create_dir(root, recursive=True)
        ids, doc_ids, counts, held = [], [], [], 0

        def close():
            name = f"{part:06d}-{len(made):06d}-{uuid.uuid4().hex}.kwm"
            with store.open_output_stream(f"{root}/{name}") as f:
                f.write(WaveletShard.build(np.concatenate(ids), doc_ids, np.array(counts, np.int64)))
            made.append((part, len(made), f"{folder}/{name}", len(doc_ids), int(sum(counts))))

        for batch in batches(source, 1000):
            flat, n = memo.encode(batch.column(1).to_pylist())
            ends = np.cumsum(n)
            for doc_id, a, b in zip(batch.column(0).to_pylist(), ends - n, ends):
                ids += [flat[a:b], np.array([end_id], np.uint32)]
                doc_ids.append(doc_id)
                counts.append(int(b - a) + 1)
                held += counts[-1]
                if held >= shard_tokens:
                    close()
                    ids, doc_ids, counts, held = [], [], [], 0
        if doc_ids:
            close()
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), (
                pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()))], schema.replace(",", "").split()[::2])

    manifest = f"{folder}/manifest"
    ranged.select("doc_id", "text").mapInArrow(write, schema).write.parquet(manifest)
    return docs.sparkSession.read.parquet(manifest)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Per document, from the shard files: doc_id, start, n_tokens, ids_crc32, file, doc_no.

    ``start`` numbers the ids of all documents in order; its base per file is
    a running sum over the manifest (one row per file).
    """
    files = spark.read.parquet(f"{folder}/manifest")
    based = files.withColumn("base", F.sum("n_tokens").over(Window.orderBy("part", "seq")) - F.col("n_tokens"))
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long, file string, doc_no int"

    def read(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for name, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, path = filesystem(name)
                with store.open_input_stream(path) as f:
                    shard = WaveletShard.parse(f.read())
                ids = memoryview(shard.decode().tobytes())
                ends = np.cumsum(shard.n_tokens)
                crcs = [zlib.crc32(ids[4 * a:4 * b]) for a, b in zip((ends - shard.n_tokens).tolist(), ends.tolist())]
                k = len(crcs)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard.doc_ids, pa.int64()), pa.array(base + ends - shard.n_tokens, pa.int64()),
                     pa.array(shard.n_tokens, pa.int64()), pa.array(crcs, pa.int64()),
                     pa.array([os.path.basename(path)] * k), pa.array(range(k), pa.int32())],
                    ["doc_id", "start", "n_tokens", "ids_crc32", "file", "doc_no"])

    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return based.select("file", "base").repartition(n, "file").mapInArrow(read, schema)


def op1_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    folder = scratch_path(spark, "wavelet")
    write_shards(docs, folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_documents(spark, folder)
