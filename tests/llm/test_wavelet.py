import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from kestrel.llm.wavelet import WaveletShard, op1_wavelet_shards, read_documents, write_shards

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, start long, file string"
TEXTS = ["", None, " ", "The cat's, hat...  it's. don't,\n\nOK 3.14,15. x", "Ünïcode é́. ÀΣΣ, 漢字。 naïve", "a" * 50_000,
         "word " * 30_000, "<|endoftext|>. <|startoftext|>", "tab\there\x1cand\x0bthere.\r\n", "'s 'S. ,. .,", "é. ́, x.̸",
         "A.̸ B,̧ c'd.", "q\"uote\"! \"1\"", "<|ENDOFTEXT|> <|EndOfText|>", "a <|endoftext|>\n<|StartOfText|> B.",
         "</w> x</w> <|endoftext", "wörd word " * 3000, "\u212aelvin İstanbul ſ"]


@pytest.mark.parametrize("n,top", [(1, 1), (5000, 49408), (1025, 3), (512, 70000), (0, 1)])
def test_shard_answers_like_a_list(n, top):
    ids = np.random.default_rng(n).integers(0, top, n).astype(np.uint32)
    if top > 10:
        ids[::7] = 9
    shard = WaveletShard.parse(WaveletShard.build(ids, [4, None], np.array([n, 0])))
    assert shard.decode().tolist() == ids.tolist() and shard.doc_ids == [4, None]
    for i in range(0, n, 97):
        assert shard.access(i) == ids[i]
        assert shard.rank(int(ids[i]), i) == int((ids[:i] == ids[i]).sum())
    for token in {0, 9, 2, top + 5}:
        where = np.flatnonzero(ids == token)
        assert shard.count(token) == len(where)
        assert [shard.select(token, k) for k in range(min(20, len(where)))] == where[:20].tolist()


def expected(rows):
    tok, out, start = Tokenizer.from_file(PATH), [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = np.array(tok.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_texts_come_back_from_small_files(spark, tmp_path):
    rows = [(i * 3 - 5, t) for i, t in enumerate(TEXTS)] + [(None, "no id")]
    df = spark.createDataFrame([(*r, 7, "clash") for r in rows], SCHEMA)
    write_shards(df, str(tmp_path / "out"), PATH, 1, shard_tokens=40)
    got = read_documents(spark, str(tmp_path / "out"))
    assert sorted((tuple(r)[:4] for r in got.collect()), key=lambda r: r[1]) == expected(rows)
    assert got.select("file").distinct().count() > 1


def test_repeated_ids_and_empty_table(spark, tmp_path):
    rows = [(1, "same text"), (1, "same text"), (1, "other")]
    df = spark.createDataFrame([(*r, 0, "") for r in rows], SCHEMA)
    write_shards(df, str(tmp_path / "a"), PATH, 1)
    assert sorted(r.n_tokens for r in read_documents(spark, str(tmp_path / "a")).collect()) == [2, 3, 3]
    write_shards(df.limit(0), str(tmp_path / "b"), PATH, 1)
    assert read_documents(spark, str(tmp_path / "b")).count() == 0


def test_query_equals_the_plain_tokenizer(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted((tuple(r)[:4] for r in op1_wavelet_shards(spark, sf).collect()), key=lambda r: r[1]) == expected(docs)
