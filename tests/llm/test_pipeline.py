import math
from collections import Counter

import corpus_pipeline
from kestrel.llm.mixing import mix
from kestrel.llm.quality import judge
from test_decontam import brute
from test_minhash import classes
from test_mixing import WORD, targets
from test_quality import counts, failed
from test_sharding import check

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def test_stages_equal_brute_force_on_what_they_are_given(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, given = docs.columns, rows_of(docs)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_dedup", "decontaminate", "mix", "shards"]

    kept = corpus_pipeline.materialise(stages["quality"](spark, docs, SF), "t1")
    verdict = {r.doc_id: r.kept for r in judge(docs).collect()}
    now = rows_of(kept)
    assert kept.columns == columns and sorted(now) == sorted(r for r in given if verdict[r[0]])
    assert not any(failed(counts(r[1])) for r in now)

    single = corpus_pipeline.materialise(stages["near_dedup"](spark, kept, SF), "t2")
    want = {min(now[i][0] for i in c) for c in classes([r[:2] for r in now])}
    now = [r for r in now if r[0] in want]
    assert single.columns == columns and sorted(rows_of(single)) == sorted(now)

    clean = corpus_pipeline.materialise(stages["decontaminate"](spark, single, SF), "t3")
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    leaked = {d for d, _ in brute([r[:2] for r in now], items)}
    now = [r for r in now if r[0] not in leaked]
    assert clean.columns == columns and sorted(rows_of(clean)) == sorted(now)

    mixed = corpus_pipeline.materialise(stages["mix"](spark, clean, SF), "t4")
    copies = {r.doc_id: r.copies for r in mix(clean).collect()}
    got = Counter(rows_of(mixed))
    assert mixed.columns == columns and got == Counter({r: copies[r[0]] for r in now if copies[r[0]]})
    sizes = Counter()
    for r in now:
        sizes[r[3]] += len(WORD.findall(r[1]))
    taken = Counter()
    for r, n in got.items():
        taken[r[3]] += n * len(WORD.findall(r[1]))
    want = targets(sizes)
    assert math.isclose(sum(taken.values()), sum(want.values()), rel_tol=0.1)

    placed = stages["shards"](spark, mixed, SF).collect()
    check(placed, [r[:2] for r in got.elements()], 24)


def test_nulls_repeats_and_clashing_columns(spark):
    long = " ".join(f"word{i}" for i in range(60))
    schema = "doc_id long, text string, lang string, source string, n_chars long, copies int, raw string, kept string"
    rows = [(None, None, None, None, None, 1, "a", "b"), (1, long, "en", "s", 5, 1, "a", "b"), (1, long, "en", "s", 5, 1, "a", "b"),
            (2, long + " more", "en", None, 5, 1, "a", "b"), (None, long.upper(), "en", "s", 5, 1, "a", "b"), (3, "", "en", "s", 0, 1, "a", "b"),
            (None, " ".join(f"other{i}" for i in range(60)), None, "t", 5, 1, "a", "b")]
    docs = spark.createDataFrame(rows, schema)
    stages = dict(corpus_pipeline.STAGES)
    kept = corpus_pipeline.materialise(stages["quality"](spark, docs, SF), "t1")
    assert kept.count() == 5 and kept.columns == docs.columns
    single = corpus_pipeline.materialise(stages["near_dedup"](spark, kept, SF), "t2")
    assert sorted((r.doc_id or 0, r.text) for r in single.collect()) == [(0, rows[6][1]), (1, long)]
    mixed = corpus_pipeline.materialise(stages["mix"](spark, stages["decontaminate"](spark, single, SF), SF), "t3")
    assert mixed.columns == docs.columns and {r.text for r in mixed.collect()} <= {rows[6][1], long}


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.materialise(stage(spark, docs, SF), "empty")
        assert docs.count() == 0


def test_columns_named_like_the_stages_own(spark):
    """The stages' working columns never meet those of the documents, and long texts pass whole."""
    names = ["_id", "_raw", "_source", "_copy", "_copies", "__id", "_row", "row", "doc", "raw", "a.b"]
    texts = [" ".join(f"word{k}x{i}" for i in range(60)) for k in range(4)] + [" ".join(f"long{i}" for i in range(40000))]
    rows = [(k, t, "en", "s", len(t), *[f"{n}{k}" for n in names]) for k, t in enumerate(texts)]
    rows += [rows[0], (9, texts[1], "en", "s", 5, *["other"] * len(names))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.materialise(stage(spark, docs, SF), f"names-{name}")
        assert out.columns == docs.columns
        kept = {(r.doc_id, r.text) for r in out.collect()}
        assert kept <= {(r[0], r[1]) for r in rows} and (4, texts[4]) in kept
        if name == "near_dedup":
            assert sorted(d for d, _ in kept) == [0, 1, 2, 3, 4] and out.count() == 5
        docs = out
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()
