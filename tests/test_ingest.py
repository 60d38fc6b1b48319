import json
import random

import pytest

from kestrel.operators.partials import PartialStates
from kestrel.operators.stats import na_stats
from kestrel.sources.ingest import ingest
from kestrel.sources.json import inferred_schema, read_json_lines


def test_rejects_have_file_and_line_numbers_over_many_splits(spark, tmp_path):
    """Small splits: a file's lines are read by many tasks, and a task reads several files."""
    rng = random.Random(2)
    want_rows, want_rejects = [], []
    for f in range(4):
        lines = []
        for n in range(1, rng.choice([3, 400, 900])):
            line, reason = rng.choice([("1 2 3", None), (f"{n} 5 {f}", None), ("1 2", "fields"), ("1 x 3", "number"), ("", "fields"), ("99999999999 1 1", "number")])
            lines.append(line)
            if reason:
                want_rejects.append((f"part{f}.txt", n, reason, line))
            else:
                want_rows.append(tuple(map(int, line.split())))
        (tmp_path / f"part{f}.txt").write_text("\n".join(lines) + "\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        found = ingest(spark, str(tmp_path), "triples")
        rejects = sorted((r.file.rsplit("/", 1)[1], r.line_no, r.reason, r.line) for r in found.rejects.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert rejects == sorted(want_rejects)
    assert sorted(map(tuple, found.rows.collect())) == sorted(want_rows)
    assert found.written.select("file", "block").distinct().count() > 8
    assert sum(r.lines for r in found.counts().collect()) == len(want_rows) + len(want_rejects)


@pytest.mark.parametrize("rule,lines", [
    ("id_name", {"7\tx y ": None, "no tab": "fields", "x7\tname": "number", "\tname": "number"}),
    ("alias", {"1\t2": None, "\t5": "no key", "1": "fields", "1\tb": "number", "": "no key"}),
    ("pairs", {"id_1,id_2,x": "header", "1,2,?,0,1,0,1,0,1,0,?,TRUE": None, "1,2,3": "fields", "1,2,?,0,1,0,1,0,1,0,q,TRUE": "number", "1,2,0,0,0,0,0,0,0,0,0,MAYBE": "flag"}),
    ("semicolon", {'"age";"job"': "header", '30;"a";"b";"c";"no";"5"': None, '30;"a"': "fields", '"x";"a";"b";"c";"no";"5"': "number"}),
])
def test_reasons(spark, tmp_path, rule, lines):
    (tmp_path / "a.txt").write_text("\n".join(lines) + "\n")
    found = ingest(spark, str(tmp_path), rule)
    assert {r.line: r.reason for r in found.rejects.collect()} == {k: v for k, v in lines.items() if v}
    assert found.rows.count() == sum(v is None for v in lines.values())


def test_empty_folder_of_text(spark, tmp_path):
    (tmp_path / "a.txt").write_text("")
    found = ingest(spark, str(tmp_path), "triples")
    assert found.rows.count() == found.rejects.count() == found.counts().count() == 0


def test_json_lines_keep_what_does_not_fit(spark):
    lines = [json.dumps({"a": 1, "u": {"n": "x"}}), json.dumps({"u": {}}), "{}", json.dumps({"a": "text"}), '{"a": 1', "# no", json.dumps({"a": 2, "z": [1], "u": {"n": "é", "k": True}})]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    rows, rejects = read_json_lines(df, "a bigint, u struct<n:string>")
    assert sorted((r.a, r.u and r.u.n) for r in rows.where("a is not null").collect()) == [(1, "x"), (2, "é")]
    assert rows.count() == 4 and {r.line for r in rejects.collect()} == {lines[3], lines[4], lines[5]}
    found = inferred_schema(df)
    assert "k: BOOLEAN" in found and "z: ARRAY<BIGINT>" in found


def test_states_of_loads_merge_and_repeats_count_once(spark, tmp_path):
    from pyspark.sql import functions as F
    rng = random.Random(1)
    rows = [(i % 3, [None if rng.random() < 0.2 else rng.random() * 10 for _ in range(2)]) for i in range(300)]
    df = spark.createDataFrame(rows, "load int, scores array<double>")
    store = PartialStates(spark, str(tmp_path / "states"))
    for batch in (0, 1, 2, 1, 0):
        store.load(f"b{batch}", df.where(F.col("load") == batch), F.lit(0), n_slots=2)
    want = {r.slot: r for r in na_stats(df, n_slots=2).collect()}
    for r in store.merged().collect():
        w = want[r.slot]
        assert (r.n, r.missing, r.min, r.max) == (w.n, w.missing, w.min, w.max)
        assert r.mean == pytest.approx(w.mean) and r.stdev == pytest.approx(w.stdev)
    assert {r.slot: r.n for r in store.merged(["b1"]).collect()} == {r.slot: r.n for r in na_stats(df.where("load = 1"), n_slots=2).collect()}
    with pytest.raises(ValueError):
        store.load("../up", df, F.lit(0))


def test_lines_are_written_small(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("".join(f"{i} {i % 7} 3\n" for i in range(500)) + "x\n")
    found = ingest(spark, str(tmp_path / "lines.txt"), "triples")
    files = found.written.inputFiles()
    assert files and all(".zstd." in f for f in files)
    assert found.rows.count() == 500 and [(r.line_no, r.line) for r in found.rejects.collect()] == [(501, "x")]
