# fixed values: the short inputs and outputs that tests compare with literally
import pytest
from pyspark.sql import Row

from kestrel.sources import parse


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_id_name_drop_rules(spark):
    df = lines(spark, ["12\t  Foo Bar ", "no tab here", "x9\tBad id", " 7\tblank before id", "5\tA\tB",
                       "-3\tneg", "8\t\tTabbed\t"])
    got = sorted(tuple(r) for r in parse.parse_id_name(df).collect())
    assert got == [(-3, "neg"), (5, "A\tB"), (8, "Tabbed"), (12, "Foo Bar")]


def test_alias_rules(spark):
    got = sorted(tuple(r) for r in parse.parse_alias(lines(spark, ["1\t10", "\t99", "2\t20"])).collect())
    assert got == [(1, 10), (2, 20)]
    for bad in ("x\t10", "7", "7\t", " 7\t 8 ", "7\t8x"):
        with pytest.raises(Exception):
            parse.parse_alias(lines(spark, [bad])).collect()


def test_triples_fail_and_drop(spark):
    good = lines(spark, ["1 2 3", "4 5 6 "])
    assert sorted(tuple(r) for r in parse.parse_triples(good).collect()) == [(1, 2, 3), (4, 5, 6)]
    bad = lines(spark, ["1 2 3", "1 2", "a b c"])
    with pytest.raises(Exception):
        parse.parse_triples(bad).collect()
    assert [tuple(r) for r in parse.parse_triples(bad, on_error="drop").collect()] == [(1, 2, 3)]


def test_pairs_header_and_missing(spark):
    df = lines(spark, ['"id_1","id_2",...', "1,2,1,?,0.5,0,0,1,1,1,0,TRUE", "3,4,?,?,?,?,?,?,?,?,?,false"])
    rows = parse.parse_pairs(df).orderBy("id_1").collect()
    assert len(rows) == 2
    assert rows[0].scores[1] is None and rows[0].scores[2] == 0.5 and rows[0].matched is True
    assert all(s is None for s in rows[1].scores) and rows[1].matched is False


def test_semicolon_bank(spark):
    df = lines(spark, ['"age";"job";"marital";"education";"default";"balance"',
                       '58;"management";"married";"tertiary";"no";"2143"'])
    assert [tuple(r) for r in parse.parse_semicolon(df).collect()] == [(58, "management", "married", "tertiary", 2143)]


def test_numeric_lines_golden(spark):
    df = spark.createDataFrame([(1, "12.0, 15.0\n17.0, 34.0\n56.0, 67.0")], "block_id int, value string")
    rows = parse.parse_numeric_lines(df).orderBy("line_no").collect()
    assert [list(r["values"]) for r in rows] == [[12.0, 15.0], [17.0, 34.0], [56.0, 67.0]]
    assert [list(r["values"]) for r in rows[:2]] == [[12.0, 15.0], [17.0, 34.0]]  # take(2)


def test_strict_numbers_and_flags(spark):
    for bad in ("1 2\t 3", "1 2 3x", "1 2 3.0"):
        with pytest.raises(Exception):
            parse.parse_triples(lines(spark, [bad])).collect()
        assert parse.parse_triples(lines(spark, [bad]), on_error="drop").count() == 0
    head = "1,2," + ",".join("0.5" for _ in range(9)) + ","
    assert [r.matched for r in parse.parse_pairs(lines(spark, [head + "TRUE", head + "false"])).collect()] == [True, False]
    for bad in ("1", "yes", "t", ""):
        with pytest.raises(Exception):
            parse.parse_pairs(lines(spark, [head + bad])).collect()
