"""Raw-text parsers.

Each parser takes a DataFrame with a ``value`` string column (one raw
line per row, as ``spark.read.text`` gives) and returns typed columns.
``on_error='fail'`` keeps the original "abort on a malformed line"
behaviour (ANSI casts and ``raise_error``); ``'drop'`` removes such rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.functions.scalars import (
    jvm_split_space,
    jvm_trim,
    parse_int_strict,
    question_to_null,
    split_first_tab,
    strip_quotes,
)


def _check_mode(on_error: str):
    if on_error not in ("fail", "drop"):
        raise ValueError("on_error must be 'fail' or 'drop'")


def _jvm_split(col, sep: str):
    """JVM ``split`` on a one-character separator: trailing empties dropped."""
    s = F.col(col) if isinstance(col, str) else col
    pattern = "\\" + sep if sep in ".$|()[{^?*+\\" else sep
    trimmed = F.regexp_replace(s, f"({pattern})+$", "")
    return (F.when(s == "", F.array(F.lit("")))
            .when(trimmed == "", F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, pattern, -1)))


def _int_or_fail(token, message: str):
    """A plain integer; a token that is none (or missing) fails the job."""
    return F.coalesce(parse_int_strict(token), F.raise_error(F.lit(message)).cast("int"))


def _true_or_false(token):
    """``toBoolean``: true or false in any case; anything else fails the job."""
    low = F.lower(token)
    return F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False)).otherwise(
        F.raise_error(F.lit("malformed match flag")).cast("boolean"))


def parse_triples(df: DataFrame, on_error: str = "fail") -> DataFrame:
    """``"user item count"`` → (user int, item int, cnt int)  (S04)."""
    _check_mode(on_error)
    tok = jvm_split_space("value")
    parts = df.select(tok.alias("t"))
    if on_error == "drop":
        parts = parts.where(F.size("t") == 3)
        cast = [parse_int_strict(F.col("t")[i]) for i in range(3)]
        out = parts.select(*[c.alias(n) for c, n in zip(cast, ("user", "item", "cnt"))])
        return out.where(F.col("user").isNotNull() & F.col("item").isNotNull() & F.col("cnt").isNotNull())
    checked = F.when(F.size("t") == 3, F.col("t")).otherwise(
        F.raise_error(F.lit("malformed rating line")).cast("array<string>"))
    parts = parts.select(checked.alias("t"))
    return parts.select(*[_int_or_fail(F.col("t")[i], "malformed rating line").alias(n)
                          for i, n in enumerate(("user", "item", "cnt"))])


def parse_id_name(df: DataFrame) -> DataFrame:
    """``id<TAB>name`` → (item int, name string)  (S05).

    Split at the first tab; a line without a tab, or whose id is not a plain
    integer, is dropped; the name is trimmed like ``String.trim``.
    """
    before, after = split_first_tab(F.col("value"))
    out = df.select(parse_int_strict(before).alias("item"), jvm_trim(after).alias("name"))
    return out.where(F.col("item").isNotNull() & F.col("name").isNotNull())


def parse_alias(df: DataFrame) -> DataFrame:
    """``bad<TAB>good`` → (bad_id int, good_id int)  (S06).

    An empty first token drops the line; otherwise both tokens must be there
    and be plain integers, without blanks around them (anything else fails
    the job, as the original does).
    """
    tok = _jvm_split("value", "\t")
    parts = df.select(tok.alias("t")).where(F.col("t")[0] != "")
    return parts.select(_int_or_fail(F.col("t")[0], "malformed alias line").alias("bad_id"),
                        _int_or_fail(F.get(F.col("t"), 1), "malformed alias line").alias("good_id"))


def is_header(col="value", marker: str = "id_1"):
    """Header test of the linkage blocks: the line contains ``id_1``."""
    return (F.col(col) if isinstance(col, str) else col).contains(marker)


def parse_pairs(df: DataFrame, n_scores: int = 9) -> DataFrame:
    """Scored pairs ``id_1,id_2,s0..s8,is_match``.

    Header lines are dropped; ``?`` becomes a missing score (NULL); the
    match flag is parsed case-insensitively like ``toBoolean``.
    """
    body = ~is_header("value")
    rows = df.where(body).select(body.alias("_body"), F.split("value", ",", -1).alias("p"))

    def guarded(c):  # a header never reaches a cast, whatever order Spark evaluates in
        return F.when(F.col("_body"), c)

    scores = F.transform(F.slice("p", 3, n_scores), lambda x: question_to_null(x))
    return rows.select(
        guarded(F.col("p")[0].cast("int")).alias("id_1"),
        guarded(F.col("p")[1].cast("int")).alias("id_2"),
        guarded(scores).alias("scores"),
        guarded(_true_or_false(F.col("p")[2 + n_scores])).alias("matched"),
    )


def parse_semicolon(df: DataFrame) -> DataFrame:
    """``;``-separated, quoted bank records (S08): header row dropped,
    quotes stripped, columns 0,1,2,3,5 kept as age, job, marital,
    education, balance."""
    body = F.split("value", ";", -1)[0] != '"age"'
    p = df.where(body).select(body.alias("_body"), F.split("value", ";", -1).alias("s"))

    def field(i, cast=None):
        c = strip_quotes(F.col("s")[i])
        return F.when(F.col("_body"), c.cast(cast) if cast else c)

    return p.select(field(0, "int").alias("age"), field(1).alias("job"), field(2).alias("marital"),
                    field(3).alias("education"), field(5, "int").alias("balance"))


def parse_numeric_lines(df: DataFrame, id_col: str = "block_id") -> DataFrame:
    """Multi-line numeric text → one ``array<double>`` row per line."""
    lines = df.select(id_col, F.posexplode(_jvm_split("value", "\n")).alias("pos", "line"))
    return lines.select(
        id_col,
        (F.col("pos") + 1).cast("int").alias("line_no"),
        F.transform(_jvm_split(F.col("line"), ","), lambda x: F.trim(x).cast("double")).alias("values"),
    )
