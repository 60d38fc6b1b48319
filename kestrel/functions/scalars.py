"""String, cast and missing-value helpers.

Every helper returns a Column built from built-in functions, so it stays
inside whole-stage code generation and is visible to the optimizer.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def jvm_split_space(x) -> Column:
    """``String.split(" ")`` of the JVM.

    Inner and leading empty tokens are kept, trailing empty tokens are
    dropped; an empty string gives one empty token and a string of only
    spaces gives no token.
    """
    s = _c(x)
    trimmed = F.rtrim(s)
    return (F.when(s == "", F.array(F.lit("")))
            .when(trimmed == "", F.array().cast("array<string>"))
            .otherwise(F.split(trimmed, " ", -1)))


def split_first_tab(x) -> tuple[Column, Column]:
    """Split at the first tab (C03 ``span``): (before, after-or-null)."""
    s = _c(x)
    pos = F.instr(s, "\t")
    before = F.when(pos > 0, F.substring_index(s, "\t", 1)).otherwise(s)
    after = F.when(pos > 0, s.substr(pos + 1, F.length(s))).otherwise(F.lit(None).cast("string"))
    return before, after


def parse_int_strict(x) -> Column:
    """JVM ``toInt`` that drops instead of failing (C05, D18): only an
    optional sign and digits are accepted, no blanks; out-of-range → NULL.

    The cast takes nothing else but blanks around: the first and the last character rule these out, and the
    pattern is asked only where the last one is no digit (it allows an end of line there)."""
    s = _c(x)
    plain = F.ascii(F.right(s, F.lit(1))).between(ord("0"), ord("9"))
    number = F.when(F.ascii(s).between(ord("+"), ord("9")), s.try_cast("int"))
    return F.when(plain, number).when(s.rlike(r"^[+-]?[0-9]+$"), s.try_cast("int"))


def blank_to_null_double(x) -> Column:
    """Empty (or NULL) text → NULL, else the double value."""
    s = _c(x)
    return F.when(s.isNull() | (s == ""), F.lit(None).cast("double")).otherwise(s.cast("double"))


def question_to_null(x) -> Column:
    """``?`` → missing, else the double value."""
    s = _c(x)
    return F.when(s == "?", F.lit(None).cast("double")).otherwise(s.cast("double"))


def nan_to_null(x) -> Column:
    """NaN → NULL so built-in aggregates skip it."""
    return F.nanvl(_c(x), F.lit(None).cast("double"))


def null_to_zero(x) -> Column:
    """Missing (NULL or NaN) → 0.0 (C07 ``naZero``)."""
    return F.coalesce(nan_to_null(x), F.lit(0.0))


def category_offset(x) -> Column:
    """Class text → zero-based category code: ``toDouble - 1``."""
    return _c(x).cast("double") - F.lit(1.0)


def gender_code(x) -> Column:
    """``male`` → 1.0, anything else (NULL included) → 0.0."""
    return F.when(_c(x) == "male", F.lit(1.0)).otherwise(F.lit(0.0))


def jvm_trim(x) -> Column:
    """``String.trim``: strips every leading / trailing character <= U+0020
    (spaces, tabs, control characters), not only spaces."""
    return F.regexp_replace(_c(x), r"^[\x00-\x20]+|[\x00-\x20]+$", "")


def strip_quotes(x) -> Column:
    """``replaceAll("\\"", "")``."""
    return F.regexp_replace(_c(x), '"', "")


def str_len(x) -> Column:
    """Length in UTF-16 code units, as the JVM counts it (C11).

    Characters above U+FFFF count twice.  Uses only built-ins: the code
    point count plus one per supplementary character.
    """
    s = _c(x)
    supplementary = F.size(F.filter(F.split(s, ""), lambda c: F.ascii(c) > 65535))
    return (F.length(s) + F.when(s == "", 0).otherwise(supplementary)).cast("int")
