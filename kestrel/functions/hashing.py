"""Deterministic hashing as column expressions.

* ``hash_bucket`` / ``hash_fraction``: the first 32 bits of an MD5 digest
  of ``key-seed``.  The same value is computable in any SQL engine with an
  ``md5`` function, so splits, folds and random draws are reproducible,
  independent of partitioning, and checkable against an SQL oracle.
* ``jvm_string_hash``: ``java.lang.String.hashCode`` of a string column,
  computed over UTF-16 code units with a higher-order ``aggregate``; the
  hashed term-frequency indices of the original text jobs use it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_32 = 4294967296


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def hash_u32(*parts) -> Column:
    """Unsigned 32-bit value of ``md5(p1-p2-...)`` (first 8 hex digits)."""
    text = F.concat_ws("-", *[_c(p).cast("string") if not isinstance(p, (int, float)) else F.lit(str(p))
                             for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_bucket(n: int, *parts) -> Column:
    """Bucket in ``[0, n)`` from the MD5 of the parts."""
    return hash_u32(*parts) % F.lit(n).cast("bigint")


def hash_fraction(*parts) -> Column:
    """Uniform-looking double in ``[0, 1)`` from the MD5 of the parts."""
    return hash_u32(*parts) / F.lit(float(TWO_32))


def non_negative_mod(x, n: int) -> Column:
    """``((x % n) + n) % n`` (C14)."""
    return F.pmod(_c(x), F.lit(n))


def jvm_string_hash(x) -> Column:
    """``String.hashCode`` (signed 32-bit) of a string column.

    h = sum(c_i * 31^(len-1-i)) over UTF-16 code units, modulo 2^32.
    A supplementary character (code point above U+FFFF) contributes its
    surrogate pair (high, low), exactly as the JVM stores it.
    """
    chars = F.split(_c(x), "")

    def step(acc, ch):
        cp = F.ascii(ch).cast("bigint")
        hi = F.lit(0xD800) + F.shiftright(cp - F.lit(0x10000), 10)
        lo = F.lit(0xDC00) + (cp - F.lit(0x10000)).bitwiseAND(F.lit(0x3FF))
        bmp = F.pmod(acc * F.lit(31) + cp, F.lit(TWO_32))
        supp = F.pmod(acc * F.lit(961) + hi * F.lit(31) + lo, F.lit(TWO_32))
        return F.when(cp > F.lit(0xFFFF), supp).otherwise(bmp)

    unsigned = F.when(_c(x) == "", F.lit(0).cast("bigint")).otherwise(
        F.aggregate(chars, F.lit(0).cast("bigint"), step))
    return F.when(unsigned >= F.lit(2 ** 31), unsigned - F.lit(TWO_32)).otherwise(unsigned)


def jvm_hash_index(x, num_features: int) -> Column:
    """Hashed-TF index of a term: non-negative ``hashCode mod numFeatures``."""
    return non_negative_mod(jvm_string_hash(x), num_features).cast("int")
