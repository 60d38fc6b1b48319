"""Operator 6 - secrets by sliding-window entropy (SQL functions only).

Base patterns find assignments, access keys and hex strings.  Beyond them,
every candidate string of at least ``WIDTH`` key characters is judged by the
Shannon entropy of a window that slides over it: counts are kept up to
date by the one character that leaves and the one that enters.  The threshold
depends on the window's character class; strings on the allow-list are suppressed.
Windows of letters of one case count from 3.65 bits: above long words (most of them, compounds
too, stay below), below nearly every random key of 40 letters.  Digits alone are left out on
purpose: numbers of 20 digits or more are identifiers as random as a key.

Defined results
    null text: like the empty text, no span; null ``doc_id`` and equal rows: one row
    each; an empty table gives no row; very long texts and strings: scanned whole; a
    candidate that touches a base span adds nothing; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.llm.common import doc_texts
from kestrel.llm.spans import SPANS, add_matches, digest, joined, of_kind

ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?([A-Za-z0-9+/_.=-]++)""")
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}+"
#: Strings whose entropy is looked at: maximal runs of key characters.
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
#: An assignment that reaches up to a candidate, looked for in so many characters before it.
ASSIGNED, BEFORE = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?[A-Za-z0-9+/_.=-]*$""", 200
KINDS = ("assign", "access", "hex", "entropy")
WIDTH = 20
#: Character class of a window (first that fits) and the bits a character from which it is a secret; 9.0: never.
CLASSES = (("^[0-9]*$", 9.0), ("^[0-9a-f]*$|^[0-9A-F]*$", 3.0), ("^[a-z]*$|^[A-Z]*$|^[A-Z]?[a-z_-]*$", 3.65),
           ("^[A-Za-z]*$", 4.0), ("^[a-z0-9]*$|^[A-Z0-9]*$", 3.5), ("^[A-Za-z0-9]*$", 3.6), ("", 3.7))
#: Harmless strings of high entropy: UUIDs, paths of words, words joined by signs or by capitals (each shorter
#: than a window), alphabets, placeholders.
ALLOW = (r"^[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}$",
         r"^/?(?:[A-Za-z_-]+/)+[A-Za-z_-]*$", r"^[A-Za-z]{1,19}(?:[-_=][A-Za-z]{1,19})+$",
         r"^(?:[a-z]{2,19}|[A-Z][a-z]{2,18})(?:[A-Z][a-z]{2,18})+$", r"(?i)example|placeholder|your[-_]",
         r"(?i)abcdefghij", r"01234567(?:89|ab)", r"^[0-9+/_=-]*$")


def _gain(c: Column) -> Column:
    """c * log2(c), the sum of which over the counts gives the entropy."""
    return F.when(c > 0, c * F.log2(c)).otherwise(F.lit(0.0))


def window_entropy(value: Column, width: int = WIDTH, classes=CLASSES) -> Column:
    """Greatest (entropy of a window less its class's threshold); null below one window.

    The state is the window's sum of c*log2(c); a step changes it by the
    counts of just the leaving and the entering character.
    """
    chars = F.split(value, "")
    count = lambda window, ch: F.size(F.filter(window, lambda x: x == ch)).cast("double")
    first = F.slice(chars, 1, width)
    start = F.aggregate(F.array_distinct(first), F.lit(0.0), lambda acc, ch: acc + _gain(count(first, ch)))

    def excess(total: Column, at: Column) -> Column:
        window = F.substring(F.array_join(F.slice(chars, at, F.lit(width)), ""), 1, width)
        limit = None
        for pattern, bits in classes:
            fits = F.lit(True) if not pattern else F.regexp(window, F.lit(pattern))
            limit = F.when(fits, F.lit(bits)) if limit is None else limit.when(fits, F.lit(bits))
        return F.log2(F.lit(float(width))) - total / width - limit

    def step(state: Column, i: Column) -> Column:
        inner = F.slice(chars, i + 1, F.lit(width - 1))  # what stays
        out, new = count(inner, F.element_at(chars, i)), count(inner, F.element_at(chars, i + width))
        total = state["total"] - _gain(out + 1) + _gain(out) + _gain(new + 1) - _gain(new)
        return F.struct(total.alias("total"), F.greatest(state["best"], excess(total, i + 1)).alias("best"))

    n = F.size(chars)
    steps = F.when(n > width, F.sequence(F.lit(1), n - width)).otherwise(F.array().cast("array<int>"))
    zero = F.struct(start.alias("total"), excess(start, F.lit(1)).alias("best"))
    return F.when(n >= width, F.aggregate(steps, zero, step, lambda s: s["best"]))


def find_secrets(docs: DataFrame, allow=ALLOW) -> DataFrame:
    """Per row: doc_id, ``base`` and ``added`` spans (arrays of s, k, e, kind)."""
    text = F.col("text")
    sign = F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))
    df = add_matches(doc_texts(docs), "assign", ASSIGN, group=1, where=sign)
    df = add_matches(df, "access", ACCESS, where=F.contains(text, F.lit("AKIA")))
    df = add_matches(add_matches(df, "hex", HEX), "candidate", CANDIDATE, left=BEFORE).drop("text")
    assign = F.filter("assign", lambda x: F.char_length(x["g"]) >= 6)
    df = df.withColumn("base", F.concat(of_kind(assign, 0, KINDS[0]), of_kind(F.col("access"), 1, KINDS[1]),
                                        of_kind(F.col("hex"), 2, KINDS[2])).cast(SPANS))
    # a candidate holds whole hex strings and access keys; an assignment begins in it or ends in it
    based = F.lit("|".join(f"(?:{p})" for p in (HEX, ACCESS, ASSIGN, *allow)))
    open_ = F.filter("candidate", lambda x: ~F.regexp(x["v"], based) & ~F.regexp(x["left"], F.lit(ASSIGNED)))
    df = df.withColumn("open", open_)
    fresh = F.filter("open", lambda x: F.coalesce(window_entropy(x["v"]), F.lit(-1.0)) >= 0)
    return df.select("doc_id", "base", of_kind(fresh, 3, KINDS[3]).cast(SPANS).alias("added"))


def op6_window_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"))
    n = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return found.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                        digest(F.col("base")).alias("base_sha256"), joined(F.concat("base", "added")).alias("spans"))
