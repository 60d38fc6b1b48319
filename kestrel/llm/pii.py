"""Operator 2 - personal data by bootstrapped contextual extraction (SQL functions only).

Base patterns give seeds: addresses of mail and network, card and phone numbers.
Every identifier-like token (one with an '@' or digits) is an instance, and so is every
run of number groups with single blanks between them; the one and
the two words before it are its lexical patterns.  The graph of patterns and
instances is aggregated once and scored in rounds: a pattern's confidence for a kind is
the mean score of the distinct instances seen in it, an instance's score is one
minus the product of its good patterns' doubts.  Instances that end above
``CONFIDENCE`` and have the kind's shape are found wherever they occur.

Defined results
    null text: like the empty text; null ``doc_id`` and equal rows: one row each; an empty
    table gives no row; very long texts: scanned whole (a context is looked for in the 120 characters
    before a token); a token or run that touches a base span adds nothing; a found token within a found run
    is part of it; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kestrel.llm.common import bounded, doc_texts, materialise
from kestrel.llm.spans import SPANS, WS, add_matches, digest, joined, of_kind

KINDS = ("email", "ip", "card", "phone")
# Possessive and anchored where that cannot change a match: no backtracking over long runs.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
TOKEN = rf"(?<![^{WS}])[^{WS}@0-9]*+[@0-9][^{WS}]*+"
#: Number groups with single blanks between them, none of which goes on as a word or as an address.
_GROUP = rf"[0-9][0-9()-]*+(?![^{WS}A-Za-z0-9@]*+[A-Za-z0-9@])"
RUN = rf"(?<![^{WS}])[(+]?{_GROUP}(?:\x20[(]?{_GROUP})++"
CONTEXT = 120
SEED = "struct<s:int,k:int,e:int,kind:string,v:string>"
#: What an unseen identifier of a kind may look like, once punctuation around it is cut off.
SHAPES = {"email": r"^[^@]+@[^@]+$", "ip": r"^[0-9]{1,3}(?:[.:,-][0-9]{1,3}){3}(?:[:/][0-9]{1,5})?$",
          "card": r"^[0-9](?:[\x20-]?[0-9]){11,18}$", "phone": r"^[(+]?[0-9](?:[().-]*+(?:\x20[(]?)?[0-9]){6,14}$"}
EDGE = r"[\"'.,;:!?<>\[\]{}]"
#: Seeds a pattern needs, confidence of a good pattern and a found instance, rounds of scoring.
SUPPORT, CONFIDENCE, ROUNDS = 5, 0.8, 3


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _seed(number: int, kind: str):
    return lambda x: F.struct(x["s"].alias("s"), F.lit(number).alias("k"), x["e"].alias("e"), F.lit(kind).alias("kind"),
                              x["v"].alias("v"))


def add_base(df: DataFrame) -> DataFrame:
    """``df`` (doc_id, text) with ``base``: spans of the four kinds that pass their checks, and ``seeds``: with their texts."""
    text, digit = F.col("text"), F.regexp("text", F.lit("[0-9]"))
    df = add_matches(df, "email", EMAIL, where=F.contains(text, F.lit("@")))
    df = df.withColumn("_digit", digit)
    for kind, pattern in (("ip", IP), ("card", CARD), ("phone", PHONE)):
        df = add_matches(df, kind, pattern, where=F.col("_digit"))
    small = lambda part: (F.char_length(F.ltrim(part, F.lit("0"))) <= 3) & (
        F.coalesce(F.try_to_number(F.right(F.concat(F.lit("000"), F.ltrim(part, F.lit("0"))), F.lit(3)), F.lit("999")), F.lit(999)) <= 255)
    good = {
        "email": F.col("email"), "ip": F.filter("ip", lambda x: F.forall(F.split(x["v"], r"\."), small)),
        "card": F.filter("card", lambda x: F.char_length(_digits(x["v"])).between(14, 19) & F.call_function("luhn_check", _digits(x["v"]))),
        "phone": F.filter("phone", lambda x: F.char_length(_digits(x["v"])).between(10, 15))}
    seeds = [F.transform(good[k], _seed(i, k)) for i, k in enumerate(KINDS)]
    df = df.withColumn("seeds", F.concat(*seeds)).drop("_digit", *KINDS)
    return df.withColumn("base", F.transform("seeds", lambda x: x.dropFields("v")).cast(SPANS))


def _words(left: Column) -> Column:
    """The text before a token -> its words without punctuation, in lower case."""
    return F.filter(F.transform(F.split(F.lower(left), f"[{WS}]+"), lambda w: F.regexp_replace(
        w, r"^[^\p{L}\p{N}#^]++|[^\p{L}\p{N}#^]++$", "")), lambda w: w != "")


def tokens(df: DataFrame) -> DataFrame:
    """(rid, s, e, value, kind, patterns): one row per identifier-like token.

    ``kind``: that of the base span that starts in it (then ``value`` is the
    span's text); null: none.  A token that only continues a base span is left out.
    Tokens and spans of a text meet in order of place, one pass over both.
    """
    t = df.select("rid", F.posexplode("token").alias("i", "t")).select(
        "rid", F.col("t.s").alias("at"), F.lit(0).alias("second"), F.struct("i", "t").alias("tok"), F.lit(None).cast(SEED).alias("seed"))
    s = df.select("rid", F.explode("seeds").alias("seed")).select(
        "rid", F.col("seed.s").alias("at"), F.lit(1).alias("second"), F.lit(None).cast(t.schema["tok"].dataType).alias("tok"), "seed")
    places = Window.partitionBy("rid").orderBy("at", "second")
    before = places.rowsBetween(Window.unboundedPreceding, -1)
    seen = t.unionByName(s).withColumn("until", F.max("seed.e").over(before)) \
        .withColumn("own", F.last(F.col("tok.t"), ignorenulls=True).over(places.rowsBetween(Window.unboundedPreceding, 0)))
    per = seen.groupBy("rid", F.col("own.s").alias("at")).agg(
        F.max("tok").alias("tok"), F.max(F.when(F.col("tok").isNotNull(), F.col("until"))).alias("until"),
        F.min(F.when(F.col("seed.s") < F.col("own.e"), F.col("seed"))).alias("first"))
    t = per.where(F.col("tok").isNotNull() & (F.col("first").isNotNull() | (F.coalesce("until", F.lit(0)) <= F.col("at"))))
    v = F.col("tok.t.v")
    t = t.where(F.col("first").isNotNull() | _telling(v)).select("rid", "at", "first", "tok", F.regexp_replace(v, f"^{EDGE}++|{EDGE}++$", "").alias("core"),
                                                                 F.char_length(F.regexp_extract(v, f"^{EDGE}*+", 0)).alias("lead"))
    # what stands before the text's first token, or between two tokens
    left = F.concat(F.when(F.col("tok.i") == 0, F.lit("^ ^ ")).otherwise(F.lit("# # ")), F.col("tok.t.left"))
    t = t.where("core <> ''").withColumn("words", _words(left))
    n = F.size("words")
    one, two = F.get("words", n - 1), F.get("words", n - 2)
    s = F.col("at") + F.col("lead")
    return t.select("rid", s.alias("s"), (s + F.char_length("core")).alias("e"), F.coalesce("first.v", "core").alias("value"),
                    F.col("first.kind").alias("kind"),
                    F.array(F.concat(F.lit("1 "), one), F.concat(F.lit("2 "), two, F.lit(" "), one)).alias("patterns"))


def runs(df: DataFrame) -> DataFrame:
    """(rid, s, e, value, kind, patterns) as ``tokens``: one row per run of number groups outside the base spans."""
    r = df.select("rid", F.explode("run").alias("r")).select(
        "rid", F.col("r.e").alias("at"), F.lit(0).alias("second"), "r", F.lit(None).cast("int").alias("end"))
    b = df.select("rid", F.explode("base").alias("b")).select(
        "rid", F.col("b.s").alias("at"), F.lit(1).alias("second"), F.lit(None).cast(r.schema["r"].dataType).alias("r"), F.col("b.e").alias("end"))
    # a base span overlaps if it begins before the run's end and ends after its beginning: one pass over the places of both
    before = Window.partitionBy("rid").orderBy("at", "second").rowsBetween(Window.unboundedPreceding, -1)
    r = r.unionByName(b).withColumn("until", F.max("end").over(before)).where(F.col("r").isNotNull() & (F.coalesce("until", F.lit(0)) <= F.col("r.s")))
    core = F.regexp_replace(F.col("r.v"), r"[()-]++$", "")
    r = r.where(_telling(core)).select("rid", F.col("r.s").alias("s"), core.alias("value"), F.transform(
        _words(F.concat(F.lit("# # "), F.col("r.left"))), lambda w: F.when(F.regexp(w, F.lit("[0-9@]")), "#").otherwise(w)).alias("words"))
    n = F.size("words")
    one, two = F.get("words", n - 1), F.get("words", n - 2)
    return r.select("rid", "s", (F.col("s") + F.char_length("value")).alias("e"), "value", F.lit(None).cast("string").alias("kind"),
                    F.array(F.concat(F.lit("1 "), one), F.concat(F.lit("2 "), two, F.lit(" "), one)).alias("patterns"))


def _telling(v: Column) -> Column:
    return F.contains(v, F.lit("@")) | (F.char_length(_digits(v)) >= 4)


def score(edges: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """(kind, value): instances found from the graph ``edges`` (pattern, value, kind or null).

    Per round one aggregation over the edges to patterns and one to instances;
    partial sums meet before the shuffle, so that a pattern before a third of all
    tokens is one row per task.
    """
    shape = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(p).alias("p")) for k, p in SHAPES.items()])
    may = F.transform(F.filter(shape, lambda x: F.regexp(F.col("value"), x["p"])), lambda x: x["k"])
    totals = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("all"))
    seeds = edges.where("kind is not null").groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("seeds"))
    graph = edges.where("kind is null").select("pattern", "value", F.explode(may).alias("kind"))
    known = materialise(seeds.where(F.col("seeds") >= support).join(totals, "pattern"), "pii-patterns")
    graph = materialise(graph.join(bounded(known.select("pattern", "kind"), "pii-keys"), ["pattern", "kind"]), "pii-graph")
    found = None
    for _ in range(rounds):
        gained = known.select("pattern", "kind", "all", (F.col("seeds") / F.col("all")).alias("conf"))
        if found is not None:
            more = graph.join(found, ["kind", "value"]).groupBy("pattern", "kind").agg(F.sum("score").alias("more"))
            gained = known.join(more, ["pattern", "kind"], "left").select(
                "pattern", "kind", "all", ((F.col("seeds") + F.coalesce("more", F.lit(0.0))) / F.col("all")).alias("conf"))
        good = bounded(gained.where(F.col("conf") >= confidence).select("pattern", "kind", "conf"), "pii-good")
        doubt = F.sum(F.log1p(-F.least(F.col("conf"), F.lit(0.999))))
        found = materialise(graph.join(good, ["pattern", "kind"]).groupBy("kind", "value")
                            .agg((1 - F.exp(doubt)).alias("score")), "pii-found")
    return found.where(F.col("score") >= confidence).select("kind", "value")


def find_pii(docs: DataFrame, support: int = SUPPORT, confidence: float = CONFIDENCE, rounds: int = ROUNDS) -> DataFrame:
    """Per row: doc_id, ``base`` and ``added`` spans (arrays of s, k, e, kind)."""
    based = add_matches(add_base(doc_texts(docs)), "token", TOKEN, left=CONTEXT)
    based = add_matches(based, "run", RUN, left=CONTEXT)
    big = F.filter("token", lambda x: (F.size("seeds") > 0) | _telling(x["v"]))
    rows = materialise(based.select("doc_id", "base", "seeds", big.alias("token"), "run", F.monotonically_increasing_id().alias("rid")), "pii-rows")
    some = materialise(tokens(rows.where(F.size("token") > 0)).unionByName(runs(rows.where(F.size("run") > 0))), "pii-tokens")
    edges = some.select(F.explode("patterns").alias("pattern"), "value", "kind").groupBy("pattern", "value") \
        .agg(F.min("kind").alias("kind"))
    hits = score(materialise(edges, "pii-edges"), support, confidence, rounds)
    one = hits.groupBy("value").agg(F.min(F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))).alias("k"))
    name = F.element_at(F.array(*map(F.lit, KINDS)), F.col("k").cast("int"))
    places = some.where("kind is null").join(bounded(one, "pii-hits"), "value").groupBy("rid", "s", "e").agg(
        F.collect_list(F.struct((F.col("k") - 1).cast("int").alias("k"), name.alias("kind"))).alias("kinds"))
    # inside a longer span: one that begins no later, and of those with the same beginning is longer, ends no earlier
    before = Window.partitionBy("rid").orderBy("s", F.desc("e")).rowsBetween(Window.unboundedPreceding, -1)
    widest = places.withColumn("until", F.max("e").over(before)).where(F.col("until").isNull() | (F.col("until") < F.col("e")))
    found = widest.select("rid", "s", "e", F.explode("kinds").alias("x")).groupBy("rid").agg(
        F.collect_list(F.struct("s", "x.k", "e", "x.kind")).cast(SPANS).alias("added"))
    out = rows.select("rid", "doc_id", "base").join(bounded(found, "pii-added"), "rid", "left")
    return out.select("doc_id", "base", F.coalesce("added", F.array().cast(SPANS)).alias("added"))


def op2_contextual_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"))
    n = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return found.select("doc_id", *[n(i).alias(f"n_{k}") for i, k in enumerate(KINDS)],
                        digest(F.col("base")).alias("base_sha256"), joined(F.concat("base", "added")).alias("spans"))
