"""Secret scans by multipart credential linking (DataFrame functions only).

Base kinds stand by themselves: assignments of secrets, access identifiers
and long hexadecimal runs.  Further parts are weak alone: account names and
client ids, bare tokens of the base-64 alphabet, passphrase-like assignments,
and endpoints (URLs with a host, host:port).  Parts of one document are
joined by an interval join: a scope is a stretch of ``scope`` code points, a
part goes to every stretch it touches or that lies within ``scope`` of it,
and parts meet within stretches if the gap between them is at most ``scope``.
A weak identifier is reported if a secret lies in its scope, a weak secret if
an identifier or an endpoint does, an endpoint if an identifier and a secret
do.  Base parts count as identifiers (access) and secrets (assign, hex), and
are reported in any case.

Nothing is paired: a stretch's parts are reduced to the nearest part of each
role on either side, which is all that a gap test needs.

Spans are in code points, the end exclusive.  Edge cases: a null text is
empty; equal rows get equal results; a text that is one long match is one
span; an empty table gives an empty result; other columns than doc_id and
text are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import col, doc_key, written

#: kind, pattern, group whose length counts, least length.  Order of kinds is the order of equal starts.
BASE = [
    ("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]{24,}", 0, 24),
]
WEAK = [
    ("account", r"""\b(?i:(user(?:name)?|login|account|client_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]+)""", 2, 3),
    ("phrase", r"""\b(?i:(pwd|pass|passphrase|credential|private_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("bare", r"[A-Za-z0-9+/]{32,}={0,2}", 0, 32),
    ("endpoint", r"(?:[a-z][a-z0-9+.-]{1,9}://[A-Za-z0-9.-]+(?::[0-9]+)?|[a-z0-9-]+(?:\.[a-z0-9-]+)+:[0-9]{2,5})", 0, 8),
]
ROLE = {"assign": "secret", "access": "identifier", "hex": "secret", "account": "identifier", "phrase": "secret", "bare": "secret", "endpoint": "endpoint"}


def spans(text: Column, kind: str, order: int, pattern: str, group: int, least: int) -> Column:
    """The matches of one kind as an array of (start, kind order, end): what
    lies between matches and the matches alternate, so their lengths give
    the places."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    between = F.split(text, pattern, -1)

    def placed(arrays: Column) -> Column:
        steps = F.zip_with(F.transform(arrays["m"], F.length), F.slice(F.transform(arrays["b"], F.length), 1, F.size(arrays["m"])), lambda m, b: F.struct(b.alias("b"), m.alias("m")))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<s:int,e:int>>").alias("out"))
        walk = F.aggregate(steps, start, lambda acc, x: F.struct(
            (acc["at"] + x["b"] + x["m"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct((acc["at"] + x["b"]).alias("s"), (acc["at"] + x["b"] + x["m"]).alias("e")))).alias("out")))["out"]
        long = F.zip_with(walk, arrays["v"], lambda p, v: F.when(F.length(v) >= least, F.struct(p["s"].alias("s"), F.lit(order).alias("k"), p["e"].alias("e"))))
        return F.filter(long, lambda x: x.isNotNull())

    empty = F.array().cast("array<struct<s:int,k:int,e:int>>")
    # the arrays of one text, made only where something matches
    return F.when(~text.rlike(pattern), empty).otherwise(F.transform(F.array(F.struct(found.alias("m"), value.alias("v"), between.alias("b"))), placed)[0])


def parts(docs: DataFrame) -> DataFrame:
    """``(k1, k2, doc_id, base, weak)``: the spans of every document."""
    text = F.coalesce(col("text"), F.lit(""))
    k = doc_key(col("doc_id"), col("text"))
    one = lambda specs, at: F.array_sort(F.concat(*[spans(F.col("text"), kind, at + i, *spec) for i, (kind, *spec) in enumerate(specs)]))
    d = docs.select(k[0].alias("k1"), k[1].alias("k2"), col("doc_id").alias("doc_id"), text.alias("text"))
    return d.select("k1", "k2", "doc_id", one(BASE, 0).alias("base"), one(WEAK, len(BASE)).alias("weak"))


def linked(found: DataFrame, scope: int = 200) -> DataFrame:
    """``(k1, k2, more)``: the weak spans that complementary parts support."""
    kinds = [k for k, *_ in BASE + WEAK]
    roles = F.array(*[F.lit(ROLE[k]) for k in kinds])
    p = found.filter(F.size("weak") > 0).select("k1", "k2", F.explode(F.concat("base", "weak")).alias("p")).distinct()
    p = p.select("k1", "k2", "p", roles[F.col("p.k")].alias("role"), F.explode(F.sequence(
        F.floor(F.col("p.s") / scope) - 1, F.floor((F.col("p.e") - 1) / scope) + 1)).alias("stretch"))
    # within a stretch: the nearest begin at or after, and the farthest end at or before, of the other parts of each role
    by = W.partitionBy("k1", "k2", "stretch").orderBy("p.s", "p.e", "p.k")
    past, ahead = by.rowsBetween(W.unboundedPreceding, -1), by.rowsBetween(1, W.unboundedFollowing)

    def near(role: str) -> Column:
        mine = F.col("role") == role
        end = F.max(F.when(mine, F.col("p.e"))).over(past)
        begin = F.min(F.when(mine, F.col("p.s"))).over(ahead)
        return F.coalesce(F.col("p.s") - end <= scope, F.lit(False)) | F.coalesce(begin - F.col("p.e") <= scope, F.lit(False))

    p = p.withColumn("secret", near("secret")).withColumn("identifier", near("identifier")).withColumn("endpoint", near("endpoint"))
    p = p.filter(F.col("p.k") >= len(BASE)).groupBy("k1", "k2", "p", "role").agg(*[F.bool_or(r).alias(r) for r in ("secret", "identifier", "endpoint")])
    good = F.when(F.col("role") == "identifier", F.col("secret")).when(F.col("role") == "secret", F.col("identifier") | F.col("endpoint")).otherwise(F.col("identifier") & F.col("secret"))
    return p.filter(good).groupBy("k1", "k2").agg(F.collect_set("p").alias("more"))


def scan(docs: DataFrame, scope: int = 200) -> DataFrame:
    """``(doc_id, base, spans)`` for every row: arrays of (kind, start, end)
    by start, then kind, then end.  A weak span that equals or lies within a
    base span is left out: that one stands already."""
    found = written(parts(docs), "parts")
    inside = lambda p: F.exists("base", lambda b: (b["s"] <= p["s"]) & (p["e"] <= b["e"]))
    found = found.withColumn("weak", F.filter("weak", lambda p: ~inside(p)))
    kinds = F.array(*[F.lit(k) for k, *_ in BASE + WEAK])
    named = lambda a: F.transform(F.array_sort(a), lambda p: F.struct(kinds[p["k"]].alias("kind"), p["s"].alias("start"), p["e"].alias("end")))
    d = found.join(linked(found, scope), ["k1", "k2"], "left")
    more = F.coalesce("more", F.array().cast("array<struct<s:int,k:int,e:int>>"))
    return d.select("doc_id", named(F.col("base")).alias("base"), named(F.concat("base", more)).alias("spans"))
