"""Mixing sources to target weights by a time-varying curriculum (DataFrame
functions only).

Each source has a weight schedule over the run's time 0..1, linear between
knots.  Its integral is the source's weight: it shares the words of the run,
with a cap on the repeats of a source and the excess shared out anew by
weight.  A source's demand for words grows with time as the integral of its
schedule; its documents stand one after the other in the order of a hash, and
a copy of a document goes to the time at which the cumulative demand reaches
the place where the copy begins.  The mix is the copies range-sorted by time.

A source may hold a third of all rows: the documents are counted by (source,
hash bucket) first, and the running sums are taken within buckets.  The
sources themselves are a small table; only it meets in one task.

Edge cases: a null text has no words and no place in the mix; a null source
is a source of its own; sources without a schedule weigh nothing; an empty
table gives an empty plan; equal rows are separate documents, their order
among each other does not matter; other columns are carried along as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import WORD, col, fresh, written

#: Hexadecimal digits of a source's hash buckets (4096 buckets).
DIGITS = 3


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def order_hash(doc_id: Column) -> Column:
    """The place in its source's order: hexadecimal, so that SQL elsewhere can state it."""
    return F.coalesce(F.md5(doc_id.cast("string").cast("binary")), F.lit(""))


def ranked_schedules(sources: DataFrame, knots: list[list[tuple[float, float]]]) -> DataFrame:
    """``(source, knots)``: the schedules dealt in turn to the distinct
    sources in order of code points, null last."""
    deal = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last())) - 1
    arrays = [F.array(*[F.struct(F.lit(float(t)).alias("t"), F.lit(float(w)).alias("w")) for t, w in k]) for k in knots]
    pick = reduce(lambda c, i: c.when(F.pmod(deal, F.lit(len(knots))) == i, arrays[i]), range(1, len(knots)), F.when(F.pmod(deal, F.lit(len(knots))) == 0, arrays[0]))
    return sources.select("source").distinct().select("source", pick.alias("knots"))


def segments(knots: Column) -> Column:
    """The schedule's segments: begin, width, weights at both ends, and the
    integral up to the begin."""
    def one(i: Column) -> Column:
        a, b = knots[i], knots[i + 1]
        return F.struct(a["t"].alias("t"), (b["t"] - a["t"]).alias("d"), a["w"].alias("w0"), b["w"].alias("w1"), ((a["w"] + b["w"]) / 2 * (b["t"] - a["t"])).alias("area"))

    raw = F.transform(F.sequence(F.lit(0), F.size(knots) - 2), one)
    upto = lambda i: F.aggregate(F.filter(raw, lambda s, j: j < i), F.lit(0.0), lambda a, s: a + s["area"])
    return F.transform(raw, lambda s, i: F.struct(s["t"], s["d"], s["w0"], s["w1"], s["area"], upto(i).alias("cum")))


def targets(sizes: DataFrame, schedules: DataFrame, total: Column | None = None, cap: float = 3.0) -> DataFrame:
    """``(source, source_size, weight, segs, target)`` from ``sizes(source,
    source_size)``: min(cap * size, level * weight), the level such that the
    targets sum to ``total`` (by default all words) or all sources are full.
    Sharing the excess anew by weight until none is above ends there."""
    segs = schedules.select("source", segments(F.col("knots")).alias("segs"))
    segs = segs.withColumn("weight", F.aggregate("segs", F.lit(0.0), lambda a, s: a + s["area"]))
    t = sizes.join(segs.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left").drop("_s")
    t = t.withColumn("weight", F.coalesce("weight", F.lit(0.0))).withColumn("cap", F.col("source_size") * F.lit(float(cap)))
    everything = W.partitionBy()
    fill = W.orderBy(F.col("ratio").asc_nulls_last(), F.col("source").asc_nulls_last())
    before = fill.rowsBetween(W.unboundedPreceding, -1)
    t = t.withColumn("ratio", F.try_divide("cap", "weight")).withColumn("all", F.sum("source_size").over(everything) if total is None else total)
    t = t.withColumn("level", F.try_divide(
        F.col("all") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)),
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    # the sources up to the first whose cap lies above the level are full
    t = t.withColumn("level", F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "source", "level"))).over(everything)["level"])
    target = F.when(F.col("weight") <= 0, 0.0).otherwise(F.least(F.col("cap"), F.coalesce(F.col("level") * F.col("weight"), F.col("cap"))))
    return t.select("source", "source_size", "weight", "segs", target.alias("target"))


def time_of(segs: Column, weight: Column, share: Column) -> Column:
    """The time at which the integral of the schedule reaches ``share`` of
    its whole."""
    x = share * weight
    last = F.get(F.filter(segs, lambda s: (s["cum"] <= x) & (s["area"] > 0)), F.size(F.filter(segs, lambda s: (s["cum"] <= x) & (s["area"] > 0))) - 1)
    y = F.greatest(x - last["cum"], F.lit(0.0))
    slope = (last["w1"] - last["w0"]) / last["d"]
    root = F.sqrt(F.greatest(last["w0"] * last["w0"] + 2 * slope * y, F.lit(0.0)))
    return last["t"] + F.least(last["d"], F.coalesce(F.try_divide(2 * y, last["w0"] + root), F.lit(0.0)))


def plan(docs: DataFrame, knots: list[list[tuple[float, float]]], cap: int = 3, cut_last: bool = True, size: Column | None = None) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` (its source's),
    ``taken`` (words the mix takes, repeats counted) and ``copies``: array of
    ``(copy, words, time)``.  Whole passes over a source, then a part of one:
    with ``cut_last`` the last copy gives just the words still wanted, else
    it is taken whole if its middle lies within.  Clashing names of ``docs``
    are not allowed here; ``mix`` sees to that."""
    d = docs.withColumn("size", words(col("text")) if size is None else size)
    d = d.withColumn("place", order_hash(F.col("doc_id"))).withColumn("bucket", F.substring("place", 1, DIGITS))
    buckets = written(d.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size")), "buckets")
    sizes = buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    t = targets(sizes, ranked_schedules(sizes, knots), cap=cap).withColumnRenamed("source", "_s")
    ahead = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    b = buckets.withColumn("ahead", F.coalesce(F.sum("bucket_size").over(ahead), F.lit(0)))
    b = written(b.join(t, F.col("source").eqNullSafe(F.col("_s"))).select(F.col("source").alias("_s"), F.col("bucket").alias("_b"), "ahead", "source_size", "weight", "segs", "target"), "targets")
    # a (source, bucket) is a key: no key has more than 1/4096 of a source
    d = d.join(b, F.col("source").eqNullSafe(F.col("_s")) & (F.col("bucket") == F.col("_b")))
    inside = W.partitionBy("source", "bucket").orderBy("place", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    d = d.withColumn("begin", F.col("ahead") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    wanted = F.round("target").cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(wanted / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rest = wanted - passes * F.col("source_size") - F.col("begin")
    part = F.greatest(F.least(rest, F.col("size")), F.lit(0)) if cut_last else F.when(2 * rest >= F.col("size"), F.col("size")).otherwise(F.lit(0))
    d = d.withColumn("passes", passes).withColumn("part", part.cast("long")).withColumn("taken", F.when(F.col("size") > 0, F.col("passes") * F.col("size") + F.col("part")).otherwise(F.lit(0)).cast("long"))
    n = F.when(F.col("size") > 0, F.col("passes") + (F.col("part") > 0).cast("long")).otherwise(F.lit(0)).cast("int")
    share = lambda j: F.least((F.col("begin") + j * F.col("source_size")) / F.col("target"), F.lit(1.0))
    copies = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda j: F.struct(
        j.alias("copy"), F.when(j < F.col("passes"), F.col("size")).otherwise(F.col("part")).alias("words"), time_of(F.col("segs"), F.col("weight"), share(j)).alias("time"))))
    return d.withColumn("copies", copies).drop("place", "bucket", "_s", "_b", "ahead", "weight", "segs", "begin", "passes", "part")


def mix(docs: DataFrame, knots: list[list[tuple[float, float]]], cap: int = 3) -> DataFrame:
    """The mix itself: a row of ``docs`` for each whole copy, range-sorted by
    time, with the columns of ``docs``."""
    names = fresh(docs, *[f"c{i}" for i in range(len(docs.columns))])
    flat = docs.select(col("doc_id").alias("doc_id"), col("source").alias("source"), col("text").alias("text"), *[col(c).alias(n) for c, n in zip(docs.columns, names)])
    placed = plan(flat, knots, cap, cut_last=False).select(*names, F.explode("copies").alias("at"))
    tie = F.xxhash64(*[col(n) for c, n in zip(docs.columns, names) if c in ("doc_id", "text")])
    return placed.orderBy(F.col("at")["time"], tie).select(*[col(n).alias(c) for c, n in zip(docs.columns, names)])


def positions(mixed: DataFrame, knots: list[list[tuple[float, float]]], name: str, cap: int = 3) -> DataFrame:
    """The rows of a mix with a column ``name``: their time 0..1 in training.
    All of a source's words are its demand: its first copies stand one after
    the other in the order of the hash, then the second ones, and a row's time
    is where the integral of the source's schedule has come to the place at
    which it begins.  Copies are equal rows, numbered in turn up to ``cap``.
    Sources in order of code points, null last, take the schedules in turn, as
    in the mix.  A row without words stands where the next one begins; a
    source of no words or no weight stands at 0."""
    names = fresh(mixed, *[f"c{i}" for i in range(len(mixed.columns))])
    d = mixed.select(col("doc_id").alias("doc_id"), col("source").alias("source"), col("text").alias("text"), *[col(c).alias(n) for c, n in zip(mixed.columns, names)])
    d = d.withColumn("size", words(col("text"))).withColumn("place", order_hash(F.col("doc_id"))).withColumn("same", F.xxhash64("doc_id", "text")).drop("doc_id", "text")
    d = d.withColumn("bucket", F.substring("place", 1, DIGITS))
    d = d.withColumn("copy", F.pmod(F.row_number().over(W.partitionBy("source", "bucket", "place", "same").orderBy("size")), F.lit(cap)))
    keys = ["source", "copy", "bucket"]
    buckets = written(d.groupBy(*keys).agg(F.sum("size").alias("bucket_size")), "copies")
    # a source has at most cap * 4096 buckets
    ahead = W.partitionBy("source").orderBy(F.pmod(F.col("copy") - 1, F.lit(cap)), "bucket").rowsBetween(W.unboundedPreceding, -1)
    sizes = buckets.groupBy("source").agg(F.sum("bucket_size").alias("source_size"))
    t = targets(sizes, ranked_schedules(sizes, knots)).select(F.col("source").alias("_s"), "source_size", "weight", "segs")
    b = buckets.withColumn("ahead", F.coalesce(F.sum("bucket_size").over(ahead), F.lit(0)))
    b = written(b.join(t, F.col("source").eqNullSafe(F.col("_s"))).select("_s", F.col("copy").alias("_c"), F.col("bucket").alias("_b"), "ahead", "source_size", "weight", "segs"), "places")
    d = d.join(b, F.col("source").eqNullSafe(F.col("_s")) & (F.col("copy") == F.col("_c")) & (F.col("bucket") == F.col("_b")))
    inside = W.partitionBy(*keys).orderBy("place", "same", "size").rowsBetween(W.unboundedPreceding, -1)
    begin = F.col("ahead") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    d = d.withColumn("share", F.least(F.coalesce(F.try_divide(begin.cast("double"), F.col("source_size")), F.lit(0.0)), F.lit(1.0)))
    time = F.coalesce(time_of(F.col("segs"), F.col("weight"), F.col("share")), F.lit(0.0))
    return d.select(*[col(n).alias(c) for c, n in zip(mixed.columns, names)], time.alias(name))
