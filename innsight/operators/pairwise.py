"""Tukey HSD over k group summaries without the k(k - 1) / 2 pairs (STA8).

A pair is rejected if its means differ by more than c sqrt(1/n1 + 1/n2), with
c the critical value times sqrt(msw / 2).  Groups are put into classes of
almost equal size.  Seen from the group with the lower mean, the groups of a
class above one bound are rejected whatever their size, those below another are
not, and both counts come from running counts over the sorted means.  Only the
narrow band between is compared one by one, in a join on blocks of ranks.

The largest differences are either in a band or among the lowest means of one
class against the highest of another: a rejected pair beyond the bound has all
pairs of its two classes with a larger difference rejected too.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dists
from ..session import materialize
from .ranking import running_sums
from .stats import ALPHA, group_moments

#: Sizes of a class differ by less than this factor; 64-bit counts make at most 459 classes.
RATIO = 1.1
#: Ranks in a block of the band's join.
BLOCK = 64
#: Share of a bound by which the band is wider than rounding could need.
SLACK = 1e-9


def _differs(low: str, high: str, c: float) -> Column:
    """Whether the pair of ``low`` and ``high`` (means m, sizes n) is rejected."""
    inverse = 1 / F.col(f"{low}n") + 1 / F.col(f"{high}n")
    return F.col(f"{high}m") - F.col(f"{low}m") > c * F.sqrt(inverse)


def _largest(lows: list, highs: list, c: float, top: int) -> list[tuple]:
    """The ``top`` largest rejected differences of ``lows`` against ``highs``."""
    if not lows or not highs:
        return []
    m, inverse = np.array([r["m"] for r in highs], float), np.array([1 / r["n"] for r in highs])
    best: list[tuple] = []
    for r in lows:
        d = m - r["m"]
        least = -best[-1][0] if len(best) == top else 0.0
        for j in np.flatnonzero((d > c * np.sqrt(1 / r["n"] + inverse)) & (d >= least)):
            best.append(_pair(float(d[j]), r["g"], highs[j]["g"]))
        best = sorted(set(best))[:top]
    return best


def _pair(d: float, low, high) -> tuple:
    """(minus the absolute difference, group1, group2, mean of group2 less mean of group1)."""
    return (-d, low, high, d) if low < high else (-d, high, low, -d)


def tukey_report(df: DataFrame, value: str, group: str, min_n: int = 0, alpha: float = ALPHA, top: int = 10) -> DataFrame:
    """STA8: how many pairs of groups there are and how many Tukey-Kramer
    rejects, with the ``top`` largest rejected differences (a row each: mean of
    group2 less mean of group1, adjusted p; equal ones by the groups' names).

    One row without a pair if nothing is rejected: no or one group, no degree
    of freedom, equal means.  Without any spread inside the groups, every pair
    of different means is rejected."""
    spark = df.sparkSession
    gm = group_moments(df, value, group, min_n)
    gm = materialize(gm.select(F.col(group).alias("g"), "n", F.col("mean").cast("double").alias("m"), "var",
                               F.floor(F.log(F.col("n").cast("double")) / math.log(RATIO)).cast("int").alias("size")))
    row = gm.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"),
                 F.sum((F.col("n") - 1) * F.coalesce(F.col("var"), F.lit(0.0))).alias("ssw")).first()
    k, dfw = row["k"], (row["n"] or 0) - row["k"]
    kind = gm.schema["g"].dataType
    schema = T.StructType([T.StructField("group1", kind), T.StructField("group2", kind), T.StructField("meandiff", T.DoubleType()),
                           T.StructField("p_adj", T.DoubleType()), T.StructField("pairs", T.LongType()), T.StructField("rejected", T.LongType())])
    pairs = k * (k - 1) // 2
    if k < 2 or dfw <= 0:
        return spark.createDataFrame([(None, None, None, None, pairs, 0)], schema)
    half = math.sqrt(row["ssw"] / dfw / 2)
    c = dists.qtukey(1 - alpha, k, dfw) * half

    # the bounds of each group in each class of sizes, and the running counts there
    sizes = [r.asDict() for r in gm.groupBy("size").agg(F.min("n").alias("least"), F.max("n").alias("most")).collect()]
    bound = lambda inverse, way: F.col("m") + c * F.sqrt(1 / F.col("n") + F.col(inverse)) * (1 + way * SLACK) + F.lit(way * 1e-12 * (c > 0)) * F.abs("m")
    every = F.array(*[F.struct(F.lit(r["size"]).alias("size"), F.lit(1 / r["most"]).alias("low"), F.lit(1 / r["least"]).alias("high")) for r in sizes])
    seen = gm.select("g", "n", "m", F.explode(every).alias("of")).select("g", "n", "m", "of.*")
    seen = seen.select("size", "g", "n", "m", F.explode(F.array(
        F.struct(F.lit("a").alias("bound"), bound("low", -1).alias("v")), F.struct(F.lit("b").alias("bound"), bound("high", 1).alias("v")))).alias("at"))
    events = gm.select("size", "g", "n", "m", F.lit(None).cast("string").alias("bound"), F.col("m").alias("v"), F.lit(1).cast("long").alias("one"))
    events = events.union(seen.select("size", "g", "n", "m", "at.bound", "at.v", F.lit(0).cast("long")))
    ranked = materialize(running_sums(events, "v", ["one"], ["size"]).drop("_bkt"))
    held = gm.groupBy("size").agg(F.count(F.lit(1)).alias("held"))
    probes = ranked.where(F.col("bound").isNotNull()).groupBy("size", "g", "n", "m").agg(
        F.max(F.when(F.col("bound") == "a", F.col("cum_one"))).alias("a"), F.max(F.when(F.col("bound") == "b", F.col("cum_one"))).alias("b"))
    sure = probes.join(F.broadcast(held), "size").agg(F.sum(F.col("held") - F.col("b"))).first()[0]

    # the band between the bounds, pair by pair
    block = lambda rank: F.floor(rank / BLOCK).cast("long")
    low = probes.where("a < b").select("size", F.col("g").alias("lg"), F.col("n").alias("ln"), F.col("m").alias("lm"), "a", "b",
                                       F.explode(F.sequence(block(F.col("a") + 1), block(F.col("b")))).alias("block"))
    high = ranked.where(F.col("bound").isNull()).select("size", F.col("g").alias("hg"), F.col("n").alias("hn"), F.col("m").alias("hm"),
                                                        F.col("cum_one").alias("rank"), block(F.col("cum_one")).alias("block"))
    band = low.join(high, ["size", "block"]).where((F.col("rank") > F.col("a")) & (F.col("rank") <= F.col("b")) & _differs("l", "h", c))
    between = band.select("lg", "hg", (F.col("hm") - F.col("lm")).alias("d"))
    between = materialize(between)
    rejected = sure + between.count()

    # the largest: of the band, and of the ends of the classes
    best = between.select("d", F.least("lg", "hg").alias("g1"), F.greatest("lg", "hg").alias("g2"), (F.col("lg") < F.col("hg")).alias("up"))
    best = [(-r["d"], r["g1"], r["g2"], r["d"] if r["up"] else -r["d"]) for r in best.orderBy(F.desc("d"), "g1", "g2").limit(top).collect()]
    ends = []
    for order in ([F.col("m"), F.col("g")], [F.desc("m"), F.col("g")]):
        w = Window.partitionBy("size").orderBy(*order)
        ends.append(gm.withColumn("r", F.row_number().over(w)).where(F.col("r") <= top).select("g", "n", "m").collect())
    best = sorted({*best, *_largest(*ends, c, top)})[:top]
    n = {r["g"]: r["n"] for end in ends for r in end}
    missing = [g for b in best for g in b[1:3] if g not in n]
    if missing:  # at most two names a row
        n |= {r["g"]: r["n"] for r in gm.where(F.col("g").isin(missing)).select("g", "n").collect()}
    q = [(-b[0] / (half * math.sqrt(1 / n[b[1]] + 1 / n[b[2]])) if half > 0 else math.inf) for b in best]
    p = dists.tukey_sf_many(np.array(q), k, float(dfw)) if best else []
    rows = [(b[1], b[2], b[3], float(x), pairs, rejected) for b, x in zip(best, p)]
    return spark.createDataFrame(rows or [(None, None, None, None, pairs, 0)], schema)
