"""Exact order statistics without one-task groups.

A plain ``Window.partitionBy(g).orderBy(v)`` or Spark's exact ``percentile``
puts a whole group (or all its distinct values) into one task.  With one key
holding a third of all rows that task becomes the job.  The operators here
keep every task bounded:

1. reduce to distinct values with counts (``groupBy(g, v).count()``: partial
   aggregation before the shuffle, and the shuffle key includes the value so a
   hot group spreads over many reducers);
2. split the value axis into ``B`` global buckets at approximate quantiles
   (``percentile_approx`` -> at most ``B`` splitters on the driver, a proven
   bound) and bucket rows with ``Bucketizer`` (JVM binary search);
3. running sums inside (bucket, group) windows, plus exclusive per-bucket
   offsets computed on the (bucket, group) totals table (at most ``B`` rows per
   group), joined back on (bucket, group).

Average ranks, ECDF and Mann-Whitney use ``running_sums``.  Quantiles need no
order of all values: a sketch brackets each rank and a second scan sorts only
what lies inside (``exact_quantiles``, ``column_quantiles``).
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

_BKT = "_bkt"


def _n_buckets(df: DataFrame, buckets: int | None) -> int:
    if buckets:
        return buckets
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 8)


def bucketize(df: DataFrame, col: str, buckets: int | None = None, out: str = _BKT) -> DataFrame:
    """Add ``out`` = index of the global value range holding ``col``."""
    b = _n_buckets(df, buckets)
    if b <= 1:
        return df.withColumn(out, F.lit(0.0))
    probs = [i / b for i in range(1, b)]
    row = df.agg(F.percentile_approx(F.col(col).cast("double"), probs, 10000).alias("q")).first()
    qs = sorted({float(x) for x in (row["q"] or []) if x is not None and math.isfinite(x)})
    if not qs:  # no value to split at: one bucket
        return df.withColumn(out, F.lit(0.0))
    splits = [float("-inf")] + qs + [float("inf")]
    src = f"{out}_src"
    bz = Bucketizer(splits=splits, inputCol=src, outputCol=out, handleInvalid="keep")
    return bz.transform(df.withColumn(src, F.col(col).cast("double"))).drop(src)


def running_sums(df: DataFrame, order_col: str, sum_cols: list[str], by: list[str] | tuple = (),
                 buckets: int | None = None, prefix: str = "cum_") -> DataFrame:
    """Inclusive running sums of ``sum_cols`` ordered by ``order_col`` within
    ``by`` (ties share the value: RANGE frame).  Adds ``{prefix}{c}`` and
    the bucket column ``_bkt``."""
    by = list(by)
    b = bucketize(df, order_col, buckets)
    w = (Window.partitionBy(_BKT, *by).orderBy(order_col)
         .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    local = b.select("*", *[F.sum(c).over(w).alias(f"_loc_{c}") for c in sum_cols])
    tot = b.groupBy(_BKT, *by).agg(*[F.sum(c).alias(f"_tot_{c}") for c in sum_cols])
    wo = Window.partitionBy(*by).orderBy(_BKT).rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select(_BKT, *by, *[F.coalesce(F.sum(f"_tot_{c}").over(wo), F.lit(0)).alias(f"_off_{c}")
                                  for c in sum_cols])
    out = local.join(off, [_BKT, *by], "inner")
    return out.select(*[F.col(c) for c in df.columns], F.col(_BKT),
                      *[(F.col(f"_loc_{c}") + F.col(f"_off_{c}")).alias(f"{prefix}{c}") for c in sum_cols])


def value_counts_with_cum(df: DataFrame, value_col: str, by: list[str] | tuple = (),
                          weight_cols: dict | None = None, buckets: int | None = None) -> DataFrame:
    """Distinct (by, value) with count ``_n`` and inclusive running count ``cum__n``;
    optional extra per-value sums (``weight_cols``: name -> Column)."""
    by = list(by)
    aggs = [F.count(F.lit(1)).alias("_n")] + [c.alias(n) for n, c in (weight_cols or {}).items()]
    v = df.where(F.col(value_col).isNotNull() & ~F.isnan(F.col(value_col).cast("double")))
    cnt = materialize(v.groupBy(*by, value_col).agg(*aggs))
    return running_sums(cnt, value_col, ["_n"], by, buckets)


# ---------------------------------------------------------------- quantiles
#: Size of the KLL sketches, and how far a bracket reaches to both sides of its
#: rank: four times the sketch's 99 % error of a normalised rank.
KLL_K = 2000
MARGIN = 4 * 2.296 / KLL_K ** 0.9021
#: Steps of the scale of normalised ranks on which brackets begin and end, and
#: the share of the values that a bracket holds at most.
STEPS = 400
WIDTH = 2 * MARGIN + 2 / STEPS
#: Values inside a bracket that are sorted; a larger bracket is narrowed by another sketch.
SORTED = 2_000_000
#: Rows of per-group figures that may come to the driver and be broadcast.
SMALL = 4096


def _small(df: DataFrame) -> tuple[DataFrame, list | None]:
    """``df`` as a broadcast local frame if it has at most ``SMALL`` rows,
    else as a table in the shared folder; and its rows in the first case."""
    rows = df.limit(SMALL + 1).collect()
    if len(rows) > SMALL:
        return materialize(df), None
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)), rows


def _targets(frame: DataFrame, probs: list[float], names: list[str]) -> DataFrame:
    """``frame(*names, _N, _min, _max, _s)`` to a row for each probability:
    its ranks (0-based, h = p (N - 1) lies between them) and the bracket of
    values that the sketch ``_s`` gives for them."""
    at = F.explode(F.array(*[F.struct(F.lit(i).alias("_i"), F.lit(float(p)).alias("_p")) for i, p in enumerate(probs)]))
    t = frame.where("_N > 0").select(*names, "_N", "_min", "_max", "_s", at.alias("_at")).select(*names, "_N", "_min", "_max", "_s", "_at.*")
    h = F.col("_p") * (F.col("_N") - 1)
    t = t.withColumn("_r0", F.floor(h).cast("long")).withColumn("_f", h - F.floor(h))
    t = t.withColumn("_r1", F.least(F.col("_r0") + 1, F.col("_N") - 1))
    return _bracketed(t, F.col("_r0") / F.col("_N"), F.col("_r1") / F.col("_N")).select(*names, "_i", "_p", "_N", "_r0", "_r1", "_f", "_lo", "_hi")


def _bracketed(t: DataFrame, first: Column, last: Column) -> DataFrame:
    """``_lo`` and ``_hi``: the sketch's values at the next steps of the scale
    of normalised ranks beyond the two ranks less and plus the margin."""
    scale = F.kll_sketch_get_quantile_double("_s", F.array(*[F.lit(i / STEPS) for i in range(STEPS + 1)]))
    lo, hi = F.floor((first - MARGIN) * STEPS).cast("int"), F.ceil((last + 1 / F.col("_N") + MARGIN) * STEPS).cast("int")
    t = t.withColumn("_scale", F.when(F.col("_N") > 0, scale))
    return (t.withColumn("_lo", F.when(lo > 0, F.get("_scale", lo)).otherwise(F.col("_min")))
             .withColumn("_hi", F.when(hi < STEPS, F.get("_scale", hi)).otherwise(F.col("_max"))))


def _narrowed(src: DataFrame, t: DataFrame, names: list[str]) -> DataFrame:
    """The brackets of ``t`` narrowed by a sketch of what lies inside them."""
    keys = [*names, "_i", "_p", "_N", "_r0", "_r1", "_f"]
    inside = F.when(F.col("_v") >= F.col("_lo"), F.col("_v"))
    g = src.join(t, names).where(F.col("_v") <= F.col("_hi")).groupBy(*keys).agg(
        F.count_if(F.col("_v") < F.col("_lo")).alias("_below"), F.count(inside).alias("_inside"), F.min(inside).alias("_min"), F.max(inside).alias("_max"), F.kll_sketch_agg_double(inside, F.lit(KLL_K)).alias("_s"))
    total = g.withColumnsRenamed({"_N": "_all", "_inside": "_N"})
    out = _bracketed(total, (F.col("_r0") - F.col("_below")) / F.col("_N"), (F.col("_r1") - F.col("_below")) / F.col("_N"))
    out = out.drop("_N").withColumnRenamed("_all", "_N")
    # nothing inside: the ranks lie elsewhere, and the selection is to say so
    return out.select(*keys, F.coalesce("_lo", F.lit(float("inf"))).alias("_lo"), F.coalesce("_hi", F.lit(float("inf"))).alias("_hi"))


def _picked(counts: DataFrame, names: list[str]) -> DataFrame:
    """``counts(*names, _i, _p, _r0, _r1, _f, _x, _n)``, ``_x`` null for all
    values below the bracket, to the quantile ``q`` (null: a rank lies outside)."""
    w = Window.partitionBy(*names, "_i").orderBy(F.col("_x").asc_nulls_first())
    cum = counts.withColumn("_to", F.sum("_n").over(w))
    at = lambda r: F.max(F.when((F.col(r) < F.col("_to")) & (F.col(r) >= F.col("_to") - F.col("_n")), F.col("_x")))
    out = cum.groupBy(*names, "_i", "_p", "_f").agg(at("_r0").alias("_v0"), at("_r1").alias("_v1"))
    q = F.when(F.col("_f") == 0, F.col("_v0")).otherwise(F.col("_v0") + (F.col("_v1") - F.col("_v0")) * F.col("_f"))
    return out.select(*names, "_i", "_p", F.when(F.col("_v1").isNotNull(), q).alias("q"))


def selection_counts(src: DataFrame, t: DataFrame, names: list[str]) -> DataFrame:
    """The second scan: for each bracket of ``t`` how many of ``src``'s
    values (``_v``) lie below, as one row that is summed map-side, and the
    counts of the distinct values inside."""
    x = F.when(F.col("_v") >= F.col("_lo"), F.col("_v"))
    return src.join(t, names).where(F.col("_v") <= F.col("_hi")).groupBy(*names, "_i", "_p", "_r0", "_r1", "_f", x.alias("_x")).agg(F.count(F.lit(1)).alias("_n"))


def _selected(src: DataFrame, first: DataFrame, probs: list[float], names: list[str]) -> DataFrame:
    """Sketch, narrow, select; what a bracket missed is selected again
    without a bracket.  ``(*names, _i, _p, q)``."""
    t, rows = _small(_targets(first, probs, names))
    most = max((r["_N"] for r in rows), default=0) if rows is not None else t.agg(F.max("_N")).first()[0]
    while most * WIDTH > SORTED:
        t, _ = _small(_narrowed(src, t, names))
        most *= WIDTH
    picked = _picked(selection_counts(src, t, names), names).drop("_p")
    out, found = _small(t.select(*names, "_i", "_p").join(picked, [*names, "_i"], "left").select(*names, "_i", "_p", "q"))
    missed = any(r["q"] is None for r in found) if found is not None else not out.where("q is null").isEmpty()
    if missed:
        wide = t.withColumns({"_lo": F.lit(float("-inf")), "_hi": F.lit(float("inf"))}).join(out.where("q is null").select(*names, "_i"), [*names, "_i"])
        out = out.where("q is not null").unionByName(_picked(selection_counts(src, wide, names), names))
    return out


def _sketched(values: Column) -> list[Column]:
    return [F.count(values).alias("_N"), F.min(values).alias("_min"), F.max(values).alias("_max"), F.kll_sketch_agg_double(values, F.lit(KLL_K)).alias("_s")]


def _number(c: Column) -> Column:
    """A finite or infinite double; null for NaN."""
    c = c.cast("double")
    return F.when(~F.isnan(c), c)


def exact_quantiles(df: DataFrame, value_col: str, probs: list[float], by: list[str] | tuple = (),
                    buckets: int | None = None, wide: bool = True, names: list[str] | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (pandas / ``quantile_cont``
    semantics, nulls and NaN ignored), per group ``by`` (null groups dropped).

    Returns one row per group with a column per probability (``names`` or
    ``q_<p>``) when ``wide``, else rows (by..., p, q).  A KLL sketch of each
    group, merged map-side, brackets every rank; a second scan counts what is
    below and sorts only what is inside, at most ``SORTED`` values (larger
    brackets are narrowed by another sketch).  A rank that its bracket missed
    is selected without one, so the result is exact in any case.  ``buckets``
    is not used."""
    by = list(by)
    names = names or [f"q_{str(p).replace('.', '_')}" for p in probs]
    group = [f"_k{i}" for i in range(len(by))] or ["_k0"]
    keys = [F.col(f"`{c}`").alias(g) for c, g in zip(by, group)] or [F.lit(0).alias("_k0")]
    src = df.select(*keys, _number(F.col(f"`{value_col}`")).alias("_v")).where(F.col("_v").isNotNull()).dropna(subset=group)
    q = _selected(src, src.groupBy(*group).agg(*_sketched(F.col("_v"))), probs, group)
    back = [F.col(g).alias(c) for c, g in zip(by, group)]
    if not wide:
        return q.select(*back, F.col("_p").alias("p"), "q")
    out = q.groupBy(*group).agg(*[F.max(F.when(F.col("_i") == i, F.col("q"))).alias(n) for i, n in enumerate(names)])
    return out.select(*back, *names)


def column_quantiles(df: DataFrame, cols: list[str], probs: list[float], names: list[str], more: Callable[[Column], list[Column]] | None = None) -> DataFrame:
    """``(column_name, *names[, more...])``: exact quantiles of several columns
    from two scans, without a row for every cell: one aggregate sketches all
    columns, then only the cells inside a bracket become rows.  ``more`` gives
    further aggregates of a column's doubles, taken in the first scan."""
    n = len(cols)
    doubles = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(cols)])
    aggs = [F.struct(*_sketched(_number(F.col(f"c{i}"))), *(more(F.col(f"c{i}")) if more else [])).alias(f"c{i}") for i in range(n)]
    rows = doubles.agg(*aggs).select(F.explode(F.array(*[F.struct(F.lit(i).alias("_k0"), F.col(f"c{i}").alias("s")) for i in range(n)])).alias("r")).select("r._k0", "r.s.*")
    held, _ = _small(rows)
    inside = F.array(*[F.struct(F.lit(i).alias("_k0"), _number(F.col(f"c{i}")).alias("_v")) for i in range(n)])
    cells = doubles.select(F.explode(F.filter(inside, lambda x: x["_v"].isNotNull())).alias("x")).select("x.*")
    q = _selected(cells, held, probs, ["_k0"])
    q = q.groupBy("_k0").agg(*[F.max(F.when(F.col("_i") == i, F.col("q"))).alias(name) for i, name in enumerate(names)])
    name = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("_k0") + 1).alias("column_name")
    extra = [c for c in held.columns if c not in ("_k0", "_N", "_min", "_max", "_s")]
    return held.select("_k0", *extra).join(q, "_k0", "left").select(name, *names, *extra)


def grouped_median(df: DataFrame, value_col: str, by: list[str] | tuple = (), name: str = "median",
                   buckets: int | None = None) -> DataFrame:
    return exact_quantiles(df, value_col, [0.5], by, buckets=buckets, names=[name])


def average_ranks(df: DataFrame, value_col: str, by: list[str] | tuple = (), descending: bool = False,
                  buckets: int | None = None, out: str = "avg_rank") -> DataFrame:
    """Distinct (by, value) with ``_n`` ties and their average rank (1-based,
    ties share the mean rank), like pandas ``rank()``."""
    key = "_rank_key"
    src = df.withColumn(key, -F.col(value_col).cast("double") if descending else F.col(value_col).cast("double"))
    vc = value_counts_with_cum(src, key, by, buckets=buckets)
    return vc.select(*by, F.col(key), "_n", "_bkt",
                     (F.col("cum__n") - F.col("_n") + (F.col("_n") + 1) / 2.0).alias(out))


def attach_average_rank(df: DataFrame, value_col: str, by: list[str] | tuple = (), descending: bool = False,
                        out: str = "avg_rank", buckets: int | None = None) -> DataFrame:
    """WIN1: every row gets the average rank of its value (null value -> null)."""
    by = list(by)
    key = "_rank_key"
    r = average_ranks(df, value_col, by, descending, buckets, out).drop("_n", "_bkt")
    src = df.withColumn(key, -F.col(value_col).cast("double") if descending else F.col(value_col).cast("double"))
    return src.join(r, [*by, key], "left").drop(key)
