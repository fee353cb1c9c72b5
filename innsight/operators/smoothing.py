"""Local linear smoothing over distributed values (STA18).

For every distinct x a line is fitted with tricube weights to the nearest
``frac`` of the rows.  No task holds the data:

* rows become value counts, and the values are cut into about sqrt(N) buckets
  (N distinct values), each with a bounded share of the values and of the rows
  or a single value;
* each bucket becomes a dozen weighted nodes that give the same sum for every
  polynomial up to degree 11 (sums of Chebyshev polynomials, one aggregate).
  On one side of a point the weight is a polynomial of degree 9 and the line's
  products reach degree 11, so a bucket inside the window counts exactly by
  its nodes;
* a point needs the values themselves only of its own bucket and of those in
  which its window may end.  Points with the same such buckets meet their
  values in one group.

What every task gets is the bucket table, at most 4 sqrt(N) + 4 rows of 27
numbers (27 MB for 10^9 values); a group holds a bucket's points and the values of
the few buckets beside.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, ship_package

#: Nodes of a bucket: polynomials below this degree are summed exactly.
NODES = 12
#: Matrix entries that a task lays out at a time.
CHUNK = 1 << 20
RESULT = "x double, smoothed double, n long"
_KEY = ["own", "l0", "l1", "r0", "r1"]


def _split_points(rows: DataFrame, values: DataFrame, buckets: int) -> list[float]:
    """Where buckets begin: quantiles of the rows and of the distinct values;
    a value that is several quantiles of the rows is alone in its bucket."""
    probs = [i / buckets for i in range(1, buckets)]
    if not probs:
        return []
    cut = F.percentile_approx("x", probs, max(10000, 4 * buckets)).alias("q")
    by_row, by_value = rows.agg(cut).first()["q"], values.agg(cut).first()["q"]
    alone = {a for a, b in zip(by_row, by_row[1:]) if a == b}
    return sorted({*by_row, *by_value, *(math.nextafter(a, math.inf) for a in alone)})


class Buckets:
    """The bucket table: bounds, row counts and nodes with their weights."""

    def __init__(self, rows: list, need: float):
        self.need = need
        self.lo, self.hi, self.n = (np.array([r[c] for r in rows], float) for c in ("lo", "hi", "n"))
        angle = (2 * np.arange(NODES) + 1) * math.pi / (2 * NODES)
        basis = np.cos(np.outer(np.arange(NODES), angle)) * np.where(np.arange(NODES) == 0, 1, 2)[:, None] / NODES
        self.at = (self.lo + self.hi)[:, None] / 2 + (self.hi - self.lo)[:, None] / 2 * np.cos(angle)
        self.weight = np.array([[r[f"n{j}"] for j in range(NODES)] for r in rows]) @ basis
        self.value = np.array([[r[f"y{j}"] for j in range(NODES)] for r in rows]) @ basis

    def far(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(self.hi - x[:, None], x[:, None] - self.lo)

    def reached(self, d: np.ndarray) -> np.ndarray:
        """The distance at which the buckets' rows suffice if each counts from its ``d``."""
        order = np.argsort(d, axis=1, kind="stable")
        enough = np.cumsum(self.n[order], axis=1) >= self.need
        return np.take_along_axis(d, order, 1)[np.arange(len(d)), enough.argmax(1)]

    def ends(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, ...]:
        """``(least, l0, l1, r0, r1)``: the window is no narrower than
        ``least``, and it can end only in the buckets l0..l1 left and r0..r1
        right of a point's own (none: first above last)."""
        near = np.maximum(np.maximum(self.lo - x[:, None], x[:, None] - self.hi), 0)
        far = self.far(x)
        least, most = self.reached(near), self.reached(far)
        there = (near <= most[:, None]) & (far >= least[:, None])
        j, last = np.arange(len(self.n)), len(self.n) - 1
        out = [least]
        for side in (there & (j < own[:, None]), there & (j > own[:, None])):
            some = side.any(1)
            out += [np.where(some, side.argmax(1), 0), np.where(some, last - side[:, ::-1].argmax(1), -1)]
        return tuple(out)


def _sums(x: np.ndarray, h: np.ndarray, at: np.ndarray, n: np.ndarray, y: np.ndarray, use=None) -> np.ndarray:
    """Weighted sums 1, u, u^2, y, uy of the entries ``at`` around each x, u in bandwidths."""
    u = (at - x[:, None]) / h[:, None]
    w = np.maximum(1 - np.abs(u) ** 3, 0) ** 3
    if use is not None:
        w = np.where(use, w, 0.0)
    wu = w * u
    return np.array([w @ n, wu @ n, (wu * u) @ n, w @ y, wu @ y])


def _fit(b: Buckets, points: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
    """The smoothed values of points whose windows end in the buckets ``held``."""
    own = int(points["own"].iloc[0])
    v, n, y = (held[c].to_numpy(float) for c in ("x", "n", "sy"))
    order = np.argsort(v, kind="stable")
    v, n, y = v[order], n[order], y[order]
    out = []
    step = max(1, CHUNK // (len(v) + NODES * len(b.n)))
    for i in range(0, len(points), step):
        part = points.iloc[i:i + step]
        x, least = part["x"].to_numpy(float), part["least"].to_numpy(float)
        inside = b.far(x) < least[:, None]
        inside[:, own] = False
        d = np.abs(v - x[:, None])
        by = np.argsort(d, axis=1, kind="stable")
        enough = (inside @ b.n)[:, None] + np.cumsum(n[by], axis=1) >= b.need
        h = np.take_along_axis(d, by, 1)[np.arange(len(x)), enough.argmax(1)]
        reach = np.where(h > 0, h * 1.0000001, 1.0)
        used = inside.any(0)
        s = _sums(x, reach, v, n, y) + _sums(x, reach, b.at[used].ravel(), b.weight[used].ravel(), b.value[used].ravel(),
                                             np.repeat(inside[:, used], NODES, axis=1))
        sw, su, suu, sy, suy = s
        den = sw * suu - su ** 2
        line = den > 1e-12 * sw * suu
        fit = np.where(line, (sy * suu - su * suy) / np.where(line, den, 1.0), sy / sw)
        # one value holds ``frac`` of the rows: its mean
        out.append(np.where(h > 0, fit, part["sy"].to_numpy(float) / part["n"].to_numpy(float)))
    return pd.DataFrame({"x": points["x"], "smoothed": np.concatenate(out), "n": points["n"]})


def local_fit(df: DataFrame, x: str, y: str, frac: float = 2 / 3, buckets: int | None = None) -> DataFrame:
    """STA18 (re-aimed: no robustness iterations): ``(x, smoothed, n)`` for
    each distinct ``x``, the local line with tricube weights over the nearest
    ``frac`` of the rows (the smallest distance that holds so many).

    Rows where either is null, NaN or infinite take no part; ties in x are one
    point with their count; a window of one value gives that value's mean; an
    empty table gives no rows."""
    spark = df.sparkSession
    src = df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y")).dropna()
    src = src.where((F.abs("x") < math.inf) & (F.abs("y") < math.inf))
    values = materialize(src.groupBy("x").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("sy")))
    many, total = values.agg(F.count(F.lit(1)), F.sum("n")).first()
    if not many:
        return spark.createDataFrame([], RESULT)
    splits = _split_points(src, values, buckets or math.ceil(math.sqrt(many)))
    cut = values.withColumn("bucket", F.lit(0.0))
    if splits:
        cut = Bucketizer(splits=[-math.inf, *splits, math.inf], inputCol="x", outputCol="bucket").transform(values)
    bounds = cut.groupBy("bucket").agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.sum("n").alias("n")).orderBy("bucket").collect()
    table = spark.createDataFrame([(r["bucket"], i, r["lo"], r["hi"]) for i, r in enumerate(bounds)], "bucket double, own int, lo double, hi double")
    placed = cut.join(F.broadcast(table), "bucket")
    z = F.when(F.col("hi") > F.col("lo"), 2 * ((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo"))) - 1).otherwise(0.0)
    angle = placed.withColumn("a", F.acos(F.greatest(F.least(z, F.lit(1.0)), F.lit(-1.0))))
    moments = [F.sum(F.col(c) * F.cos(j * F.col("a"))).alias(f"{name}{j}") for c, name in (("n", "n"), ("sy", "y")) for j in range(NODES)]
    rows = angle.groupBy("own", "lo", "hi").agg(F.sum("n").alias("n"), *moments).orderBy("own").collect()
    ship_package(spark)
    shared = spark.sparkContext.broadcast(Buckets(rows, frac * total))

    def ends(frames):
        b = shared.value
        for pdf in frames:
            step = max(1, CHUNK // len(b.n))
            for i in range(0, len(pdf), step):
                part = pdf.iloc[i:i + step]
                found = b.ends(part["x"].to_numpy(float), part["own"].to_numpy())
                yield part.assign(**dict(zip(["least", *_KEY[1:]], found)))

    def fit(points: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        return _fit(shared.value, points, held)

    points = placed.select("x", "n", "sy", "own").mapInPandas(
        ends, "x double, n long, sy double, own int, least double, l0 int, l1 int, r0 int, r1 int")
    points = materialize(points)
    run = lambda a, z: F.when(F.col(a) <= F.col(z), F.sequence(a, z)).otherwise(F.array().cast("array<int>"))
    wanted = points.select(*_KEY).distinct().withColumn("held", F.explode(F.concat(F.array("own"), run("l0", "l1"), run("r0", "r1"))))
    wanted = wanted.select("held", *[F.col(c).alias(f"of_{c}") for c in _KEY])
    held = wanted.join(placed.select(F.col("own").alias("held"), "x", "n", "sy"), "held").drop("held")
    return points.groupBy(*_KEY).cogroup(held.groupBy(*[f"of_{c}" for c in _KEY])).applyInPandas(fit, RESULT)
