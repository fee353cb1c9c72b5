"""Near-duplicate listings of one host (JOI5, DQ11, AGG30, SET2).

Flags and counts come from the occupancy of cubes, without pair rows
(``Duplicates``); ``duplicate_pairs`` is the list itself (JOI5).  Pairs (a, b) of the same host with ``a.id < b.id`` and great-circle distance
under the threshold.  Blocking is by host and a cube of the sphere's 3-d
coordinates as wide as the threshold's chord: points within the threshold lie
in the same or in neighbouring cubes, at the poles and across +-180 degrees
too.  One side goes to its own block of cubes and, of half of the neighbouring
blocks, to those that it could reach within the threshold (``_reached``), so
each pair meets once, few rows go to more than one block, and a host with
thousands of listings is spread over many blocks instead of pairing all of
them.  The joins by block are merge joins: what a row's coordinates take is
far more than the compressed files let the optimizer guess, and a broadcast
of them is as large as the table.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import EARTH_RADIUS_KM, haversine_km
from ..session import materialize

DUPLICATE_DISTANCE_KM = 0.05  # fixed value: 50 m


#: Half of the 27 neighbour blocks and the block itself: each unordered pair of blocks once.
_AHEAD = [(dx, dy, dz) for dx in (-1, 0, 1) for dy in (-1, 0, 1) for dz in (-1, 0, 1) if (dx, dy, dz) >= (0, 0, 0)]
#: Cubes along the edge of a block, as a power of two; a block is wider than the threshold.
_BLOCK = 3


def _reached(frame: DataFrame, side: float, reach: float) -> DataFrame:
    """``frame(..., x, y, z, u0, u1, v0, v1, w0, w1)``, of things that lie in
    a cube of ``side`` and stretch between the given coordinates, once for
    its own block ``a, b, c`` (``same``) and each block ahead that holds a
    point less than ``reach`` away along every axis."""
    own = {b: F.shiftright(F.col(c), _BLOCK) for b, c in zip("abc", "xyz")}
    block = lambda x: F.shiftright(F.floor(x / side).cast("long"), _BLOCK)
    low = [block(F.col(f"{c}0") - reach) - own[b] for b, c in zip("abc", "uvw")]
    high = [block(F.col(f"{c}1") + reach) - own[b] for b, c in zip("abc", "uvw")]
    held = frame.withColumns({**own, **{f"_l{b}": x for b, x in zip("abc", low)}, **{f"_h{b}": x for b, x in zip("abc", high)}})
    to = [F.when(F.lit(True) if o == (0, 0, 0) else F.greatest(*[F.col(f"_l{b}") for b, d in zip("abc", o) if d < 0], *[-F.col(f"_h{b}") for b, d in zip("abc", o) if d > 0], F.lit(-2), F.lit(-3)) < 0,
                 F.struct(*[F.lit(d).alias(b) for b, d in zip("abc", o)])) for o in _AHEAD]
    met = held.select(*frame.columns, *"abc", F.explode(F.array_compact(F.array(*to))).alias("o"))
    same = (F.col("o.a") == 0) & (F.col("o.b") == 0) & (F.col("o.c") == 0)
    return met.select(*frame.columns, *[(F.col(b) + F.col(f"o.{b}")).alias(b) for b in "abc"], same.alias("same"))


def duplicate_pairs(df: DataFrame, threshold_km: float = DUPLICATE_DISTANCE_KM, id_col: str = "id",
                    host_col: str = "host_id", lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """JOI5: (host_id, id_a, id_b, distance_km) for pairs under the threshold."""
    pts = df.select(F.col(host_col).alias("host_id"), F.col(id_col).alias("id"),
                    F.col(lat).alias("lat"), F.col(lon).alias("lon")).where(
        F.col("host_id").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull())
    side, phi, lam = _side(threshold_km), F.radians("lat"), F.radians("lon")
    at = dict(zip("uvw", [F.cos(phi) * F.cos(lam) * EARTH_RADIUS_KM, F.cos(phi) * F.sin(lam) * EARTH_RADIUS_KM, F.sin(phi) * EARTH_RADIUS_KM]))
    pts = pts.select("host_id", "id", "lat", "lon", *[F.floor(x / side).cast("long").alias(c) for c, x in zip("xyz", at.values())], *[x.alias(f"{c}{e}") for c, x in at.items() for e in "01"])
    # a little slack against rounding at the edges
    near = _reached(pts, side, _chord(threshold_km) * 1.001).select("host_id", *"abc", "same", *[F.col(c).alias(f"{c}_q") for c in ("id", "lat", "lon")])
    cells = pts.select("host_id", *[F.shiftright(F.col(c), _BLOCK).alias(b) for b, c in zip("abc", "xyz")], *[F.col(c).alias(f"{c}_p") for c in ("id", "lat", "lon")])
    j = cells.join(near.hint("merge"), ["host_id", "a", "b", "c"])
    j = j.where(F.when(F.col("same"), F.col("id_p") < F.col("id_q")).otherwise(F.col("id_p") != F.col("id_q")))
    first = F.col("id_p") < F.col("id_q")
    pick = lambda c, a, b: F.when(first, F.col(f"{c}_{a}")).otherwise(F.col(f"{c}_{b}"))
    d = haversine_km(pick("lat", "p", "q"), pick("lon", "p", "q"), pick("lat", "q", "p"), pick("lon", "q", "p"))
    return (j.select("host_id", pick("id", "p", "q").alias("id_a"), pick("id", "q", "p").alias("id_b"), d.alias("distance_km"))
             .where(F.col("distance_km") < threshold_km))


def located(df: DataFrame, threshold_km: float = DUPLICATE_DISTANCE_KM, id_col: str = "id", host_col: str = "host_id",
            lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """``(host_id, id, lat, lon, u, v, w, x, y, z)``: each listing's place on
    the sphere (km) and its cube, whose diagonal is under the threshold."""
    pts = df.select(F.col(host_col).alias("host_id"), F.col(id_col).alias("id"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon"))
    pts = pts.where(F.col("host_id").isNotNull() & F.col("lat").isNotNull() & F.col("lon").isNotNull() & ~F.isnan("lat") & ~F.isnan("lon"))
    phi, lam, r = F.radians("lat"), F.radians("lon"), EARTH_RADIUS_KM
    pts = pts.select("*", (F.cos(phi) * F.cos(lam) * r).alias("u"), (F.cos(phi) * F.sin(lam) * r).alias("v"), (F.sin(phi) * r).alias("w"))
    side = _side(threshold_km)
    return pts.select("*", *[F.floor(F.col(c) / side).cast("long").alias(n) for c, n in zip("uvw", "xyz")])


def _chord(threshold_km: float) -> float:
    return 2 * EARTH_RADIUS_KM * math.sin(min(threshold_km / (2 * EARTH_RADIUS_KM), math.pi / 2))


def _side(threshold_km: float) -> float:
    """Of a cube whose diagonal is under the threshold."""
    return _chord(threshold_km) / math.sqrt(3) * 0.999


def occupancy(points: DataFrame, threshold_km: float = DUPLICATE_DISTANCE_KM) -> tuple[DataFrame, DataFrame, DataFrame]:
    """What ``located`` points pair with, without a row for a pair: cubes
    ``(host_id, x, y, z, n)``; pairs of cubes all of whose points are near,
    ``(host_id, x, y, z, n, x2, y2, z2, n2)``; and for the pairs of cubes
    that their extents leave open, the near pairs of distinct places
    ``(host_id, lat, lon, m, lat2, lon2, m2)``."""
    place = ["host_id", "x", "y", "z"]
    spots = points.groupBy(*place, "lat", "lon").agg(F.count(F.lit(1)).alias("m"), *[F.first(c).alias(c) for c in "uvw"])
    cubes = spots.groupBy(*place).agg(F.sum("m").alias("n"), *[f(c).alias(f"{c}{e}") for c in "uvw" for f, e in ((F.min, 0), (F.max, 1))])
    cubes = materialize(cubes)
    second = cubes.select(*[F.col(c).alias("host_id" if c == "host_id" else f"{c}2") for c in cubes.columns], *[F.shiftright(F.col(c), _BLOCK).alias(b) for b, c in zip("abc", "xyz")])
    ahead = _reached(cubes, _side(threshold_km), _chord(threshold_km) * 1.001)
    met = ahead.join(second.hint("merge"), ["host_id", "a", "b", "c"])
    met = met.where(~F.col("same") | (F.struct("x", "y", "z") < F.struct("x2", "y2", "z2")))
    far = sum((F.greatest(F.col(f"{c}1") - F.col(f"{c}02"), F.col(f"{c}12") - F.col(f"{c}0")) ** 2 for c in "uvw"), F.lit(0.0))
    gap = sum((F.greatest(F.col(f"{c}0") - F.col(f"{c}12"), F.col(f"{c}02") - F.col(f"{c}1"), F.lit(0.0)) ** 2 for c in "uvw"), F.lit(0.0))
    limit = _chord(threshold_km) ** 2
    met = materialize(met.where(gap < limit * 1.000001).select("host_id", "x", "y", "z", "n", "x2", "y2", "z2", "n2", (far < limit * 0.999999).alias("near")))
    open_ = met.where("not near").select(*place, "x2", "y2", "z2")
    mine = spots.select(*place, "lat", "lon", "m")
    theirs = spots.select("host_id", *[F.col(c).alias(f"{c}2") for c in ("x", "y", "z", "lat", "lon", "m")])
    pairs = open_.join(mine.hint("merge"), place).join(theirs.hint("merge"), ["host_id", "x2", "y2", "z2"])
    pairs = pairs.where(haversine_km(F.col("lat"), F.col("lon"), F.col("lat2"), F.col("lon2")) < threshold_km)
    return cubes, met.where("near").drop("near"), pairs.select("host_id", "lat", "lon", "m", "lat2", "lon2", "m2")


class Duplicates:
    """Flags and counts of near-duplicate listings (ids are unique) from
    cubes' occupancy: points of one cube are near each other, cubes' extents
    prove most pairs of cubes, and only places in pairs of cubes that stay
    open are compared.  A host with many listings in one spot costs a row."""

    def __init__(self, df: DataFrame, threshold_km: float = DUPLICATE_DISTANCE_KM, **columns: str):
        self.points = located(df, threshold_km, **columns)
        self.cubes, self.near, self.pairs = occupancy(self.points, threshold_km)

    def flagged(self) -> DataFrame:
        """SET2: ``(id, host_id)`` of listings with another one under the threshold."""
        cube = ["host_id", "x", "y", "z"]
        whole = (self.cubes.where("n > 1").select(*cube).union(self.near.select(*cube))
                 .union(self.near.select("host_id", "x2", "y2", "z2")).distinct())
        spots = self.pairs.select("host_id", "lat", "lon").union(self.pairs.select("host_id", "lat2", "lon2")).distinct()
        inside = self.points.join(whole.withColumn("_cube", F.lit(True)), cube, "left")
        both = inside.join(spots.withColumn("_spot", F.lit(True)), ["host_id", "lat", "lon"], "left")
        return both.where("_cube or _spot").select("id", "host_id")

    def per_host(self) -> DataFrame:
        """AGG30: ``(host_id, pair_count)``."""
        n = F.col("n")
        parts = (self.cubes.where("n > 1").select("host_id", (n * (n - 1) / 2).cast("long").alias("pairs"))
                 .union(self.near.select("host_id", n * F.col("n2"))).union(self.pairs.select("host_id", F.col("m") * F.col("m2"))))
        return parts.groupBy("host_id").agg(F.sum("pairs").alias("pair_count"))

    def summary(self) -> DataFrame:
        """DQ11 / AGG30: pairs, listings involved, hosts involved (one row)."""
        hosts = self.per_host().agg(F.coalesce(F.sum("pair_count"), F.lit(0)).alias("pair_count"), F.count(F.lit(1)).alias("hosts_involved"))
        ids = self.flagged().agg(F.count(F.lit(1)).alias("listings_involved"))
        one = F.lit(1).alias("_one")
        return hosts.select("*", one).join(ids.select("*", one), "_one").select("pair_count", "listings_involved", "hosts_involved")

    def flag(self, df: DataFrame, id_col: str = "id", out: str = "is_possible_duplicate") -> DataFrame:
        """DQ11: ``df`` with the boolean column."""
        ids = self.flagged().select(F.col("id").alias("_dup_id"), F.lit(True).alias("_dup"))
        return df.join(ids, F.col(id_col) == F.col("_dup_id"), "left").withColumn(out, F.coalesce("_dup", F.lit(False))).drop("_dup_id", "_dup")
