"""Approximate nearest neighbours by balanced posting lists.

Largest inner product is turned into smallest distance: each vector gets one
more component, the square root of what its squared norm lacks to the largest.
Centroids come from a bounded sample (``FIT_ROWS`` distinct vectors, the
smallest hashes), halved again and again at the median along the axis of two
means, so every list holds as many sample vectors, and then settled by a few
rounds of means.  The centroids form a
nearest-neighbour graph that is small enough for memory and is searched best
first.  Every vector goes to its nearest list and, near a boundary, to further
lists whose distance is within a ratio.  A query reads the lists within a
ratio of its nearest (distance-ratio pruning), a share of all lists at most,
and on until they hold enough vectors.

Equal vectors are indexed once; their ids are a table beside, of which a
result can need only the ``k`` + 1 smallest (ties go to the smaller id).  There
are about 0.6 * sqrt(n) lists of n distinct vectors.  Long lists are cut into
blocks of bounded bytes, a list's queries too, and blocks meet blocks, so
nothing grows without bound in one task.

Edge cases: vectors that are null, zero, of another length than most (of
equal counts the longer),
or with null or non-finite components, and null ids, take no part; an id given
twice with the same vector counts once, and rows with the query's own id are
no candidates of it; an empty table gives no rows; a table with few vectors is
searched whole; other columns than vec_id and embedding are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import col, join_spread, map_batches, written

FIT_ROWS, LISTS_BY_ROOT, REPLICAS = 16384, 0.6, 8
#: Ratios of distances: for the lists of a vector, and for those a query reads; the share of all lists that it reads at most.
BOUNDARY, REACH, SHARE = 1.15, 1.35, 0.1


def vectors(table: DataFrame) -> DataFrame:
    """``(vec_id, packed, norm2)``: float64 bytes and squared norm of the
    vectors that take part."""
    def one(b: pa.RecordBatch):
        ids, packed, norms = [], [], []
        lists = b.column(1)
        flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null becomes NaN
        at = np.concatenate(([0], np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))).astype(np.int64)
        for i, vec_id in enumerate(b.column(0).to_pylist()):
            x = flat[at[i]:at[i + 1]]
            if vec_id is not None and len(x) and np.isfinite(x).all() and x.any():
                ids.append(vec_id)
                packed.append((x + 0.0).tobytes())
                norms.append(float(x @ x))
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(packed, pa.binary()), pa.array(norms, pa.float64())], ["vec_id", "packed", "norm2"])

    src = table.select(col("vec_id").cast("long").alias("vec_id"), col("embedding").cast("array<double>").alias("embedding"))
    return map_batches(src, one, "vec_id long, packed binary, norm2 double")


def halves(x: np.ndarray, lists: int) -> np.ndarray:
    """``lists`` centroids (a power of two at most the rows) by median splits
    along the axis between two means, then four rounds of means."""
    groups = [x]
    while len(groups) < lists:
        out = []
        for g in groups:
            a, b = g[0], g[np.argmax(((g - g[0]) ** 2).sum(1))]
            for _ in range(4):
                near = ((g - a) ** 2).sum(1) <= ((g - b) ** 2).sum(1)
                if near.all() or not near.any():
                    break
                a, b = g[near].mean(0), g[~near].mean(0)
            order = np.argsort(g @ (b - a), kind="stable")
            out += [g[order[:len(g) // 2]], g[order[len(g) // 2:]]]
        groups = out
    c = np.array([g.mean(0) for g in groups])
    for _ in range(4):
        near = ((c ** 2).sum(1) - 2 * x @ c.T).argmin(1)
        many = np.bincount(near, minlength=lists)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        c = np.where(many[:, None] > 0, sums / np.maximum(many, 1)[:, None], c)
    return c


class Graph:
    """Centroids and their nearest-neighbour graph."""

    def __init__(self, centroids: np.ndarray, degree: int = 24):
        self.c, self.sq = centroids, (centroids ** 2).sum(1)
        d = self.sq[:, None] + self.sq[None, :] - 2 * centroids @ centroids.T
        np.fill_diagonal(d, np.inf)
        n = len(centroids)
        self.near = np.argsort(d, axis=1, kind="stable")[:, :max(1, min(degree, n - 1))] if n > 1 else np.zeros((1, 1), np.int64)
        self.entry = np.unique(np.linspace(0, n - 1, min(n, 32)).astype(np.int64))

    def distances(self, x: np.ndarray, sq: np.ndarray, at: np.ndarray) -> np.ndarray:
        return np.maximum(sq[:, None] + self.sq[at] - 2 * np.einsum("ij,ikj->ik", x, self.c[at]), 0)

    def search(self, x: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
        """The nearest centroids found of each row, nearest first, and the
        distances: best-first search, ``want`` expansions after the entries."""
        n, k = len(x), len(self.c)
        want = min(want, k)
        sq, rows = (x ** 2).sum(1), np.arange(n)
        dist = np.full((n, k), np.inf)
        dist[:, self.entry] = self.distances(x, sq, np.broadcast_to(self.entry, (n, len(self.entry))))
        todo = dist.copy()
        for _ in range(want + 8):
            best = todo.argmin(1)
            todo[rows, best] = np.inf
            at = self.near[best]
            fresh = np.isinf(dist[rows[:, None], at])
            d = self.distances(x, sq, at)
            r, j = np.nonzero(fresh)
            dist[r, at[r, j]] = d[r, j]
            todo[r, at[r, j]] = d[r, j]
        order = np.argsort(dist, axis=1, kind="stable")[:, :want]
        return order, np.sqrt(dist[rows[:, None], order])


def _augmented(packed: list[bytes], largest: float) -> np.ndarray:
    x = np.array([np.frombuffer(p) for p in packed])
    return np.hstack([x, np.sqrt(np.maximum(largest - (x ** 2).sum(1), 0))[:, None]])


def search(table: DataFrame, k: int = 20, every: int = 20, fit_rows: int = FIT_ROWS, lists_by_root: float = LISTS_BY_ROOT, replicas: int = REPLICAS,
           boundary: float = BOUNDARY, reach: float = REACH, share: float = SHARE, block_bytes: int = 1 << 21) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose id is divisible
    by ``every`` its ``k`` nearest found."""
    spark = table.sparkSession
    v = vectors(table)
    v = v.select("vec_id", "packed", "norm2", F.xxhash64("packed").alias("h1"), F.xxhash64("packed", F.lit(1)).alias("h2"))
    v = written(v, "vectors")
    lengths = v.groupBy(F.octet_length("packed").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    result = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], result)
    length = lengths["n"]
    v = v.filter(F.octet_length("packed") == length)
    # equal vectors: one row, and the smallest ids (first within salts, then of all)
    ids = v.select("h1", "h2", "vec_id").distinct().withColumn("s", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(256)))
    for by in (["h1", "h2", "s"], ["h1", "h2"]):
        ids = ids.withColumn("r", F.row_number().over(W.partitionBy(*by).orderBy("vec_id"))).filter(F.col("r") <= k + 1)
    ids = written(ids.groupBy("h1", "h2").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")), "ids")
    distinct = v.groupBy("h1", "h2").agg(F.first("packed").alias("packed"), F.max("norm2").alias("norm2"), F.min("vec_id").alias("least"))
    distinct = written(distinct, "distinct")
    n, largest = distinct.agg(F.count(F.lit(1)), F.max("norm2")).first()
    sample = distinct.orderBy(F.xxhash64("h1", "h2"), "h1", "h2").limit(fit_rows).select("packed").collect()
    lists, block = 1, max(64, block_bytes // length)
    while lists * 2 <= 1.42 * lists_by_root * np.sqrt(n) and lists * 16 <= len(sample):
        lists *= 2
    graph = spark.sparkContext.broadcast(Graph(halves(_augmented([r[0] for r in sample], largest), lists)))

    def assign(b: pa.RecordBatch):
        g = graph.value
        for i in range(0, b.num_rows, 512):
            part = b.slice(i, 512)
            x = _augmented(part.column(2).to_pylist(), largest)
            order, d = g.search(x, replicas)
            r, j = np.nonzero(d <= boundary * d[:, :1] + 1e-12)
            out = part.take(pa.array(r))
            yield pa.RecordBatch.from_arrays([out.column(0), out.column(1), out.column(2), out.column(3), pa.array(order[r, j], pa.int32())], ["h1", "h2", "packed", "least", "list"])

    postings = map_batches(distinct.select("h1", "h2", "packed", "least"), assign, "h1 long, h2 long, packed binary, least long, list int")
    postings = written(postings, "postings")
    counts = {r["list"]: r["count"] for r in postings.groupBy("list").count().collect()}  # as many as lists
    sizes = np.array([counts.get(i, 0) for i in range(lists)])

    def route(b: pa.RecordBatch):
        g = graph.value
        for i in range(0, b.num_rows, 512):
            part = b.slice(i, 512)
            x = np.array([np.frombuffer(p) for p in part.column(1).to_pylist()])
            # a query's direction counts, not its length: as long as the longest, it lies among the vectors
            x = np.hstack([x * np.sqrt(largest / (x ** 2).sum(1))[:, None], np.zeros((len(x), 1))])
            order, d = g.search(x, max(8, round(share * lists)))
            held = np.cumsum(sizes[order], axis=1) - sizes[order]
            r, j = np.nonzero((d <= reach * d[:, :1] + 1e-12) | (held < 4 * replicas * (k + 1)))
            out = part.take(pa.array(r))
            yield pa.RecordBatch.from_arrays([out.column(0), out.column(1), pa.array(order[r, j], pa.int32())], ["query_id", "packed", "list"])

    queries = v.filter(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "packed").dropDuplicates(["query_id", "packed"])
    routed = written(map_batches(queries, route, "query_id long, packed binary, list int"), "routed")
    asked = {r["list"]: r["count"] for r in routed.groupBy("list").count().collect()}
    cuts = lambda held, per: F.element_at(F.array(*[F.lit(1 + held.get(i, 0) // per) for i in range(lists)]), F.col("list") + 1)
    p = postings.withColumn("block", F.pmod(F.xxhash64("h1", "h2", F.lit(5)), cuts(counts, block)))
    p = p.groupBy("list", "block").agg(F.collect_list(F.struct("h1", "h2", "least", "packed")).alias("held"))
    q = routed.withColumn("part", F.pmod(F.xxhash64("query_id", F.lit(5)), cuts(asked, block // 4)))
    q = q.groupBy("list", "part").agg(F.collect_list(F.struct("query_id", "packed")).alias("asked"))

    def scored(b: pa.RecordBatch):
        for held, ask in zip(b.column(0), b.column(1)):
            h, a = held.values, ask.values
            x = np.frombuffer(b"".join(h.field("packed").to_pylist())).reshape(len(h), -1)
            y = np.frombuffer(b"".join(a.field("packed").to_pylist())).reshape(len(a), -1)
            h1, h2, least, qid = (f.to_numpy() for f in (h.field("h1"), h.field("h2"), h.field("least"), a.field("query_id")))
            s = y @ x.T
            top = np.lexsort((np.broadcast_to(least, s.shape), -s), axis=1)[:, :k + 1]
            r = np.repeat(np.arange(len(y)), top.shape[1])
            c = top.ravel()
            yield pa.RecordBatch.from_arrays([pa.array(qid[r]), pa.array(h1[c]), pa.array(h2[c]), pa.array(s[r, c])], ["query_id", "h1", "h2", "score"])

    met = p.join(q, "list").select("held", "asked").repartition(F.xxhash64("held.h1", "asked.query_id"))
    found = written(map_batches(met, scored, "query_id long, h1 long, h2 long, score double"), "found")
    found = found.groupBy("query_id", "h1", "h2").agg(F.max("score").alias("score"))
    best = W.partitionBy("query_id").orderBy(F.desc("score"))
    found = found.withColumn("r", F.rank().over(best)).filter(F.col("r") <= k + 1).drop("r")
    out = join_spread(written(found, "best"), ids, ["h1", "h2"], F.col("query_id")).select("query_id", "score", F.explode("ids").alias("vec_id")).filter("vec_id <> query_id")
    # an id given with several vectors counts by its nearest
    out = out.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    out = out.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))).filter(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
