"""Helpers shared by the training-data operators.

Conventions: input frames may carry any extra columns; helper columns get
names the frame does not use (``fresh``).  A null text counts as empty.
Intermediate tables are written into the folder all executors share
(``spark.checkpoint.dir``) as Parquet, so a lost executor costs a re-read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, ship_package

#: The white space and the words of every contract (ASCII only).
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Salts of a hot key: no task gets more than 1/256 of it.
SALTS = 256
#: A key with more than one of so many parts of the rows is hot.
SHARES = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *bases: str) -> list[str]:
    """A column name for each base that ``df`` does not have."""
    taken, out = {c.lower() for c in df.columns}, []
    for b in bases:
        name = f"_{b}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage, and
    each reader takes only the columns it needs."""
    spark = df.sparkSession
    base = spark.sparkContext.getCheckpointDir() or ensure_checkpoint_dir(spark)
    path = f"{base}/llm-{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def doc_key(doc_id: Column, text: Column) -> list[Column]:
    """128 bits of (doc_id, text).  Rows equal in both are one document to
    the operators that join decisions back by this key."""
    text = F.coalesce(text, F.lit(""))
    return [F.xxhash64(doc_id, text), F.xxhash64(text, doc_id, F.lit(1))]


def join_spread(big: DataFrame, small: DataFrame, keys: list[str], spread: Column, how: str = "inner",
                salts: int = SALTS) -> DataFrame:
    """``big`` joined to ``small`` (one row a key, none null) where some key
    may hold a third of ``big``: each row gets a salt from ``spread``, the
    (key, salt) pairs that occur get ``small``'s columns first (a key has at
    most ``salts`` of them), and the rows meet those pairs, so a hot key's
    rows are spread over ``salts`` groups and no row is copied."""
    (s,) = fresh(big, "salt")
    while s.lower() in {c.lower() for c in small.columns}:
        s += "_"
    salted = big.withColumn(s, F.pmod(F.xxhash64(spread, F.lit(7)), F.lit(salts)).cast("int"))
    pairs = salted.select(*[col(k) for k in keys], s).distinct().join(small, keys)
    return salted.join(pairs, [*keys, s], how).drop(s)


def join_counted(big: DataFrame, small: DataFrame, key: str, spread: Column) -> DataFrame:
    """``big`` joined to ``small`` (one row a key, none null; a table whose
    ``count`` is the number of ``big``'s rows with the key).  Keys with more
    than a ``SHARES``th of the joined rows (so at most SHARES of them, which are
    broadcast) get a salt from ``spread`` for each such part, SALTS at most;
    nothing else is copied or counted again."""
    salt, salts = fresh(big.join(small, key), "salt", "salts")
    share = max(1, (small.agg(F.sum("count")).first()[0] or 0) // SHARES)
    parts = F.least(F.lit(SALTS), F.ceil(F.col("count") / share)).cast("int")
    hot = small.filter(F.col("count") > share).select(key, parts.alias(salts))
    salted = big.join(F.broadcast(hot), key, "left").withColumn(salt, F.coalesce(F.pmod(F.xxhash64(spread, F.lit(7)), salts), F.lit(0)).cast("int")).drop(salts)
    pairs = small.withColumn(salt, F.explode(F.sequence(F.lit(0), parts - 1))).drop("count")
    return salted.join(pairs, [key, salt]).drop(salt)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | Iterable[pa.RecordBatch]], schema) -> DataFrame:
    """``fn`` over Arrow batches; ``fn`` gives a batch or several."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = fn(b)
            if isinstance(out, pa.RecordBatch):
                yield out
            else:
                yield from out

    return df.mapInArrow(run, schema)


def texts(column: pa.Array) -> list[bytes]:
    """The texts as bytes (null: empty)."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def least_labels(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Labels of the components of the edges (a, b) over nodes 0..n-1: the
    smallest node of each (hooking and pointer jumping)."""
    lab = np.arange(n)
    while True:
        low = np.minimum(lab[a], lab[b])
        before = lab.copy()
        np.minimum.at(lab, lab[a], low)
        np.minimum.at(lab, lab[b], low)
        while True:
            jumped = lab[lab]
            if (jumped == lab).all():
                break
            lab = jumped
        if (lab == before).all():
            return lab


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)`` (not null): ``(node,
    component)`` with the smallest node as component, for every node of an
    edge.  Large-star and small-star rounds until every node hangs on its
    component's smallest; a star's hub is spread over salts, and each round
    is a written table."""
    def star(pairs: DataFrame, both: bool) -> DataFrame:
        sym = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))) if both else pairs
        least = sym.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        at = join_spread(sym, least, ["u"], F.col("v"))
        if both:  # every larger neighbour of u goes to the least
            out = at.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:  # u and its smaller neighbours go to the least of them
            out = at.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(at.select("u", F.col("m").alias("v")))
        return out.filter("u <> v").distinct()

    pairs = written(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    while True:
        pairs = written(star(star(pairs, True), False), "stars")
        hubs = pairs.select(F.col("v").alias("u")).distinct()
        deep = pairs.select("u").distinct().join(hubs, "u")
        twice = pairs.groupBy("u").count().filter("count > 1").select("u")
        if deep.union(twice).isEmpty():
            break
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
