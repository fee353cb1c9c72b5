"""Session helpers: building a session for tests/bench and finding the shared
checkpoint folder.

On a cluster the session is created by the platform; library code only reads
settings from it.  ``checkpoint_dir`` returns the folder named in
``spark.checkpoint.dir`` and falls back to a scratch folder only when the
setting is absent (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Of the tables written between steps: they are wide and full of text, so what is written counts more than packing it.
LAYER_CODEC = "zstd"
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "innsight", extra: dict | None = None) -> SparkSession:
    """A local session for tests and the bench (never used on a cluster)."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g"))
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder: the context's, else the one that
    ``spark.checkpoint.dir`` names, else (on a local master only) a scratch
    folder."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            d = tempfile.mkdtemp(prefix="innsight-ckpt-")
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediate
    tables (never a machine-local temp folder on a cluster)."""
    return os.path.join(ensure_checkpoint_dir(spark), name)


#: The longest method, in bytes of bytecode, that the JVM compiles; a longer one it interprets, however often it runs.
LONGEST_COMPILED = 8000
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


@contextmanager
def compiled(spark: SparkSession):
    """What runs inside does so in methods that the JVM compiles: a stage of
    wide expressions that would be one longer method goes operator by operator,
    whose code Spark cuts into short ones.  A limit that the session sets
    itself stays."""
    if spark.conf.get(_METHOD_LIMIT, None) is not None:
        yield
        return
    spark.conf.set(_METHOD_LIMIT, str(LONGEST_COMPILED))
    try:
        yield
    finally:
        spark.conf.unset(_METHOD_LIMIT)


def materialize(df, path: str | None = None):
    """Cut lineage: a Parquet table in the shared checkpoint folder, or one at
    ``path`` in place of what is there.

    Used where one intermediate feeds several branches (value-count tables,
    Silver/Gold layers) so the branches read files instead of recomputing the
    whole upstream plan, prune columns and push filters down; survives executor
    loss."""
    fresh = path is None
    path = path or scratch_path(df.sparkSession, f"table-{uuid.uuid4().hex}")
    with compiled(df.sparkSession):
        df.write.mode("errorifexists" if fresh else "overwrite").parquet(path, compression=LAYER_CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df, key: str, counted=None, buckets: int | None = None, path: str | None = None, seen=None):
    """``df`` as a Parquet table in the shared folder, hashed by ``key`` into
    as many buckets as there are shuffle partitions and sorted by it, so that
    joins and groupings of such tables by the key need no exchange.

    A key that alone holds more than two buckets' share of the rows would
    make one long bucket; then the table is written as it comes, and what
    reads it shuffles as usual.  ``counted`` is a cheaper frame with the same
    keys (``df``'s rows or more); ``seen``, if given, is called with its number
    of rows, which is known then.  ``path``: as of ``materialize``."""
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    with compiled(spark):
        most, rows = (df if counted is None else counted).groupBy(f"`{key}`").count().selectExpr("max(count)", "sum(count)").first()
    if seen is not None:
        seen(rows or 0)
    if rows and most > max(2 * rows / n, 10_000):
        return materialize(df, path)
    name = f"innsight_{uuid.uuid4().hex}"
    out = df.repartition(n, df[key]).write.format("parquet").bucketBy(n, key).sortBy(key).option("compression", LAYER_CODEC)
    if path:
        out = out.mode("overwrite")
    with compiled(spark):
        out.option("path", path or scratch_path(spark, name)).saveAsTable(name)
    return spark.table(name)


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``innsight`` importable in Python workers (pandas UDFs) however
    the driver was started: zip the package once per SparkContext and
    ``addPyFile`` it (Spark distributes it to every executor).  On a cluster
    submitted with ``--py-files`` this is a no-op in effect."""
    sc = spark.sparkContext
    if id(sc) in _SHIPPED:
        return
    import zipfile

    import innsight
    pkg = os.path.dirname(os.path.abspath(innsight.__file__))
    root = os.path.dirname(pkg)
    fd, path = tempfile.mkstemp(prefix="innsight-", suffix=".zip")  # code package on the driver
    os.close(fd)
    with zipfile.ZipFile(path, "w") as z:
        for dirpath, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(id(sc))
