"""Committed loads (STR1, STR2, STR3, SRC12, STR6): a table in a folder whose
content is what its newest manifest names.

A load writes its files first, into a folder of its own, and then commits: a
new manifest, written aside and renamed into place, names the load, the folders
that now make up the table, and the high-water mark.  A load that dies before
its commit leaves nothing that readers see, and run again it overwrites its own
folder; a load that is run again after its commit does nothing.  Of two writers
that commit the same version one fails.  Folders that neither the newest nor
the manifest before it names are deleted after a commit.

``append`` adds facts, partitioned as asked.  ``upsert`` keeps one row a key in
hash buckets, of each the newest by ``newest`` (of equals the largest row hash),
and rewrites only the buckets that a batch touches.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .incremental import newer_than

BUCKETS = 32


class CommittedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        jvm = spark.sparkContext._jvm
        self._p = lambda *parts: jvm.org.apache.hadoop.fs.Path("/".join([path, *parts]))
        self._fs = self._p().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # manifests
    def version(self) -> int:
        """The newest version, -1 for a table without a commit."""
        folder = self._p("_manifests")
        if not self._fs.exists(folder):
            return -1
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return max((int(n[1:-5]) for n in names if n.startswith("v") and n.endswith(".json")), default=-1)

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if version < 0:
            return {"version": -1, "loads": [], "folders": {}, "mark": None}
        text = self.spark.read.text(f"{self.path}/_manifests/v{version}.json", wholetext=True).first()[0]
        return json.loads(text)

    def _commit(self, before: dict, load: str, folders: dict[str, str], mark: str | None) -> None:
        new = {"version": before["version"] + 1, "loads": [*before["loads"], load], "folders": folders, "mark": mark}
        aside, place = self._p("_manifests", f".{load}.json"), self._p("_manifests", f"v{new['version']}.json")
        out = self._fs.create(aside, True)
        out.write(bytearray(json.dumps(new).encode()))
        out.close()
        if self._fs.exists(place) or not self._fs.rename(aside, place):
            raise RuntimeError(f"another writer committed version {new['version']} of {self.path}")
        named = {f.split("/")[0] for m in (new, before) for f in m["folders"].values()}
        for s in self._fs.listStatus(self._p("data")):
            if s.getPath().getName() not in named:
                self._fs.delete(s.getPath(), True)

    # reading
    def mark(self) -> str | None:
        """STR1: the stored high-water mark, as text."""
        return self.manifest()["mark"]

    def newer(self, df: DataFrame, col: str) -> DataFrame:
        """STR1: ``df``'s rows beyond the stored mark."""
        mark = self.mark()
        return newer_than(df, col, None if mark is None else F.lit(mark).cast(df.schema[col].dataType))

    def read(self, schema) -> DataFrame:
        """The committed rows, in the columns of ``schema``."""
        return self._read(self.manifest()["folders"].values(), schema)

    def _read(self, folders, schema) -> DataFrame:
        schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        parts = [self.spark.read.option("basePath", f"{self.path}/data/{f.split('/')[0]}").schema(schema).parquet(f"{self.path}/data/{f}").select(schema.names) for f in folders]
        out = self.spark.createDataFrame([], schema)
        return out if not parts else parts[0] if len(parts) == 1 else _union(parts)

    # loads
    def append(self, df: DataFrame, load: str, partition_by: list[str] | None = None, mark_col: str | None = None) -> bool:
        """STR3 / SRC12: the load's facts, once however often it is run;
        False if it was committed before."""
        before = self.manifest()
        if load in before["loads"]:
            return False
        mark = self._write(df, load, partition_by or [], mark_col)
        self._commit(before, load, {**before["folders"], load: load}, _later(before["mark"], mark))
        return True

    def upsert(self, batch: DataFrame, load: str, key: str, newest: str, buckets: int = BUCKETS) -> bool:
        """STR2: one row a key, the newest of the table's and the batch's."""
        before = self.manifest()
        if load in before["loads"]:
            return False
        bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")
        batch = newest_of(batch, key, newest).withColumn("_bucket", bucket)
        touched = [r[0] for r in batch.select("_bucket").distinct().collect()]  # at most ``buckets``
        held = [before["folders"][str(b)] for b in touched if str(b) in before["folders"]]
        schema = batch.drop("_bucket").schema
        current = self._read(held, schema).withColumn("_bucket", bucket)
        mark = self._write(newest_of(current.unionByName(batch), key, newest), load, ["_bucket"], newest)
        self._commit(before, load, {**before["folders"], **{str(b): f"{load}/_bucket={b}" for b in touched}}, _later(before["mark"], mark))
        return True

    def _write(self, df: DataFrame, load: str, partition_by: list[str], mark_col: str | None) -> str | None:
        obs = Observation()
        seen = df.observe(obs, F.max(F.col(mark_col)).cast("string").alias("mark")) if mark_col else df
        seen.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{self.path}/data/{load}")
        return obs.get["mark"] if mark_col else None


def _later(a: str | None, b: str | None) -> str | None:
    """The later of two marks (dates and timestamps compare as text)."""
    return max((x for x in (a, b) if x is not None), default=None)


def _union(parts: list[DataFrame]) -> DataFrame:
    while len(parts) > 1:
        parts = [a.unionByName(b) for a, b in zip(parts[::2], parts[1::2])] + parts[len(parts) & ~1:]
    return parts[0]


def newest_of(df: DataFrame, key: str, newest: str) -> DataFrame:
    """Of rows with one key the one with the latest ``newest`` (null first),
    of equals the one with the largest row hash."""
    row = F.struct(*[F.col(c) for c in df.columns])
    order = F.struct(F.col(newest), F.xxhash64(F.to_json(F.struct(*[F.col(c) for c in df.columns if not c.startswith("_")]))))
    return df.groupBy(F.col(key).alias("_key")).agg(F.max_by(row, order).alias("_row")).select("_row.*")


# ---------------------------------------------------------------- streams
def _run(stream: DataFrame, batch: Callable[[DataFrame, int], None], checkpoint: str) -> list[dict]:
    """What has arrived, then stop; the progress of the batches.  A batch is
    kept while it is worked on, so its files are read (and counted) once."""
    def once(rows: DataFrame, epoch: int) -> None:
        rows = rows.persist()
        try:
            batch(rows, epoch)
        finally:
            rows.unpersist()

    q = stream.writeStream.foreachBatch(once).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return [p for p in q.recentProgress if p["numInputRows"]]


def upsert_stream(stream: DataFrame, table: CommittedTable, checkpoint: str, key: str, newest: str, buckets: int = BUCKETS) -> list[dict]:
    """STR2 in a stream: every batch is a committed load named by its number,
    so a batch that is replayed after a failure changes nothing twice, and a
    row that arrives late does not replace a newer one."""
    return _run(stream, lambda batch, epoch: table.upsert(batch, f"batch-{epoch}", key, newest, buckets), checkpoint)


def counts_with_late_rows(stream: DataFrame, event: str, window_of: Callable[[Column], Column], delay_days: int, counts: CommittedTable, late: CommittedTable, checkpoint: str) -> list[dict]:
    """STR6 with its late rows kept: rows by window, where a row whose window
    ended ``delay_days`` or more before the latest event of earlier batches is
    late.  Late rows go to ``late`` with their batch number, the others are
    added to ``counts`` ``(window_start, window_end, rows, batch)``; rows
    without a date are late.  ``window_of`` gives a struct(start, end) of dates."""
    def batch(rows: DataFrame, epoch: int) -> None:
        load = f"batch-{epoch}"
        seen = counts.manifest()
        # a replay takes the mark that the batch had the first time
        mark = counts.manifest(seen["loads"].index(load) - 1)["mark"] if load in seen["loads"] else seen["mark"]
        w = window_of(F.col(event))
        line = F.lit(mark).cast("date") - F.lit(delay_days)
        kept = rows.withColumn("_w", w).withColumn("_late", F.coalesce((F.col("_w.end") < line) if mark else F.lit(False), F.lit(False)) | F.col(event).isNull())
        late.append(kept.where("_late").drop("_w", "_late").withColumn("batch", F.lit(epoch).cast("long")), load)
        done = kept.where("not _late").groupBy("_w").agg(F.count(F.lit(1)).alias("rows"), F.max(event).alias("_latest"))
        counts.append(done.select(F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), "rows", F.lit(epoch).cast("long").alias("batch"), "_latest"), load, mark_col="_latest")

    return _run(stream, batch, checkpoint)


COUNTS = "window_start date, window_end date, rows long, batch long"


def monday_week(day: Column) -> Column:
    """The Monday-Sunday week of a date."""
    start = F.date_trunc("week", day).cast("date")
    return F.struct(start.alias("start"), F.date_add(start, 6).alias("end"))
