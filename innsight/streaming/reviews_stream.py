"""STR6: weekly review counts over arriving review files (Structured
Streaming).

A file-source stream with an explicit schema, event time at UTC midnight of
the review date, a 7-day watermark (late rows bounded), tumbling 7-day windows
offset by 4 days so weeks run Monday-Sunday, ``update`` output mode and a
``foreachBatch`` sink that upserts the emitted windows into a Parquet table.
``trigger(availableNow=True)`` processes what has arrived and stops; the
checkpoint folder makes the query restartable after a failure.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

WEEK = "7 days"
MONDAY_OFFSET = "4 days"  # epoch day 0 is a Thursday


def land_reviews(reviews: DataFrame, folder: str) -> None:
    """Write review facts as arriving files (ordered by date)."""
    (reviews.select("listing_id", "id", "date").repartitionByRange("date")
     .write.mode("overwrite").parquet(folder))


def newest_version(spark: SparkSession, path: str, most: int | None = None) -> int | None:
    """The newest complete version in ``path`` (up to ``most``), or None."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return None
    names = [s.getPath() for s in fs.listStatus(folder)]
    done = [int(p.getName()[1:]) for p in names if fs.exists(jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return max((v for v in done if most is None or v <= most), default=None)


def weekly_counts_stream(spark: SparkSession, source: str, schema, out_path: str, checkpoint: str,
                         watermark: str = WEEK) -> None:
    stream = (spark.readStream.schema(schema).parquet(source)
              .withColumn("ts", F.timestamp_seconds(F.unix_date("date").cast("long") * 86400)))
    agg = (stream.withWatermark("ts", watermark)
           .groupBy(F.window("ts", WEEK, WEEK, MONDAY_OFFSET).alias("w"))
           .agg(F.count(F.lit(1)).alias("reviews")))

    def version(most: int) -> int | None:
        return newest_version(spark, out_path, most)

    def upsert_batch(batch: DataFrame, epoch_id: int) -> None:
        rows = batch.select(
            F.date_from_unix_date(F.floor(F.unix_seconds("w.start") / 86400).cast("int")).alias("week_start"),
            F.date_from_unix_date(F.floor(F.unix_seconds("w.end") / 86400).cast("int") - 1).alias("week_end"),
            "reviews")
        # a new version folder each batch; a replayed batch writes its own again from the one before it
        before = version(epoch_id - 1)
        if before is not None:
            current = batch.sparkSession.read.parquet(f"{out_path}/v{before}")
            rows = current.join(rows.select("week_start"), "week_start", "left_anti").unionByName(rows)
        rows.write.mode("overwrite").parquet(f"{out_path}/v{epoch_id}")

    q = (agg.writeStream.outputMode("update").foreachBatch(upsert_batch)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def weekly_review_counts(reviews: DataFrame) -> DataFrame:
    """Run the stream over ``reviews`` landed as files; return the table."""
    spark = reviews.sparkSession
    run = scratch_path(spark, f"reviews-stream-{uuid.uuid4().hex}")
    src, out, ckpt = f"{run}/source", f"{run}/weekly", f"{run}/checkpoint"
    land_reviews(reviews, src)
    schema = spark.read.parquet(src).schema
    weekly_counts_stream(spark, src, schema, out, ckpt)
    last = newest_version(spark, out)
    if last is None:
        return spark.createDataFrame([], "week_start date, week_end date, reviews long")
    return spark.read.parquet(f"{out}/v{last}")
