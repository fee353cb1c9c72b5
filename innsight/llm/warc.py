"""Content-addressed WARC archive.

An archive is two Parquet tables in one folder: ``payloads`` holds the bytes
of each distinct payload once under its SHA-256, ``records`` the exact header
block of every record with the key of its payload.  Of the pages with equal
payloads of at least ``least`` bytes, that with the largest id is a response
and the others revisit it; smaller payloads are stored once too, but each
record is a response.  On writing, equal keys are held against a second digest
and the length; on reading, every payload is hashed again.  Joins rebuild the
original records byte by byte.

A payload that a third of all pages share stays one row; its records are
spread over salts wherever they meet it.

Edge cases: a null html is an empty payload; a null page id sorts first and
is written as an empty id; pages with equal id and payload give one response
and revisits to it; a null url is an empty target; line breaks in a url are
percent-encoded, so that headers stay whole; an empty table gives an empty
archive; other columns are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import col, join_spread

REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base-32 SHA-1: 20 bits (five hexadecimal digits) at a time."""
    h = F.sha1(payload)
    quads = [F.lpad(F.conv(F.substring(h, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*quads), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def archive_path(spark: SparkSession) -> str:
    """A new folder under the one that all executors share."""
    return f"{spark.sparkContext.getCheckpointDir() or ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"


def header(page: Column, url: Column, kind: Column, digest: Column, length: Column, refers: Column, date: str) -> Column:
    """The header block of a record, up to and with its blank line."""
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit("\r\n"))
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    clean = F.replace(F.replace(F.coalesce(url, F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    revisit = kind == "revisit"
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", kind), line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), text(page), F.lit(">"))), line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", clean), F.when(revisit, F.concat(line("WARC-Profile", F.lit(REVISIT)), line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), text(refers), F.lit(">"))))).otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)), line("Content-Length", length.cast("string")), F.lit("\r\n"))


def write(pages: DataFrame, path: str, least: int = 0, date: str = "2024-01-01T00:00:00Z") -> None:
    """Write ``pages(page_id, url, html)`` as an archive at ``path``."""
    payload = F.coalesce(col("html"), F.lit("")).cast("binary")
    p = pages.select(col("page_id").cast("long").alias("page_id"), col("url").alias("url"), payload.alias("payload"))
    bytes_, sha1 = F.octet_length("payload").cast("long"), base32_sha1(F.col("payload"))
    keyed = p.select("page_id", "url", "payload", F.sha2("payload", 256).alias("key"))
    # each payload's bytes once; two payloads under one key would differ in what is held against them here
    stored = keyed.groupBy("key").agg(F.first("payload").alias("payload"), F.min(F.struct(bytes_, F.xxhash64("payload"))).alias("lo"), F.max(F.struct(bytes_, F.xxhash64("payload"))).alias("hi"))
    stored = stored.withColumn("payload", F.when(F.col("lo") == F.col("hi"), F.col("payload")).otherwise(F.raise_error(F.lit("two payloads under one digest")).cast("binary")))
    stored.select("key", "payload").write.option("compression", "zstd").parquet(f"{path}/payloads")
    slim = keyed.select("page_id", "url", "key", bytes_.alias("length"), sha1.alias("digest"))
    heads = slim.groupBy("key").agg(F.max("page_id").alias("head"))
    r = join_spread(slim, heads, ["key"], F.xxhash64("page_id", "url"))
    # of pages with the response's own id, the first by url is the response
    own = W.partitionBy("key", "page_id").orderBy("url")
    is_head = F.col("page_id").eqNullSafe(F.col("head"))
    r = r.withColumn("twin", F.row_number().over(own))
    response = (F.col("length") < least) | (is_head & (F.col("twin") == 1))
    r = r.withColumn("kind", F.when(response, "response").otherwise("revisit")).withColumn("refers", F.when(~response, F.col("head")))
    head_block = header(F.col("page_id"), F.col("url"), F.col("kind"), F.col("digest"), F.when(response, F.col("length")).otherwise(0), F.col("refers"), date)
    r.select(F.col("key"), head_block.alias("header")).write.option("compression", "zstd").parquet(f"{path}/records")


def field(header_: Column, name: str) -> Column:
    return F.regexp_extract(header_, rf"(?:^|\r\n){name}: ([^\r\n]*)\r\n", 1)


def read(spark: SparkSession, path: str, with_bytes: bool = False) -> DataFrame:
    """``(page_id, url, record_type, refers_to, payload_bytes,
    payload_digest, header[, record])`` of every record: the header fields
    parsed, the payload's figures taken from its bytes and held against its
    key and the header.  ``record`` is the whole record as a WARC file holds
    it (a revisit has no body)."""
    p = spark.read.schema("key string, payload binary").parquet(f"{path}/payloads")
    good = F.sha2("payload", 256) == F.col("key")
    p = p.select("key", F.octet_length("payload").cast("long").alias("payload_bytes"), base32_sha1(F.col("payload")).alias("payload_digest"), good.alias("good"), *["payload"] * with_bytes)
    h = spark.read.schema("key string, header string").parquet(f"{path}/records")
    r = join_spread(h, p, ["key"], F.xxhash64("header"))
    kind = field(F.col("header"), "WARC-Type")
    whole = F.col("good") & (field(F.col("header"), "WARC-Payload-Digest") == F.concat(F.lit("sha1:"), "payload_digest")) & (
        field(F.col("header"), "Content-Length").cast("long") == F.when(kind == "response", F.col("payload_bytes")).otherwise(0))
    number = lambda name: F.regexp_extract(field(F.col("header"), name), r"<urn:page:(-?\d+)>", 1)
    r = r.withColumn("kind", F.when(whole, kind).otherwise(F.raise_error(F.lit("a record does not match its payload"))))
    body = F.when(kind == "response", F.col("payload")) if with_bytes else None
    return r.select(
        F.nullif(number("WARC-Record-ID"), F.lit("")).cast("long").alias("page_id"), field(F.col("header"), "WARC-Target-URI").alias("url"), F.col("kind").alias("record_type"),
        F.nullif(number("WARC-Refers-To"), F.lit("")).cast("long").alias("refers_to"), "payload_bytes", "payload_digest", "header",
        *([F.concat(F.col("header").cast("binary"), F.coalesce(body, F.lit(b"")), F.lit(b"\r\n\r\n")).alias("record")] if with_bytes else []))
