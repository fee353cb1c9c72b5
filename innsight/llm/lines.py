"""Line dedup by winnowing over line hashes.

A text's lines (``\\n``-split, white space at both ends ignored, blank lines
skipped) are hashed.  Each run of ``RUN`` = 2 lines is a window; the smaller
of its line hashes is the window's fingerprint, so any repeated run of two
lines or more shares a fingerprint at the same place in both (the winnowing
guarantee).  A line of ``LONG`` words or more is a run by itself.
Fingerprints that occur at one place only drop out; around the others the
runs themselves are compared: a run that occurred at an earlier place goes.
Adjacent deleted runs merge, which extends a match both ways to its full
length.  Earlier means by (doc_id, null last; text key; line).

Nothing is paired with all its equals: each run meets only the first of its
kind, and a run that a third of all documents hold is spread over salts.

Edge cases: null and empty texts have no lines and stay; rows equal in doc_id
and text are one document and get the same text; texts that lose every line
become empty (``dedup`` drops them on request); an empty table gives an empty
result; other columns are carried along.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, doc_key, fresh, join_spread, map_batches, texts, written

RUN, LONG = 2, 30
_GRAMS = "k1 long, k2 long, doc_id long, gram long, fp long, at int, first int, last int"


def _windows(long_words: int):
    """Each window of two lines, and each long line: its hash, fingerprint,
    the line of the fingerprint, its first and last line."""
    h64 = xxhash.xxh3_64_intdigest
    signed = lambda x: x - (1 << 64) if x >= 1 << 63 else x

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = [[] for _ in range(8)]
        cols = [b.column(i).to_pylist() for i in range(3)]
        for k1, k2, doc, text in zip(*cols, texts(b.column(3))):
            lines = [(i, s) for i, x in enumerate(text.split(b"\n")) if (s := x.strip(b" \t\n\r\x0b\x0c"))]
            hashes = [h64(s) for _, s in lines]
            out = [(h64(s, 1), h, i, i, i) for (i, s), h in zip(lines, hashes) if len(s.split()) >= long_words]
            for j in range(len(lines) - 1):
                (i, _), (m, _) = lines[j], lines[j + 1]
                a, c = hashes[j], hashes[j + 1]
                out.append((h64(a.to_bytes(8) + c.to_bytes(8), 2), min(a, c), i if a < c else m, i, m))
            for g, f, at, i, m in out:
                for r, v in zip(rows, (k1, k2, doc, signed(g), signed(f), at, i, m)):
                    r.append(v)
        kinds = [pa.int64()] * 5 + [pa.int32()] * 3
        return pa.RecordBatch.from_arrays([pa.array(r, k) for r, k in zip(rows, kinds)], ["k1", "k2", "doc_id", "gram", "fp", "at", "first", "last"])

    return one


def repeats(docs: DataFrame, long_words: int = LONG) -> DataFrame:
    """``(k1, k2, gone)``: for each document that loses lines, the numbers of
    the lines that go, in order."""
    k = doc_key(col("doc_id"), col("text"))
    src = docs.select(k[0].alias("k1"), k[1].alias("k2"), col("doc_id").cast("long").alias("doc_id"), col("text").alias("text"))
    grams = written(map_batches(src, _windows(long_words), _GRAMS), "grams")
    # fingerprints that occur at two places or more
    places = grams.groupBy("fp").agg(F.min(F.struct("k1", "k2", "at")).alias("a"), F.max(F.struct("k1", "k2", "at")).alias("z"))
    grams = join_spread(grams, places.filter("a <> z").select("fp"), ["fp"], F.col("k1"))
    grams = written(grams, "candidates")
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "k1", "k2", F.col("first").alias("i"))
    firsts = grams.groupBy("gram").agg(F.min(order).alias("head"), F.max(order).alias("tail")).filter("head <> tail").drop("tail")
    later = join_spread(grams, firsts, ["gram"], F.xxhash64("k1", "first")).filter(order != F.col("head"))
    return later.groupBy("k1", "k2").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.sequence("first", "last"))))).alias("gone"))


def dedup(docs: DataFrame, long_words: int = LONG, drop_emptied: bool = False, marks: bool = False) -> DataFrame:
    """``docs`` with the later repeated runs deleted from ``text`` (and
    ``n_chars`` brought up to date if there is one).  ``marks`` adds
    ``n_lines`` (lines with a word) and ``gone`` (numbers of the deleted
    lines); ``drop_emptied`` leaves out documents that lost every line."""
    k1, k2, gone, rest = fresh(docs, "k1", "k2", "gone", "rest")
    k = doc_key(col("doc_id"), col("text"))
    found = repeats(docs, long_words).select(F.col("k1").alias(k1), F.col("k2").alias(k2), F.col("gone").alias(gone))
    d = docs.withColumn(k1, k[0]).withColumn(k2, k[1]).join(found, [k1, k2], "left")
    left = F.array_join(F.filter(F.split(col("text"), "\n"), lambda x, i: ~F.array_contains(col(gone), i)), "\n")
    d = d.withColumn(rest, F.when(col(gone).isNull(), col("text")).otherwise(left))
    if drop_emptied:
        d = d.filter(col(gone).isNull() | col(rest).rlike(r"[^\x20\x09-\x0D]"))
    d_cols = [F.col(f"`{rest}`").alias(c) if c == "text" else F.length(col(rest)).cast(t).alias(c) if c == "n_chars" else col(c) for c, t in docs.dtypes]
    if not marks:
        return d.select(*d_cols)
    lines = F.size(F.filter(F.split(F.coalesce(col("text"), F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    return d.select(*d_cols, lines.cast("long").alias("n_lines"), F.coalesce(col(gone), F.array().cast("array<int>")).alias("gone"))
