"""Bounded-space best-fit packing of token sequences.

A document's ids and an end id are cut into pieces that fit a sequence (only
documents longer than one; the first piece takes the remainder, so all others
are full).  Pieces go, largest first within a task, to the open bin with the
least free space that holds them; bins hang on a bitset keyed by free space,
a fixed number is open, and the fullest closes when one more is needed.  The
tasks' share of the pieces is set by the bins they may open, so that a task
rarely closes a bin early.  Bins that stay underfull are packed again as
items, in fewer tasks; then a join places the pieces.

With an ``order`` column (a position in training) tasks take ranges of it,
pieces go in its order, only a few hundred at a time are sorted by length, and
few bins are open, so that a sequence holds neighbours; a sequence stands at
the least position of its pieces.  Null positions come first.

Ids are those of the tokenizer file (a byte-level BPE with a GPT-2 style
pattern), special strings in a text included.  They are computed by tiktoken
from that file's own vocabulary, five times as fast as by the tokenizers
library with equal ids (a test holds one against the other); ``library=True``
uses the tokenizers library itself.

Edge cases: a null or empty text gives one piece of the end id alone; equal
rows and equal ids are packed apart; an empty table gives no pieces; other
columns are not read.
"""

from __future__ import annotations

import json
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import col, map_batches, texts, written

OPEN_BINS = 4096
#: Pieces sorted by length at a time, and open bins, where an order is kept.
ORDERED_PIECES, ORDERED_BINS = 512, 256


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins of byte-level BPE: printable Latin-1 bytes are
    themselves, the others follow from 256 on in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def encoder(path: str, library: bool = False):
    """A function of texts to lists of ids."""
    if library:
        from tokenizers import Tokenizer
        t = Tokenizer.from_file(path)
        return lambda text: t.encode(text, add_special_tokens=False).ids
    import public_tokenizers
    import tiktoken
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {x["content"]: x["id"] for x in spec["added_tokens"]}
    alphabet = byte_alphabet()
    ranks = {bytes(alphabet[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in special}
    enc = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: enc.encode(text, allowed_special="all")


def pieces(docs: DataFrame, size: int = 2048, end_id: int = 0, vocabulary: str | None = None, with_ids: bool = True, library: bool = False,
           order: str | None = None) -> DataFrame:
    """``(uid, doc_id, piece, start, length, ids_crc32[, ids][, position])``."""
    path = vocabulary or default_vocabulary()
    kinds = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    kinds += [("ids", pa.list_(pa.int32()))] * with_ids
    kinds += [("position", pa.float64())] * bool(order)

    def one(b: pa.RecordBatch):
        encode = encoder(path, library)
        out = [[] for _ in kinds]
        at = [[x] for x in b.column(2).to_pylist()] if order else [[]] * b.num_rows
        for doc, text, position in zip(b.column(0).to_pylist(), texts(b.column(1)), at):
            ids = np.array([*encode(text.decode("utf-8", "replace")), end_id], "<u4")
            first = (len(ids) - 1) % size + 1
            cuts = [0, *range(first, len(ids) + 1, size)]
            for i, (a, z) in enumerate(zip(cuts, cuts[1:])):
                row = [doc, i, a, z - a, zlib.crc32(ids[a:z].tobytes())] + [ids[a:z].astype(np.int32)] * with_ids + position
                for o, v in zip(out, row):
                    o.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(o, k) for o, (_, k) in zip(out, kinds)], [n for n, _ in kinds])

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids + ", position double" * bool(order)
    positions = [col(order).cast("double").alias("position")] if order else []
    made = map_batches(docs.select(col("doc_id").cast("long").alias("doc_id"), col("text").alias("text"), *positions), one, schema)
    return made.withColumn("uid", F.monotonically_increasing_id())


class Bins:
    """Open bins by free space: a stack for each, and a bitset of those that
    are not empty."""

    def __init__(self, size: int, limit: int):
        self.size, self.limit, self.set, self.open = size, limit, 0, 0
        self.stacks: list[list[int]] = [[] for _ in range(size + 1)]
        self.made = 0

    def put(self, length: int) -> tuple[int, int]:
        """The bin and the offset of an item."""
        above = self.set >> length
        if above:
            free = (above & -above).bit_length() - 1 + length
            own = self.stacks[free].pop()
            if not self.stacks[free]:
                self.set ^= 1 << free
        else:
            if self.open == self.limit:
                low = (self.set & -self.set).bit_length() - 1
                self.stacks[low].pop()
                if not self.stacks[low]:
                    self.set ^= 1 << low
                self.open -= 1
            own, free = self.made, self.size
            self.made += 1
            self.open += 1
        left = free - length
        if left:
            self.stacks[left].append(own)
            self.set |= 1 << left
        else:
            self.open -= 1
        return own, self.size - free

    def rest(self):
        return [(b, self.size - free) for free, stack in enumerate(self.stacks) for b in stack]


def fill(items: DataFrame, tasks: int, size: int, limit: int, order: str | None = None) -> DataFrame:
    """``items(uid, length)`` to ``(uid, bin, offset, used)``: a row for each
    item, and for each bin a row without ``uid`` that says how much it holds.
    With ``order`` tasks take ranges of that column; if there is a position,
    its order is kept but for ``ORDERED_PIECES`` at a time."""
    kept = order == "position"

    def run(batches):
        bins, base = Bins(size, limit), TaskContext.get().partitionId() << 40
        if kept:
            batches = (b.slice(i, ORDERED_PIECES) for b in batches for i in range(0, b.num_rows, ORDERED_PIECES))
            batches = (b.sort_by([("length", "descending")]) for b in batches)
        for b in batches:
            own, offsets = [], []
            for n in b.column(1).to_pylist():
                i, at = bins.put(n)
                own.append(base + i)
                offsets.append(at)
            k = len(own)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(own, pa.int64()), pa.array(offsets, pa.int64()), pa.nulls(k, pa.int64())], ["uid", "bin", "offset", "used"])
        left = bins.rest()
        yield pa.RecordBatch.from_arrays([pa.nulls(len(left), pa.int64()), pa.array([base + i for i, _ in left], pa.int64()), pa.nulls(len(left), pa.int64()), pa.array([u for _, u in left], pa.int64())], ["uid", "bin", "offset", "used"])

    if kept:
        spread = items.select("uid", "length", "position").repartitionByRange(tasks, "position", "uid").sortWithinPartitions("position", "uid")
    else:
        spread = items.select("uid", "length").repartition(tasks, "uid") if order is None else items.select("uid", "length").repartitionByRange(tasks, order)
        spread = spread.sortWithinPartitions(F.desc("length"), "uid")
    return spread.mapInArrow(run, "uid long, bin long, offset long, used long")


def pack(docs: DataFrame, size: int = 2048, end_id: int = 0, vocabulary: str | None = None, open_bins: int = OPEN_BINS, with_ids: bool = True, library: bool = False,
         order: str | None = None) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids], sequence_id,
    offset[, position])``, a row for each piece; with ``order`` sorted by the
    position of the sequence."""
    made = written(pieces(docs, size, end_id, vocabulary, with_ids, library, order), "pieces")
    # full pieces are sequences by themselves
    part = made.filter(F.col("length") < size)
    tokens = part.agg(F.sum("length")).first()[0] or 0
    tasks = 1 + int(tokens / (0.9 * size * open_bins))
    first = written(fill(part, tasks, size, min(open_bins, ORDERED_BINS), "position") if order else fill(part, tasks, size, open_bins), "bins")
    under = first.filter("used is not null").select(F.col("bin").alias("uid"), F.col("used").alias("length"))
    second = written(fill(under, 1 + tasks // 16, size, open_bins, "uid" if order else None).filter("uid is not null").drop("used"), "merged")
    second = second.select(F.col("uid").alias("bin"), F.col("bin").alias("merged"), F.col("offset").alias("base"))
    placed = first.filter("uid is not null").drop("used").join(second, "bin", "left")
    merged = F.col("merged").isNotNull()
    # three ranges of ids: merged bins, bins left as they are, full pieces
    placed = placed.select("uid", F.when(merged, F.col("merged") * 4).otherwise(F.col("bin") * 4 + 1).alias("sequence_id"), (F.col("offset") + F.coalesce("base", F.lit(0))).alias("offset"))
    out = made.join(placed, "uid", "left")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * with_ids,
               F.coalesce("sequence_id", F.col("uid") * 4 + 2).alias("sequence_id"), F.coalesce("offset", F.lit(0)).cast("long").alias("offset")]
    if not order:
        return out.select(*columns)
    # a sequence has no more pieces than tokens
    at = placed.join(part.select("uid", "position"), "uid").select("uid", F.min("position").over(W.partitionBy("sequence_id")).alias("first"))
    out = out.join(at, "uid", "left").select(*columns, F.coalesce("first", "position").alias("position"))
    return out.orderBy("position", "sequence_id", "offset")
