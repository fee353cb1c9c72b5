"""Cross-tokenizer alignment with inverted pair bitmaps.

Tokenizers A (byte-level BPE) and B (pieces with byte fallback) cut the same
bytes.  Byte offsets where tokens of both end cut a text into groups; an A and
a B token whose byte ranges overlap are linked.  Corpus-wide, a pair of ids
has the documents in which it is linked as a compressed bitmap: documents are
numbered within chunks of ``CHUNK``, and a pair's container for a chunk is the
sorted 16-bit numbers, or the chunk's bits where that is smaller.  Beside it
multiplicity planes: plane j holds the documents whose number of links less
one has bit j, so a pair's links are its documents' popcount plus 2^j times
that of each plane.  Slices of a chunk are OR-merged in the task that reads
them; the chunks of a pair share no document, so the popcount of their union
is the sum of theirs, which one aggregation takes.

Then the bitmaps are read the other way: a chunk's containers meet the counts
of their pairs, and every posting returns its pair's score (the count, and
whether it is its A id's highest) to the document, times its multiplicity.
Nothing but containers, counts by (chunk, pair) and documents' figures is
shuffled; a pair in a third of all documents is one row a chunk.

Edge cases: texts null, empty, or whose joined tokens' bytes differ from
space+text have no tokens: zeros, and an empty digest; equal rows and equal
ids are documents of their own; a null doc_id stays null; among an A id's
pairs of equal counts all are best; an empty table gives an empty result;
columns other than doc_id and text are not read; a very long text closes its
chunk early (``LINKS``) but is never cut.
"""

from __future__ import annotations

import hashlib
import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import col, written
from .packing import byte_alphabet

#: Documents of a chunk (their numbers fit 16 bits), and links that close it early.
CHUNK, LINKS = 4096, 4_000_000
#: Documents whose pairs are counted at once.
SLICE = 256


def default_vocabularies() -> tuple[str, str]:
    import public_tokenizers as p
    return p.path("byte_bpe_50k.json"), p.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def tokenizers(a_path: str, b_path: str):
    """For A and B: texts to ids, and the bytes of every id."""
    import public_tokenizers
    import sentencepiece
    import tiktoken
    with open(a_path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {x["content"] for x in spec["added_tokens"]}
    alphabet = byte_alphabet()
    ranks = {bytes(alphabet[c] for c in word): i for word, i in spec["model"]["vocab"].items() if word not in special}
    enc = tiktoken.Encoding("pairs", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    a_bytes = [b""] * (max(ranks.values()) + 1)
    for word, i in ranks.items():
        a_bytes[i] = word
    sp = sentencepiece.SentencePieceProcessor(model_file=b_path)
    b_bytes = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in range(sp.get_piece_size())]
    if max(len(a_bytes), len(b_bytes)) > 1 << 16:
        raise ValueError("ids of more than 16 bits")
    return enc.encode_ordinary, a_bytes, lambda t: sp.encode(t, num_threads=1), b_bytes


class Aligner:
    def __init__(self, a_path: str, b_path: str):
        self.encode_a, self.a_bytes, self.encode_b, self.b_bytes = tokenizers(a_path, b_path)
        self.a_len, self.b_len = (np.array([len(x) for x in v], np.int64) for v in (self.a_bytes, self.b_bytes))
        # the texts of all ids with what may follow them: in A a comma or a bar, in B a comma or a semicolon
        na, nb = len(self.a_bytes), len(self.b_bytes)
        self.said = [f"{i}," for i in range(na)] + [f"{i}|" for i in range(na)] + [f"{i}," for i in range(nb)] + [f"{i};" for i in range(nb)]

    def align(self, text: bytes):
        """None, or (A ids, B ids, pair of each link, groups, their digest)."""
        if not text:
            return None
        spaced = b" " + text
        a = self.encode_a(spaced.decode())
        b = self.encode_b(text.decode())
        if b"".join(map(self.a_bytes.__getitem__, a)) != spaced or b"".join(map(self.b_bytes.__getitem__, b)) != spaced:
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        a_end, b_end = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        # the run of B tokens that overlap each A token
        first = np.searchsorted(b_end, a_end - self.a_len[a], "right")
        many = np.searchsorted(b_end - self.b_len[b], a_end, "left") - first
        to = np.cumsum(many)
        pair = np.repeat(a << 16, many) | b[np.arange(to[-1]) + np.repeat(first - to + many, many)]
        a_cut, b_cut = np.flatnonzero(np.isin(a_end, b_end, assume_unique=True)), np.flatnonzero(np.isin(b_end, a_end, assume_unique=True))
        # a group's A tokens, then its B tokens
        na, nb = len(self.a_bytes), len(self.b_bytes)
        a_said, b_said = a.copy(), b + 2 * na
        a_said[a_cut] += na
        b_said[b_cut] += nb
        said = np.empty(len(a) + len(b), np.int64)
        group_a, group_b = np.searchsorted(a_cut, np.arange(len(a))), np.searchsorted(b_cut, np.arange(len(b)))
        said[np.arange(len(a)) + np.concatenate(([0], b_cut + 1))[group_a]] = a_said
        said[np.arange(len(b)) + (a_cut + 1)[group_b]] = b_said
        joined = "".join(map(self.said.__getitem__, said.tolist()))[:-1]
        return a, b, pair, len(a_cut), hashlib.sha256(joined.encode()).digest()


def or_merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The union of (pair << 16 | document, links) lists without common entries, in order."""
    keys, links = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    return keys[order], links[order]


def planes_of(keys: np.ndarray, links: np.ndarray):
    """(plane, keys): -1 for all documents, j for those with bit j of links - 1."""
    yield -1, keys
    more, j = links - 1, 0
    while more.any():
        yield j, keys[more & 1 > 0]
        more >>= 1
        j += 1


def containers(keys: np.ndarray, size: int) -> tuple[bytes, bytes, bytes]:
    """Of sorted (pair << 16 | document) the pairs, their popcounts, and their
    containers end to end: 16-bit numbers, or ``size`` bits where that is less."""
    pairs, starts, cards = np.unique(keys >> np.uint64(16), return_index=True, return_counts=True)
    low = (keys & np.uint64(0xFFFF)).astype("<u2")
    out, at = [], 0
    for i in np.flatnonzero(cards * 16 > size).tolist():
        s, n = int(starts[i]), int(cards[i])
        bits = np.zeros(size, bool)
        bits[low[s:s + n]] = True
        out += [low[at:s].tobytes(), np.packbits(bits).tobytes()]
        at = s + n
    out.append(low[at:].tobytes())
    return pairs.astype("<u4").tobytes(), cards.astype("<u2").tobytes(), b"".join(out)


def opened(cards: np.ndarray, held: bytes, size: int) -> np.ndarray:
    """The documents of all containers, end to end."""
    raw, out, at, run = np.frombuffer(held, np.uint8), [], 0, 0
    dense = np.flatnonzero(cards * 16 > size).tolist()
    done = 0
    for i in dense:
        run = int(cards[done:i].sum()) * 2
        out += [raw[at:at + run].view("<u2"), np.flatnonzero(np.unpackbits(raw[at + run:at + run + size // 8])).astype("<u2")]
        at, done = at + run + size // 8, i + 1
    out.append(raw[at:].view("<u2") if len(raw) > at else np.zeros(0, "<u2"))
    return np.concatenate(out)


_ROW = [("chunk", pa.int64()), ("plane", pa.int32()), ("pairs", pa.binary()), ("cards", pa.binary()), ("held", pa.binary()), ("doc_ids", pa.list_(pa.int64())), ("figures", pa.binary()), ("digests", pa.binary())]
_ROWS = "chunk long, plane int, pairs binary, cards binary, held binary, doc_ids array<long>, figures binary, digests binary"
#: The row of a chunk's documents.
DOCS = -2


def bitmaps(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, chunk: int = CHUNK, links: int = LINKS) -> DataFrame:
    """A row for each plane of each chunk's containers, and one (plane
    ``DOCS``) with the chunk's doc_ids, figures (A and B tokens, groups,
    links) and group digests (all zero: no tokens)."""
    if chunk % 8 or not 0 < chunk <= 1 << 16:
        raise ValueError("chunk: a multiple of 8 up to 65,536")
    defaults = default_vocabularies()
    paths = (a_path or defaults[0], b_path or defaults[1])
    ship_package(docs.sparkSession)

    def run(batches):
        aligner = Aligner(*paths)
        base, made = TaskContext.get().partitionId() << 32, 0
        ids, figures, digests, parts, slices, held = [], [], [], [], [], 0

        def sliced():
            if slices:
                keys, n = np.unique(np.concatenate(slices), return_counts=True)
                parts.append((keys, n))
                slices.clear()

        def closed():
            sliced()
            rows = [(base + made, DOCS, None, None, None, ids, np.array(figures, "<i8").tobytes(), b"".join(digests))]
            if parts:
                rows += [(base + made, plane, *containers(keys, chunk), None, None, None) for plane, keys in planes_of(*or_merge(parts))]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _ROW)], [n for n, _ in _ROW])

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary())):
                found = aligner.align(text.as_py() or b"")
                if found:
                    a, b_ids, pair, groups, digest = found
                    slices.append(pair.astype(np.uint64) << np.uint64(16) | np.uint64(len(ids)))
                    held += len(pair)
                    figures.append((len(a), len(b_ids), groups, len(pair)))
                else:
                    figures.append((0, 0, 0, 0))
                digests.append(found[4] if found else bytes(32))
                ids.append(doc)
                if len(ids) % SLICE == 0:
                    sliced()
                if len(ids) == chunk or held > links:
                    yield closed()
                    made += 1
                    ids, figures, digests, parts, held = [], [], [], [], 0
        if ids:
            yield closed()

    src = docs.select(col("doc_id").cast("long").alias("doc_id"), col("text").alias("text"))
    return src.mapInArrow(run, _ROWS)


def unpacked(maps: DataFrame) -> DataFrame:
    """``(chunk, plane, pair, card)`` of the containers."""
    def run(batches):
        for b in batches:
            for chunk, plane, pairs, cards in zip(*(c.to_pylist() for c in b.columns)):
                pairs, cards = np.frombuffer(pairs, "<u4").astype(np.int64), np.frombuffer(cards, "<u2").astype(np.int64)
                for i in range(0, len(pairs), 1 << 16):
                    p, c = pairs[i:i + (1 << 16)], cards[i:i + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(p), chunk)), pa.array(np.full(len(p), plane, np.int32)), pa.array(p), pa.array(c)], ["chunk", "plane", "pair", "card"])

    return maps.filter("pairs is not null").select("chunk", "plane", "pairs", "cards").mapInArrow(run, "chunk long, plane int, pair long, card long")


def pair_counts(maps: DataFrame) -> DataFrame:
    """``(pair, a, b, documents, links, best)`` of all pairs, ``best`` where
    no other pair of the A id is in more documents."""
    times = F.when(F.col("plane") < 0, F.lit(1)).otherwise(F.expr("shiftleft(1L, plane)"))
    counts = unpacked(maps).groupBy("pair").agg(F.sum(F.when(F.col("plane") < 0, F.col("card"))).alias("documents"), F.sum(F.col("card") * times).alias("links"))
    counts = counts.select("pair", F.shiftright("pair", 16).alias("a"), F.col("pair").bitwiseAND(F.lit(0xFFFF)).alias("b"), "documents", "links")
    counts = written(counts, "pairs")
    return counts.join(counts.groupBy("a").agg(F.max("documents").alias("most")), "a").select("pair", "a", "b", "documents", "links", (F.col("documents") == F.col("most")).alias("best"))


def align(docs: DataFrame, a_path: str | None = None, b_path: str | None = None, chunk: int = CHUNK, links: int = LINKS) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256)``, a row for each document."""
    maps = written(bitmaps(docs, a_path, b_path, chunk, links), "bitmaps")
    counts = pair_counts(maps).select("pair", "documents", "best")
    asked = unpacked(maps.filter("plane = -1")).select("chunk", "pair").join(counts, "pair")
    both = maps.withColumns({"pair": F.lit(None).cast("long"), "documents": F.lit(None).cast("long"), "best": F.lit(None).cast("boolean")}).unionByName(asked, allowMissingColumns=True)

    def scored(rows):
        """The documents of a chunk from its rows: planes, and counts by pair."""
        planes, pair, count, best, head = [], [], [], [], None
        for b in rows:
            counted = b.filter(b.column(8).is_valid())
            pair.append(counted.column(8).to_numpy())
            count.append(counted.column(9).to_numpy())
            best.append(counted.column(10).to_numpy(zero_copy_only=False))
            for r in b.filter(b.column(8).is_null()).select(range(8)).to_pylist():
                if r["plane"] == DOCS:
                    head = r
                else:
                    planes.append(r)
        pair, count, best = np.concatenate(pair), np.concatenate(count), np.concatenate(best)
        order = np.argsort(pair)
        pair, count, best = pair[order], count[order], best[order]
        n = len(head["doc_ids"])
        total, highest = np.zeros(n), np.zeros(n)
        for r in planes:
            cards = np.frombuffer(r["cards"], "<u2").astype(np.int64)
            at = np.repeat(np.searchsorted(pair, np.frombuffer(r["pairs"], "<u4")), cards)
            docs_of, times = opened(cards, r["held"], chunk), 1 << max(r["plane"], 0)
            total += times * np.bincount(docs_of, count[at], n)  # whole numbers below 2^53
            highest += times * np.bincount(docs_of, best[at], n)
        f = np.frombuffer(head["figures"], "<i8").reshape(n, 4)
        digests = [head["digests"][32 * i:32 * i + 32] for i in range(n)]
        sha = [d.hex() if f[i, 0] else "" for i, d in enumerate(digests)]
        return pa.RecordBatch.from_arrays([pa.array(head["doc_ids"], pa.int64()), *[pa.array(f[:, i]) for i in range(4)], pa.array(highest.astype(np.int64)), pa.array(total.astype(np.int64)), pa.array(sha)],
                                          ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    def run(batches):
        own, rows = None, []
        for b in batches:
            chunks = b.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(chunks)) + 1).tolist(), len(chunks)]
            for a, z in zip(cuts, cuts[1:]):
                if a == z:
                    continue
                if chunks[a] != own and rows:
                    yield scored(rows)
                    rows = []
                own = chunks[a]
                rows.append(b.slice(a, z - a))
        if rows:
            yield scored(rows)

    names = [n for n, _ in _ROW] + ["pair", "documents", "best"]
    dealt = both.select(names).repartition("chunk").sortWithinPartitions("chunk")
    return dealt.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
