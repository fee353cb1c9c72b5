"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits.  Three
differing bits or fewer leave at least two segments with at most one error
each (pigeonhole).  A segment is decoded by the binary Golay code of length
23: words at distance one share a codeword among their nearby codewords (the
one within distance two, or else the six within distance four).  So two
fingerprints that link agree in the codeword indices of a pair of segments;
each fingerprint gets a key for every such pair of indices, equal keys meet,
and the real distance is verified.  No link is missed.

Equal fingerprints are one node from the start, so copies cost nothing.  The
fingerprints under one key are compared in sorted blocks in numpy and give
only the edges of a spanning forest; keys with more fingerprints than a block
hand out their blocks, which meet each other in a second step.  Components are
the smallest doc_id reachable.

Edge cases: null and empty texts have fingerprint zero and link like any
other; equal rows share a component; a null doc_id takes part, and is the
component only where no member has an id; an empty table gives an empty
result; columns other than doc_id and text are not read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, components, doc_key, fresh, join_spread, least_labels, map_batches, texts, written

#: Generator polynomial of the Golay code: x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GOLAY = 0b101011100011
SEGMENTS = (22, 21, 21)
#: Fingerprints of one key that are compared at once.
BLOCK = 4096


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """The majority of each bit over the XXH64 (seed 42) of the lower-cased
    text's word shingles."""
    words = text.lower().split()
    if not words:
        return 0
    h64 = xxhash.xxh64_intdigest
    n = len(words) - shingle + 1
    if n <= 1:
        return h64(b" ".join(words), 42)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[shingle - 1:].tolist()
    h = np.fromiter((h64(joined[a:z], 42) for a, z in zip(starts, stops)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 1 << 16):
        ones += np.unpackbits(h[i:i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int((np.packbits(2 * ones > n, bitorder="little")).view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(k1, k2, doc_id, fp)`` for every row."""
    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t, shingle) for t in texts(b.column(3))], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(fps)], ["k1", "k2", "doc_id", "fp"])

    k = doc_key(col("doc_id"), col("text"))
    src = docs.select(k[0].alias("k1"), k[1].alias("k2"), col("doc_id").cast("long").alias("doc_id"), col("text").alias("text"))
    return map_batches(src, one, "k1 long, k2 long, doc_id long, fp long")


def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The syndrome of each of the 23 bits; for each syndrome the error
    patterns that lead to its nearby codewords, and how many there are."""
    bits = np.zeros(23, np.int64)
    x = 1
    for i in range(23):
        bits[i] = x
        x <<= 1
        if x >> 11:
            x ^= GOLAY
    leader = np.zeros(2048, np.int64)
    for size in (1, 2, 3):
        for c in combinations(range(23), size):
            leader[np.bitwise_xor.reduce(bits[list(c)])] = sum(1 << i for i in c)
    near, many = np.zeros((2048, 6), np.int64), np.zeros(2048, np.int64)
    for s in range(2048):
        found = {int(leader[s])} | {int(leader[s ^ int(bits[i])]) ^ (1 << i) for i in range(23)}
        near[s, :len(found)], many[s] = sorted(found), len(found)
    return bits, near, many


def segment_indices(seg: np.ndarray, tables) -> tuple[np.ndarray, np.ndarray]:
    """The 12-bit indices of each segment's nearby codewords (n x 6) and
    which of the six count."""
    bits, near, many = tables
    syn = np.zeros(len(seg), np.int64)
    for i in range(23):
        syn ^= ((seg >> i) & 1) * bits[i]
    return (seg[:, None] ^ near[syn]) >> 11, np.arange(6)[None, :] < many[syn][:, None]


def fuzzy_keys(fps: np.ndarray, tables) -> tuple[np.ndarray, np.ndarray]:
    """Of uint64 fingerprints: (row, key) for every key of every row."""
    segs, shift = [], 0
    for width in SEGMENTS:
        segs.append(((fps >> np.uint64(shift)) & np.uint64((1 << width) - 1)).astype(np.int64))
        shift += width
    index = [segment_indices(s, tables) for s in segs]
    rows, keys = [], []
    for p, (a, b) in enumerate(((0, 1), (0, 2), (1, 2))):
        (ia, oka), (ib, okb) = index[a], index[b]
        key = (p << 24) | (ia[:, :, None] << 12) | ib[:, None, :]
        r, i, j = np.nonzero(oka[:, :, None] & okb[:, None, :])
        rows.append(r)
        keys.append(key[r, i, j])
    return np.concatenate(rows), np.concatenate(keys)


def forest(fps: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (fingerprint, fingerprint) that connect what the pairs of places
    (a, b) connect."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    lab = least_labels(flat[:len(a)], flat[len(a):], len(nodes))
    own = lab != np.arange(len(nodes))
    return fps[nodes[own]], fps[nodes[lab[own]]]


def compare_sorted(keys: np.ndarray, fps: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges among fingerprints under equal keys (keys sorted)."""
    at, d, a, b, held = np.arange(len(keys)), 1, [], [], 0
    out_a, out_b = [], []
    while len(at):
        at = at[at + d < len(keys)]
        at = at[keys[at] == keys[at + d]]
        ok = at[np.bitwise_count(fps[at] ^ fps[at + d]) <= bits]
        a.append(ok)
        b.append(ok + d)
        held += len(ok)
        d += 1
        if held > 1 << 20 or not len(at):
            x, y = forest(fps, np.concatenate(a), np.concatenate(b))
            out_a.append(x)
            out_b.append(y)
            a, b, held = [], [], 0
    return (np.concatenate(out_a), np.concatenate(out_b)) if out_a else (fps[:0], fps[:0])


def compare_blocks(x: np.ndarray, y: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    fps = np.concatenate([x, y])
    a, b = [], []
    for i in range(0, len(x), 512):
        r, c = np.nonzero(np.bitwise_count(x[i:i + 512, None] ^ y[None, :]) <= bits)
        a.append(r + i)
        b.append(c + len(x))
    return forest(fps, np.concatenate(a), np.concatenate(b))


def links(distinct: DataFrame, bits: int = 3, block: int = BLOCK) -> DataFrame:
    """``(a, b)``: edges that connect the distinct ``fp`` within ``bits``
    differing bits as all such links do (at most 3)."""
    if not 0 <= bits <= 3:
        raise ValueError("the keys are exact up to 3 differing bits")
    tables = golay_tables()

    def keyed(b: pa.RecordBatch):
        fps = b.column(0).to_numpy().view(np.uint64)
        for i in range(0, len(fps), 8192):
            part = fps[i:i + 8192]
            rows, keys = fuzzy_keys(part, tables)
            yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int32)), pa.array(part[rows].view(np.int64))], ["key", "fp"])

    def meet(batches):
        keys, fps, blocks, open_key = np.zeros(0, np.int32), np.zeros(0, np.uint64), 0, None

        def result(a, b, key=(), no=(), packed=()):
            n, m = len(a), len(key)
            return pa.RecordBatch.from_arrays([
                pa.array([*a.view(np.int64).tolist(), *[None] * m], pa.int64()), pa.array([*b.view(np.int64).tolist(), *[None] * m], pa.int64()),
                pa.array([*[None] * n, *key], pa.int32()), pa.array([*[None] * n, *no], pa.int32()), pa.array([*[None] * n, *packed], pa.binary())],
                ["a", "b", "key", "block", "packed"])

        def settle(end: int, final: bool):
            """Compare the first ``end`` rows, of whole keys but for the block of a long one."""
            nonlocal keys, fps, blocks, open_key
            a, b = compare_sorted(keys[:end], fps[:end], bits)
            last = keys[end - 1]
            first = open_key is not None and keys[0] == open_key
            more = not final
            out = []
            if first or more:  # the part of a key that is cut into blocks
                own = open_key if first else last
                mine = fps[:end][keys[:end] == own]
                blocks = blocks if first else 0
                out.append((int(own), blocks, mine.tobytes()))
                blocks += 1
            open_key = last if more else None
            keys, fps = keys[end:], fps[end:]
            return result(a, b, [o[0] for o in out], [o[1] for o in out], [o[2] for o in out])

        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy()])
            fps = np.concatenate([fps, batch.column(1).to_numpy().view(np.uint64)])
            while len(keys) >= block:
                cut = int(np.searchsorted(keys, keys[-1]))  # the last key may go on
                if open_key is not None and keys[0] == open_key:
                    mine = int(np.searchsorted(keys, open_key, "right"))
                    if mine < min(len(keys), block):
                        yield settle(mine, True)
                    elif mine >= block:
                        yield settle(block, False)
                    else:
                        break
                elif cut > 0:
                    # keys longer than a block within what is whole
                    runs = np.flatnonzero(np.diff(keys[:cut])) + 1
                    ends = np.append(runs, cut)
                    sizes = np.diff(np.append(0, ends))
                    long = np.flatnonzero(sizes > block)
                    if not len(long):
                        yield settle(cut, True)
                    elif long[0] > 0:
                        yield settle(int(ends[long[0] - 1]), True)
                    else:
                        yield settle(block, False)
                else:
                    yield settle(block, False)
        while len(keys):
            mine = int(np.searchsorted(keys, keys[0], "right"))
            if open_key is not None and keys[0] == open_key:
                yield settle(min(mine, block), mine <= block)
            elif mine > block:
                yield settle(block, False)
            else:
                runs = np.append(np.flatnonzero(np.diff(keys)) + 1, len(keys))
                long = np.flatnonzero(np.diff(np.append(0, runs)) > block)
                yield settle(int(runs[long[0] - 1]) if len(long) else len(keys), True)

    def cross(b: pa.RecordBatch) -> pa.RecordBatch:
        a_all, b_all = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for x, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            e = compare_blocks(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), bits)
            a_all.append(e[0])
            b_all.append(e[1])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a_all, b_all)], ["a", "b"])

    keys = map_batches(distinct.select("fp"), keyed, "key int, fp long")
    met = keys.repartition("key").sortWithinPartitions("key").mapInArrow(meet, "a long, b long, key int, block int, packed binary")
    met = written(met, "links")
    long = met.filter("packed is not null").select("key", "block", "packed")
    pairs = long.alias("x").join(long.alias("y"), F.expr("x.key = y.key and x.block < y.block")).select(F.col("x.packed").alias("x"), F.col("y.packed").alias("y"))
    return met.filter("a is not null").select("a", "b").union(map_batches(pairs.repartition(F.xxhash64("x", "y")), cross, "a long, b long")).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 3) -> DataFrame:
    """``(k1, k2, doc_id, fp, component_id)`` for every row."""
    fps = written(fingerprints(docs, shingle), "fingerprints")
    nodes = written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    comp = components(links(nodes, bits)).select(F.col("node").alias("fp"), "component")
    nodes = nodes.join(comp, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    nodes = written(nodes, "labelled")
    least = nodes.groupBy("component").agg(F.min("least").alias("component_id"))
    # a component of many fingerprints is spread like any hot key
    labelled = join_spread(nodes, least, ["component"], F.col("fp")).select("fp", "component", "component_id")
    return join_spread(fps, labelled, ["fp"], F.xxhash64("k1", "k2"))


def keep_one(docs: DataFrame, shingle: int = 3, bits: int = 3) -> DataFrame:
    """One document of each group: that with the smallest (doc_id, text key),
    null ids last."""
    k1, k2, keep = fresh(docs, "k1", "k2", "keep")
    k = doc_key(col("doc_id"), col("text"))
    order = F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), "k1", "k2")
    best = near_duplicates(docs, shingle, bits).groupBy("component").agg(F.min(order).alias("best"))
    best = best.select(F.col("best.k1").alias(k1), F.col("best.k2").alias(k2))
    one = docs.withColumn(k1, k[0]).withColumn(k2, k[1]).dropDuplicates([k1, k2])
    return one.join(best, [k1, k2], "left_semi").select(*[col(c) for c in docs.columns])
