"""N-gram Jaccard join by rare-first prefix filtering.

A document's set are the hashes of its distinct n-grams.  Documents with equal
sets are one class.  Two classes link if 100 * intersection >= percent *
union.  If a class's n-grams stand in one global order, rare ones first, two
classes that link share one of their first p = n - ceil(percent * n / 100) + 1
(the prefix).

1. *What no other class has is the rarest.*  A task reduces a slice of
   documents to classes and deals their n-grams, as 32-bit keys, to ranges of
   the hash space; a range's task sees which keys occur once, and sends each
   slice how many n-grams of its documents occur elsewhere.  A class whose
   prefix holds none of those can have no partner and leaves.  Nothing but
   four bytes for the key and two for the document is shuffled for an n-gram.
2. *Frequencies* of the remaining classes' n-grams are counted, and each
   class's n-grams ranked by (frequency, hash): the prefix rows.
3. *Centres.*  Of the classes that share a prefix n-gram, each meets the one
   with the fewest n-grams of its own (the likeliest original of a group of
   copies).  Distinct pairs that pass the length filter are verified exactly;
   linked classes are one component already.
4. *The rest.*  Prefix n-grams whose classes are in two or more components
   bring their classes' sets together, in blocks.  A pair not yet connected is
   looked at where its first common prefix n-gram is, only there, if it passes
   the length filter, the positional filter (what can still follow the two
   positions) and the suffix filter (the sets' numbers of hashes in each of
   256 parts of the hash space bound their overlap).  Sizes, parts and prefixes
   suffice for that; whole sets come only to classes with a pair left, which
   the intersection verifies.  Blocks of a long n-gram meet each other in
   tasks of their own.  Out come the edges of a spanning forest; no link is
   lost.

Hashes have 64 bits (classes 128).  Edge cases: null and empty texts have an
empty set and link with nothing, not even each other (their component is their
own doc_id); a text with fewer words than n has one n-gram, the whole; equal
rows share a component; a null doc_id takes part, and is the component only
where no member has an id; an empty table gives an empty result; columns other
than doc_id and text are not read; a very long text is one set like any other.
``docs`` is to be a table (its rows come in the same order when a lost task is
run again).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ship_package
from .common import col, components, doc_key, join_spread, map_batches, texts, written

#: Documents and n-grams of a slice; its documents' numbers fit 16 bits.
SLICE, GRAMS = 8192, 2_000_000
#: Words whose hashes a task remembers.
KNOWN = 1 << 17
#: N-grams of a range, and classes of one n-gram that are compared at once.
RANGE, BLOCK = 2_000_000, 512
#: Parts of the hash space in the suffix filter.
PARTS = 256
#: Remaining classes up to this many (24 bytes each) are broadcast to their texts;
#: more of them meet the texts in a shuffle.
FEW = 1 << 20


class WordHashes(dict):
    """The 64-bit hash of each word."""

    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > KNOWN:
            self.clear()
        return np.array([self[w] for w in words], np.uint64)


def gram_set(text: bytes, size: int, known: WordHashes) -> np.ndarray:
    """The sorted hashes of a text's distinct n-grams."""
    words = text.lower().split()
    if len(words) < size:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), 1)] * bool(words), np.uint64)
    h = known.of(words)
    n = len(words) - size + 1
    x = np.zeros(n, np.uint64)
    for i in range(size):
        x = (x ^ h[i:i + n]) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return np.unique(x ^ x >> np.uint64(32))


def prefix_of(n: Column, percent: int) -> Column:
    """The length of the prefix of a set of n."""
    return n - F.floor((percent * n + 99) / 100) + 1


_ROWS = "part long, slice long, doc_ids array<long>, keys array<long>, figures binary, grams binary, owners binary"
_NAMES = [x.split()[0] for x in _ROWS.split(", ")]


def _sliced(bits: int, size: int):
    """Batches of (doc_id, k1, k2, text) to rows for the ranges (part >= 0),
    and one a slice with its documents (part = -1 - slice)."""
    def run(batches):
        known, base, made = WordHashes(), TaskContext.get().partitionId() << 32, 0
        ids, keys, figures, grams, owners, seen, held = [], [], [], [], [], {}, 0

        def closed():
            own = base + made
            cols = [[-1 - own], [own], [ids], [keys], [np.array(figures, "<i8").tobytes()], [None], [None]]
            if grams:
                h, o = np.concatenate(grams), np.repeat(np.array(owners, "<u2"), [len(g) for g in grams])
                order = np.argsort(h)
                h, o = h[order], o[order]
                same = np.append(False, h[1:] == h[:-1])
                shared = same | np.append(same[1:], False)  # in two classes of this slice: settled here
                local = np.bincount(o[shared], minlength=len(ids))
                fig = np.array(figures, "<i8").reshape(-1, 5)
                fig[:, 3] += local
                cols[4] = [fig.tobytes()]
                o = np.where(shared, 0xFFFF, o).astype("<u2")[~same]
                h = h[~same]
                parts = (h >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(h), np.int64)
                starts = np.append(np.flatnonzero(np.append(True, parts[1:] != parts[:-1])), len(h))
                low = (h >> np.uint64(32 - bits)).astype("<u4")
                for a, z in zip(starts.tolist(), starts[1:].tolist()):
                    for c, v in zip(cols, (int(parts[a]), own, None, None, None, low[a:z].tobytes(), o[a:z].tobytes())):
                        c.append(v)
            types = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], _NAMES)

        for b in (whole.slice(at, 512) for whole in batches for at in range(0, whole.num_rows, 512)):
            for doc, k1, k2, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).cast(pa.binary())):
                g = gram_set(text.as_py() or b"", size, known)
                digest = xxhash.xxh3_128_digest(g.tobytes())
                first = seen.setdefault(digest, len(ids))
                if first == len(ids) and len(g):
                    grams.append(g)
                    owners.append(first)
                    held += len(g)
                # n-grams, class (two halves), shared n-grams, the slice's first document of the class
                figures.append((len(g), *np.frombuffer(digest, "<i8").tolist(), 0, first))
                ids.append(doc)
                keys += (k1, k2)
                if len(ids) == SLICE or held > GRAMS:
                    yield closed()
                    made += 1
                    ids, keys, figures, grams, owners, seen, held = [], [], [], [], [], {}, 0
        if ids:
            yield closed()

    return run


def _shared(batches):
    """Rows sorted by part: the slices' own rows go through; for a range each
    slice gets the documents whose n-grams other slices have too, and how
    many.  The sums of a task's ranges go out together."""
    counts: dict[int, list] = {}
    own, slices, grams, owners, waiting = None, [], [], [], 0

    def settle():
        nonlocal waiting
        h = np.concatenate(grams)
        order = np.argsort(h, kind="stable")
        same = h[order][1:] == h[order][:-1]
        shared = order[np.append(False, same) | np.append(same, False)]
        o = np.concatenate(owners)[shared]
        at = np.repeat(np.array(slices), [len(g) for g in grams])[shared]
        at, o = at[o != 0xFFFF], o[o != 0xFFFF]
        order = np.argsort(at, kind="stable")
        at, o = at[order], o[order]
        starts = np.append(np.flatnonzero(np.append(True, at[1:] != at[:-1])), len(at)) if len(at) else []
        for a, z in zip(starts, starts[1:]):
            who, n = np.unique(o[a:z], return_counts=True)
            counts.setdefault(int(at[a]), []).append((who, n))
            waiting += len(who)

    def batch(rows):
        cols = list(zip(*rows)) or [[]] * 5
        types = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], ["slice", "doc_ids", "keys", "figures", "shared"])

    def sums():
        for s, found in counts.items():
            who = np.concatenate([w for w, _ in found]).astype(np.int64)
            n = np.bincount(who, np.concatenate([n for _, n in found])).astype(np.int64)
            who = np.flatnonzero(n)
            yield s, None, None, None, np.column_stack([who, n[who]]).astype("<i4").tobytes()
        counts.clear()

    for b in batches:
        for part, s, ids, keys, figures, g, o in zip(*(c.to_pylist() for c in b.columns)):
            if part < 0:
                yield batch([(s, ids, keys, figures, None)])
                continue
            if part != own and slices:
                settle()
                slices, grams, owners = [], [], []
                if waiting > 1 << 22:
                    yield batch(sums())
                    waiting = 0
            own = part
            slices.append(s)
            grams.append(np.frombuffer(g, "<u4"))
            owners.append(np.frombuffer(o, "<u2"))
    if slices:
        settle()
    yield batch(sums())


def _documents(batches):
    """Rows sorted by slice to ``(doc_id, k1, k2, n, s1, s2, shared)``."""
    own, head, extra = None, None, []

    def out():
        f = np.frombuffer(head[2], "<i8").reshape(-1, 5).copy()
        for x in extra:
            np.add.at(f[:, 3], x[:, 0], x[:, 1])
        f[:, 3] = f[f[:, 4], 3]
        k = np.array(head[1], np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(head[0], pa.int64()), *[pa.array(np.ascontiguousarray(c)) for c in (k[:, 0], k[:, 1], f[:, 0], f[:, 1], f[:, 2], f[:, 3])]], ["doc_id", "k1", "k2", "n", "s1", "s2", "shared"])

    for b in batches:
        for s, ids, keys, figures, shared in zip(*(c.to_pylist() for c in b.columns)):
            if s != own and head:
                yield out()
                head, extra = None, []
            own = s
            if ids is not None:
                head = (ids, keys, figures)
            else:
                extra.append(np.frombuffer(shared, "<i4").reshape(-1, 2))
    if head:
        yield out()


def scan(docs: DataFrame, size: int) -> DataFrame:
    """``(doc_id, k1, k2, n, s1, s2, shared)`` for every row: its key, the
    size and the digest of its set, and how many of its n-grams other classes
    have too (or keys that equal theirs)."""
    ship_package(docs.sparkSession)
    k = doc_key(col("doc_id"), col("text"))
    src = docs.select(col("doc_id").cast("long").alias("doc_id"), k[0].alias("k1"), k[1].alias("k2"), col("text").alias("text"))
    chars = docs.agg(F.sum(F.length(col("text")).cast("long"))).first()[0] or 0
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = max(4 * tasks, int(chars / 6 / RANGE)).bit_length()
    rows = src.mapInArrow(_sliced(min(bits, 31), size), _ROWS).repartition("part").sortWithinPartitions("part")
    found = rows.mapInArrow(_shared, "slice long, doc_ids array<long>, keys array<long>, figures binary, shared binary")
    found = found.repartition("slice").sortWithinPartitions("slice")
    return found.mapInArrow(_documents, "doc_id long, k1 long, k2 long, n long, s1 long, s2 long, shared long")


def sets_of(docs: DataFrame, classes: DataFrame, size: int) -> DataFrame:
    """``(cls, grams)``: the set of one document of each class."""
    k = doc_key(col("doc_id"), col("text"))
    src = docs.select(k[0].alias("k1"), k[1].alias("k2"), col("text").alias("text"))
    wanted = classes.select("k1", "k2", "cls")
    few = wanted.limit(FEW + 1).count() <= FEW
    src = src.join(F.broadcast(wanted) if few else wanted, ["k1", "k2"]).select("cls", "text")  # only equal rows share a key

    def one(b: pa.RecordBatch):
        known, done = WordHashes(), set()
        for at in range(0, b.num_rows, 256):
            part = b.slice(at, 256)
            rows = [(c, t) for c, t in zip(part.column(0).to_pylist(), texts(part.column(1))) if not (c in done or done.add(c))]
            yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in rows], pa.int64()), pa.array([gram_set(t, size, known).tobytes() for _, t in rows], pa.binary())], ["cls", "grams"])

    return map_batches(src, one, "cls long, grams binary").dropDuplicates(["cls"])


def overlap(x: np.ndarray, y: np.ndarray) -> int:
    """The size of the intersection of sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The ``(a, b)`` that link."""
    left = sets.select(F.col("cls").alias("a"), F.col("grams").alias("x"))
    right = sets.select(F.col("cls").alias("b"), F.col("grams").alias("y"))
    # a centre may be in a third of all pairs
    both = join_spread(join_spread(pairs, left, ["a"], F.col("b")), right, ["b"], F.col("a"))

    def one(b: pa.RecordBatch):
        keep = []
        for x, y in zip(b.column(2), b.column(3)):
            x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
            o = overlap(x, y)
            keep.append(100 * o >= percent * (len(x) + len(y) - o))
        return b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return map_batches(both.select("a", "b", "x", "y"), one, "a long, b long")


class Group:
    """The classes under one prefix n-gram, as far as a task holds them:
    rows of (cls, component, place, n, parts, prefix[, grams])."""

    def __init__(self, rows):
        self.cls, component, place, n, parts, prefixes, *sets = zip(*rows)
        self.label = np.unique(component, return_inverse=True)[1]
        self.at, self.n = np.array(place), np.array(n)
        self.parts = np.array([np.frombuffer(p, "<u4") for p in parts]).astype(np.int64)
        self.prefixes = [np.frombuffer(p, np.int64) for p in prefixes]
        self.sets = [np.frombuffer(s, np.uint64) for s in sets[0]] if sets else []

    def partners(self, i: int, low: int, gram: int, percent: int) -> Iterator[int]:
        """The classes from ``low`` on that are not connected with class i,
        pass the filters, and have ``gram`` as first common prefix n-gram."""
        n, m = self.n[i], self.n[low:]
        need = -(-percent * (n + m) // (100 + percent))
        ok = (self.label[low:] != self.label[i]) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
        ok &= 1 + np.minimum(n - self.at[i], m - self.at[low:]) >= need
        some = np.flatnonzero(ok)
        if len(some):  # what the parts hold alike
            some = some[np.minimum(self.parts[i], self.parts[low + some]).sum(1) >= need[some]]
        mine = self.prefixes[i]
        for j in (some + low).tolist():
            if self.label[i] != self.label[j] and mine[np.isin(mine, self.prefixes[j], assume_unique=True)][0] == gram:
                yield j

    def pairs(self, first: int | None) -> Iterator[tuple[int, int]]:
        """Each class and where its partners begin; with ``first``, the first
        so many classes meet the others only."""
        return ((i, i + 1 if first is None else first) for i in range(len(self.cls) if first is None else first))

    def promising(self, gram: int, percent: int, first: int | None) -> np.ndarray:
        """Which classes have a partner."""
        out = np.zeros(len(self.cls), bool)
        for i, low in self.pairs(first):
            for j in self.partners(i, low, gram, percent):
                out[[i, j]] = True
        return out

    def edges(self, gram: int, percent: int, first: int | None) -> list[tuple[int, int]]:
        """Edges of a spanning forest of the links."""
        out = []
        for i, low in self.pairs(first):
            for j in self.partners(i, low, gram, percent):
                o = overlap(self.sets[i], self.sets[j])
                if 100 * o >= percent * (self.n[i] + self.n[j] - o):
                    out.append((self.cls[i], self.cls[j]))
                    self.label[self.label == self.label[j]] = self.label[i]
        return out


def _groups(batches, done):
    """``done(key, rows, first)`` of each run of rows with equal (gram, x, y);
    ``first`` rows are of block x, the others of block y (None: x is y)."""
    own, rows = None, []

    def out():
        second = [r[0] for r in rows]
        first = None if own[1] == own[2] else second.index(True) if True in second else len(rows)
        return done(own, [r[1:] for r in rows], first)

    for b in batches:
        for r in zip(*(c.to_pylist() for c in b.columns)):
            if r[:3] != own:
                if rows:
                    yield out()
                own, rows = r[:3], []
            rows.append(r[3:])
    if rows:
        yield out()


_MEET = "gram long, x int, y int, second boolean, cls long, component long, place int, n long, parts binary, prefix binary"
_MEETS = [x.split()[0] for x in _MEET.split(", ")]


def compared(rows: DataFrame, held: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """``rows(gram, cls, component, place)``, ``held(cls, n, parts, prefix)``
    and ``sets(cls, grams)`` to the ``(a, b)`` of spanning forests of the
    links under each n-gram.  Whole sets come only to classes that have a
    partner there."""
    blocks = rows.groupBy("gram").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    dealt = join_spread(rows, blocks, ["gram"], F.col("cls"))
    mine = F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")
    # block i meets itself (i, i) and the others (i, j), (h, i)
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, F.col("mine")).alias("x"), F.greatest(o, F.col("mine")).alias("y")))
    dealt = dealt.withColumn("mine", mine).withColumn("meet", F.explode(meets)).select("gram", F.col("meet.x").alias("x"), F.col("meet.y").alias("y"), (F.col("mine") != F.col("meet.x")).alias("second"), "cls", "component", "place")
    place = F.struct("gram", "x", "y")
    order = ["gram", "x", "y", "second", "cls"]

    def promising(batches):
        def done(key, rows, first):
            keep = np.flatnonzero(Group(rows).promising(key[0], percent, first)).tolist()
            cols = list(zip(*[(*key, first is not None and i >= first, *rows[i]) for i in keep])) or [[]] * len(_MEETS)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], _MEETS)

        types = [{"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "binary": pa.binary()}[x.split()[1]] for x in _MEET.split(", ")]
        return _groups(batches, done)

    def linked(batches):
        def done(key, rows, first):
            edges = Group(rows).edges(key[0], percent, first)
            return pa.RecordBatch.from_arrays([pa.array([e[i] for e in edges], pa.int64()) for i in (0, 1)], ["a", "b"])

        return _groups(batches, done)

    met = join_spread(dealt, held, ["cls"], place).select(_MEETS).repartition("gram", "x", "y").sortWithinPartitions(*order)
    some = written(met.mapInArrow(promising, _MEET), "promising")
    whole = join_spread(some, sets, ["cls"], place).select(*_MEETS, "grams").repartition("gram", "x", "y").sortWithinPartitions(*order)
    return whole.mapInArrow(linked, "a long, b long").distinct()


def labelled(rows: DataFrame, edges: DataFrame) -> DataFrame:
    """``rows`` with the component of their ``cls``."""
    return rows.join(components(edges).select(F.col("node").alias("cls"), "component"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))


def link(docs: DataFrame, size: int = 3, percent: int = 90, block: int = BLOCK) -> DataFrame:
    """``(doc_id, n_grams, component_id)`` for every row: the size of its set
    and the smallest doc_id that links reach."""
    rows = written(scan(docs, size), "grams")
    some = rows.filter("n > 0")
    classes = some.groupBy("s1", "s2").agg(F.min("doc_id").alias("least"), F.first("n").alias("n"), F.max("shared").alias("shared"), F.min(F.struct("k1", "k2")).alias("k"))
    classes = written(classes.select("s1", "s2", "least", "n", "shared", "k.k1", "k.k2").withColumn("cls", F.monotonically_increasing_id()), "classes")
    own = F.col("n") - F.col("shared")
    left = classes.filter(prefix_of(F.col("n"), percent) > own).select("cls", "n", "k1", "k2")
    sets = written(sets_of(docs, left, size), "sets")

    def exploded(b: pa.RecordBatch):
        for c, g in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            h = np.frombuffer(g, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), c)), pa.array(np.full(len(h), len(h))), pa.array(h)], ["cls", "n", "gram"])

    grams = map_batches(sets, exploded, "cls long, n long, gram long")
    often = grams.groupBy("gram").agg(F.count("*").alias("df")).filter("df > 1")
    shared = grams.join(often, "gram")  # one narrow row a class; a hot n-gram's are split by the skew join
    # n-grams that only the class has come first; then by frequency and hash
    mine = Window.partitionBy("cls")
    ranked = shared.select("cls", "n", "gram", "df", F.count("*").over(mine).alias("common"), F.row_number().over(mine.orderBy("df", "gram")).alias("nth"))
    ranked = ranked.withColumn("place", F.col("n") - F.col("common") + F.col("nth")).filter(F.col("place") <= prefix_of(F.col("n"), percent))
    prefix = written(ranked.select("cls", "n", "gram", F.col("place").cast("int").alias("place"), (F.col("n") - F.col("common")).alias("own")), "prefix")
    centre = prefix.groupBy("gram").agg(F.count("*").alias("many"), F.min(F.struct("own", "cls", "n")).alias("c")).filter("many > 1").select("gram", F.col("c.cls").alias("a"), F.col("c.n").alias("m"))
    pairs = join_spread(prefix, centre, ["gram"], F.col("cls")).filter("a <> cls").filter(100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
    pairs = written(pairs.select(F.least("a", "cls").alias("a"), F.greatest("a", "cls").alias("b")).distinct(), "pairs")
    stars = written(verified(pairs, sets, percent), "stars")
    near = written(labelled(prefix, stars), "near")
    open_ = near.groupBy("gram").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi").select("gram")
    rest = written(join_spread(near, open_, ["gram"], F.col("cls")).select("gram", "cls", "component", "place"), "open")
    first = prefix.join(rest.select("cls").distinct(), "cls").groupBy("cls").agg(F.sort_array(F.collect_list(F.struct("place", "gram"))).alias("p"))
    held = sets.join(first, "cls").select("cls", "grams", F.col("p.gram").alias("p"))

    def packed(b: pa.RecordBatch):
        sets = [np.frombuffer(g, np.uint64) for g in b.column(1).to_pylist()]
        parts = [np.bincount((g >> np.uint64(56)).astype(np.int64), minlength=PARTS).astype("<u4").tobytes() for g in sets]
        prefixes = [np.array(p, np.int64).tobytes() for p in b.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array([len(g) for g in sets], pa.int64()), pa.array(parts, pa.binary()), pa.array(prefixes, pa.binary())], ["cls", "n", "parts", "prefix"])

    held = written(map_batches(held, packed, "cls long, n long, parts binary, prefix binary"), "held")
    edges = stars.union(compared(rest, held, sets, percent, block))
    groups = written(labelled(classes.select("s1", "s2", "cls", "least"), written(edges, "links")), "groups")
    least = groups.groupBy("component").agg(F.min("least").alias("component_id"))
    groups = written(join_spread(groups, least, ["component"], F.col("cls")).select("s1", "s2", "component_id"), "least")
    out = join_spread(some.select("doc_id", "n", "s1", "s2"), groups, ["s1", "s2"], F.col("doc_id"))
    none = rows.filter("n = 0").select("doc_id", F.col("n").alias("n_grams"), F.col("doc_id").alias("component_id"))
    return out.select("doc_id", F.col("n").alias("n_grams"), "component_id").union(none)
