"""Hashed maximum-entropy language model, class-factored.

P(word | history) = P(class | history) * P(word | class, history).  The most
frequent words have a class each, the others share classes.  Both factors are
trained: the class is a softmax, and within a class three softmaxes of 16
branches lead to one of 4,096 leaves, so history chooses among all 32,768
leaves (seen as two factors, 128 classes of 256 leaves each) at the cost of
four times 16 scores.  The 32,768 most frequent words after those with a class
of their own have a leaf each, which the rarer ones, dealt by hash, share.
Each softmax has hashed features of the history and the branch that is already
chosen: the last word (n-gram), the last two words (n-gram), and the word
before the last (skip), added to the branches' prior.  A word within a leaf
goes by its count plus one, with one place for all words never seen, so a
history's probabilities sum to one.

Training is in rounds over disjoint shards of the training documents: each
task takes gradient steps (AdaGrad by row) through its share from the round's
weights, and its rows are averaged with the other tasks' by how often each
task met them.  The weight tables have a fixed size.  Counts are exact over
all training documents: a fixed number of the most frequent words is
broadcast, and every other word meets its count in a join.

Edge cases: a null or empty text is one token, the end; a null doc_id counts
as the empty string when documents are dealt to training; equal rows are
scored apart; an empty table gives no rows; with no training documents every
word is unknown; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import col, written

#: Broadcast words, classes (words with a class of their own, shared ones), rows of a feature's table, tokens of a gradient step, rounds.
FREQUENT, OWN, SHARED, ROWS, STEP, ROUNDS = 65536, 8, 8, 1 << 15, 8192, 2
CLASSES, FEATURES, CUT = OWN + SHARED, 3, 1024
#: Softmaxes on a word's way (the class and the branches within it), leaves, tables (a feature's at each softmax).
LEVELS = 4
LEAVES, TABLES = SHARED * 16 ** (LEVELS - 1), LEVELS * FEATURES
RATE = 0.2
_FLAT = 1 << 16


class Codes(dict):
    """Words to codes: CRC-32, and above it 1 + the place among the frequent
    words (0: not one of them).  Holds a bounded number of other words."""

    def __init__(self, frequent: list[bytes], room: int = 50_000):
        super().__init__((w, zlib.crc32(w) | (i + 1) << 32) for i, w in enumerate(frequent))
        self.most = len(self) + room
        self.frequent = pa.array(frequent, pa.binary())

    def of(self, words: pa.Array) -> np.ndarray:
        """The codes of an array of words, without a Python step for each."""
        # joined and cut again at once, as no word holds a space
        row = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), b" ")[0].as_py()
        place = pc.fill_null(pc.index_in(words, value_set=self.frequent), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        return np.fromiter(map(zlib.crc32, row.split()), np.int64, len(words)) | place + 1 << 32

    def __missing__(self, word: bytes) -> int:
        code = zlib.crc32(word)
        if len(self) < self.most:
            self[word] = code
        return code


def leaves(codes: np.ndarray) -> np.ndarray:
    """The leaves of words without a class of their own: the low bits are the
    shared class, four more bits each the branch within."""
    rank = (codes >> 32) - 1 - OWN
    return np.where((rank >= 0) & (rank < LEAVES), rank, codes & LEAVES - 1)


def classes(codes: np.ndarray, leaf: np.ndarray | None = None) -> np.ndarray:
    rank = (codes >> 32) - 1
    return np.where((rank >= 0) & (rank < OWN), rank, OWN + ((leaves(codes) if leaf is None else leaf) & SHARED - 1))


def branch(leaf: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """The nodes that the leaves' way has reached at a level within the class
    (1 and up), and the branch that it takes there."""
    reached = SHARED.bit_length() - 1 + 4 * (level - 1)
    return leaf & (1 << reached) - 1, leaf >> reached & 15


def histories(crc: np.ndarray, at: np.ndarray, node: np.ndarray | None = None) -> list[np.ndarray]:
    """The feature rows of the tokens at ``at``, a family each, for the class
    or, within it, for the nodes reached."""
    a, b = crc[at - 1].astype(np.uint64), crc[at - 2].astype(np.uint64)
    with np.errstate(over="ignore"):
        n = np.uint64(0) if node is None else (node.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        row = lambda x: (((x + n) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 15)).astype(np.uint16)
        return [row(a + np.uint64(1)), row(a * np.uint64(0xC2B2AE3D27D4EB4F) + b + np.uint64(2)), row(b + np.uint64(3))]


_ONES = np.ones(CLASSES, np.float32)


def class_scores(weights: np.ndarray, prior: np.ndarray, rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of P(class | history) for all classes, or of the branches of the nodes
    whose priors are given: the scores, their exponentials, and the sums of these."""
    z = weights[0].take(rows[0], axis=0)
    z += weights[1].take(rows[1], axis=0)
    z += weights[2].take(rows[2], axis=0)
    z += prior
    if z.max() > 60:  # else no exponential overflows
        z -= z.max(1, keepdims=True)
    e = np.exp(z)
    return z, e, e @ _ONES


def split(column: pa.Array) -> pa.ListArray:
    """The words of the texts, A-Z in lower case (null: no text, or none)."""
    text = pc.ascii_trim_whitespace(pc.ascii_lower(column.cast(pa.string())))
    return pc.ascii_split_whitespace(pc.if_else(pc.equal(text, ""), pa.scalar(None, pa.string()), text))


class Words:
    """The words of a batch of texts: the distinct ones, the place of each
    token among them, its code, and how many there are in each text.  A
    distinct word is looked up once."""

    def __init__(self, column: pa.Array, codes: Codes | dict[bytes, int]):
        lists = split(column)
        self.sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        found = lists.flatten().dictionary_encode()
        self.distinct, self.place = found.dictionary, found.indices.to_numpy(zero_copy_only=False)
        words = self.distinct.cast(pa.binary())
        known = codes.of(words) if isinstance(codes, Codes) else np.array([codes[w] for w in words.to_pylist()], np.int64)
        self.codes = known.take(self.place)
        self.start = np.append(0, np.cumsum(self.sizes))

    def groups(self, slices: int = 128):
        """Slices of texts of about 2**16 tokens (or one text), and of no more
        than ``slices`` texts."""
        for i in range(0, len(self.sizes), slices):
            at, held, last = i, 0, min(i + slices, len(self.sizes))
            for j in range(i, last):
                held += self.sizes[j] + 1
                if held >= _FLAT:
                    yield at, j + 1
                    at, held = j + 1, 0
            if at < last:
                yield at, last

    def own(self, a: int, z: int) -> slice:
        """The tokens of the texts from ``a`` to ``z``."""
        return slice(self.start[a], self.start[z])


class Flat:
    """Documents as one row of codes, each with two ends before it."""

    def __init__(self, docs: list[list[bytes]], codes: Codes):
        self._lay(np.array([codes[w] for d in docs for w in d], np.int64), np.array([len(d) for d in docs]), codes[b""])

    @classmethod
    def of(cls, words: Words, a: int, z: int, codes: Codes) -> Flat:
        f = cls.__new__(cls)
        f._lay(words.codes[words.own(a, z)], words.sizes[a:z], codes[b""])
        return f

    def _lay(self, own: np.ndarray, n: np.ndarray, end: int) -> None:
        sizes = n + 3
        last = np.cumsum(sizes) - 1
        first = last - sizes + 1
        target = np.ones(sizes.sum(), bool)
        target[first] = target[first + 1] = False
        self.at = np.flatnonzero(target)
        self.doc = np.repeat(np.arange(len(n)), sizes - 2)
        target[last] = False
        self.codes = np.full(len(target), end, np.int64)
        self.codes[target] = own
        self.crc = self.codes & 0xFFFFFFFF
        own = self.codes[self.at]
        self.leaves = leaves(own)
        self.classes = classes(own, self.leaves)

    def ways(self, level: int, prior: list[np.ndarray]):
        """The steps of tokens that choose at a level: their places, choices,
        feature rows and priors.  A level has its own tables, so a walk level
        by level finds them in the processor's cache."""
        on = None if level == 0 else np.flatnonzero(self.classes >= OWN)
        for i in range(0, len(self.at) if on is None else len(on), STEP):
            if on is None:
                place = slice(i, i + STEP)
                yield place, self.classes[place], histories(self.crc, self.at[place]), prior[0]
            else:
                place = on[i:i + STEP]
                node, k = branch(self.leaves[place], level)
                yield place, k, histories(self.crc, self.at[place], node), prior[level].take(node, axis=0)


def whole_rows(x: np.ndarray) -> np.ndarray:
    """The rows of a table as single values, which are written much faster by
    their places than a row of numbers each."""
    return x.view(np.dtype((np.void, x.strides[0]))).ravel()


def row_sums(g: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct of ``r``, how often each occurs, and the sums of ``g``'s
    rows by it: neighbours in the order of ``r`` are added pairwise."""
    order = np.argsort(r, kind="stable")
    own = r.take(order)
    new = np.append(True, own[1:] != own[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(own)))
    sums = g.take(order[first], axis=0)
    many = np.flatnonzero(n > 1)
    size = n[many] - 1
    rest = g.take(order[~new], axis=0)  # what comes after a value's first row, added up at the first of these
    start = np.cumsum(size) - size
    place = np.arange(len(rest), dtype=np.int32) - np.repeat(start.astype(np.int32), size)
    at, left, step, cells = np.arange(len(rest)), np.repeat(size, size) - place, 1, whole_rows(rest)
    while len(at):
        here = np.flatnonzero((place & 2 * step - 1 == 0) & (left > step))
        at, place, left = at.take(here), place.take(here), left.take(here)
        cells[at] = whole_rows(rest.take(at, axis=0) + rest.take(at + step, axis=0))
        step *= 2
    sums[many] += rest.take(start, axis=0)
    return own[first].astype(np.intp), n, sums


def train_share(weights: np.ndarray, prior: list[np.ndarray], texts, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
    """Gradient steps through arrays of texts: the weights, and how often each
    row was met."""
    w, seen, power = weights.copy(), np.zeros((TABLES, ROWS), np.float32), np.full((TABLES, ROWS), 1.0, np.float32)
    for column in texts:
        words = Words(column, codes)
        for a, z in words.groups():
            f = Flat.of(words, a, z, codes)
            for level in range(LEVELS):
                own = level * FEATURES
                for _, k, rows, known in f.ways(level, prior):
                    _, g, total = class_scores(w[own:own + FEATURES], known, rows)
                    g /= total[:, None]
                    g.ravel()[np.arange(0, g.size, CLASSES) + k] -= 1
                    for r, wj, seen_j, power_j in zip(rows, w[own:], seen[own:], power[own:]):
                        u, n, sums = row_sums(g, r)
                        seen_j[u] += n
                        power_u = power_j.take(u) + np.einsum("ij,ij->i", sums, sums)
                        power_j[u] = power_u
                        sums *= (-RATE / np.sqrt(power_u))[:, None]
                        sums += wj.take(u, axis=0)
                        whole_rows(wj)[u] = whole_rows(sums)
    return w, seen


def _parts(b: pa.RecordBatch, rows: int = 2048):
    """A batch in slices, so that what a task holds is bounded."""
    return (b.slice(i, rows) for i in range(0, b.num_rows, rows))


def word_counts(training: DataFrame) -> DataFrame:
    """``(word, c)``: all tokens of the training texts, the end as the empty
    word; each task sums up before the shuffle, in bounded memory."""
    def count(batches):
        for b in batches:
            for part in _parts(b):
                found = split(part.column(0)).flatten().value_counts()
                yield pa.RecordBatch.from_arrays([found.field(0), found.field(1)], ["word", "n"])
                yield pa.RecordBatch.from_arrays([pa.array([""]), pa.array([part.num_rows])], ["word", "n"])

    return training.select(col("text").alias("text")).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("c"))


def fit(training: DataFrame, counts: DataFrame, rounds: int = ROUNDS):
    """The model: frequent words with their counts, class totals, prior and
    weights (all of bounded size)."""
    spark = training.sparkSession
    top = counts.orderBy(F.desc("c"), "word").limit(FREQUENT).collect()
    frequent, c = [r["word"].encode() for r in top], np.array([r["c"] for r in top], np.int64)
    total, distinct = (x or 0 for x in counts.agg(F.sum("c"), F.count(F.lit(1))).first())
    dealt = counts.groupBy((F.crc32(F.col("word").cast("binary")) % LEAVES).cast("int").alias("k")).agg(F.sum("c"), F.count(F.lit(1))).collect()
    size, kinds = np.zeros(LEAVES), np.zeros(LEAVES)
    for k, n, v in dealt:
        size[k], kinds[k] = n, v
    # the frequent words leave the leaves of their hashes for those of their ranks
    crc = np.array([zlib.crc32(w) for w in frequent], np.int64)
    to = leaves(crc | np.arange(1, len(frequent) + 1) << 32)
    for x, of in ((size, c), (kinds, np.ones(len(c)))):
        np.subtract.at(x, crc % LEAVES, of)
        np.add.at(x, to[OWN:], of[OWN:])
    own = np.zeros(OWN)
    own[:len(c)] = c[:OWN]
    class_size = np.append(own, size.reshape(-1, SHARED).sum(0))
    class_kinds = np.append(np.zeros(OWN), kinds.reshape(-1, SHARED).sum(0))
    held = size + kinds + 1
    prior = [np.log((class_size + 1) / (class_size.sum() + CLASSES))]
    for level in range(1, LEVELS):  # what the nodes' branches hold: the low bits of a leaf are the node
        reached = SHARED * 16 ** (level - 1)
        part = held.reshape(-1, 16, reached).sum(0)
        prior.append(np.log(part / part.sum(0)).T)
    prior = [np.ascontiguousarray(p, np.float32) for p in prior]
    weights = np.zeros((TABLES, ROWS, CLASSES), np.float32)
    cuts = ROWS // CUT
    for r in range(rounds):
        sent = spark.sparkContext.broadcast((frequent, prior, weights))

        def share(batches):
            words, prior_, w = sent.value
            w, seen = train_share(w, prior_, (part.column(0) for b in batches for part in _parts(b)), Codes(words))
            blocks = [(j * cuts + i, np.s_[j, i * CUT:(i + 1) * CUT]) for j in range(TABLES) for i in range(cuts)]
            blocks = [(n, s) for n, s in blocks if seen[s].any()]
            yield pa.RecordBatch.from_arrays([
                pa.array([n for n, _ in blocks], pa.int32()), pa.array([w[s].astype(np.float16).tobytes() for _, s in blocks], pa.binary()), pa.array([seen[s].tobytes() for _, s in blocks], pa.binary())],
                ["block", "weights", "seen"])

        def mean(batches):
            held: dict[int, list] = {}
            for b in batches:
                for n, w, seen in zip(*(b.column(i).to_pylist() for i in range(3))):
                    w, seen = np.frombuffer(w, np.float16).astype(np.float64).reshape(CUT, CLASSES), np.frombuffer(seen, np.float32).astype(np.float64)
                    if n not in held:
                        held[n] = [np.zeros((CUT, CLASSES)), np.zeros(CUT)]
                    held[n][0] += w * seen[:, None]
                    held[n][1] += seen
            for n, (w, seen) in held.items():
                met = np.where(seen[:, None] > 0, w / np.maximum(seen, 1)[:, None], np.nan).astype(np.float32)
                yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([met.tobytes()], pa.binary())], ["block", "weights"])

        mine = training.filter(F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(rounds)) == r).select(col("text").alias("text"))
        shares = mine.mapInArrow(share, "block int, weights binary, seen binary")
        new = weights.copy()
        for row in written(shares.repartition("block").mapInArrow(mean, "block int, weights binary"), "weights").collect():  # the size of the tables
            j, i = divmod(row["block"], cuts)
            met = np.frombuffer(row["weights"], np.float32).reshape(CUT, CLASSES)
            part = new[j, i * CUT:(i + 1) * CUT]
            part[:] = np.where(np.isnan(met), part, met)
        weights = new
    logs = np.where(np.arange(CLASSES) < OWN, 0.0, np.log10(class_size + class_kinds + 1))  # of the classes' words and one place for all others
    return {"frequent": frequent, "c": c, "total": total, "distinct": distinct, "prior": prior[0], "priors": prior, "weights": weights, "class_logs": logs, "leaf_logs": np.log10(held)}


def way_logs(f: Flat, m: dict) -> np.ndarray:
    """ln P(class, leaf | history) of each token."""
    logs = np.zeros(len(f.at))
    for level in range(LEVELS):
        own = level * FEATURES
        for place, k, rows, known in f.ways(level, m["priors"]):
            scores, _, sums = class_scores(m["weights"][own:own + FEATURES], known, rows)
            logs[place] += scores.ravel().take(np.arange(0, scores.size, CLASSES) + k) - np.log(sums)
    return logs


def score(docs: DataFrame, held_out_of: int = 7, held_out: int = 2, rounds: int = ROUNDS) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score)`` for every row; training leaves out the documents whose
    crc32(doc_id as text) mod ``held_out_of`` is ``held_out``."""
    out = F.crc32(F.coalesce(col("doc_id").cast("string"), F.lit("")).cast("binary")) % held_out_of == held_out
    d = docs.select(col("doc_id").alias("doc_id"), col("text").alias("text"), out.alias("held_out"))
    ship_package(d.sparkSession)
    training = d.filter(~F.col("held_out"))
    counts = written(word_counts(training), "counts")
    model = fit(training, counts, rounds)
    base_log = math.log10(model["total"] + model["distinct"] + 1)
    sent = d.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        m = sent.value
        codes, seen = Codes(m["frequent"]), np.log10(np.append(1.0, m["c"] + 1.0))
        for b in batches:
            for p in _parts(b):
                yield from part(p, m, codes, seen)

    def part(b, m, codes, seen):
        words = Words(b.column(1), codes)
        for a, z in words.groups():
            f = Flat.of(words, a, z, codes)
            n, own, k = z - a, f.codes[f.at] >> 32, f.classes
            logs = way_logs(f, m)
            count = seen[own]  # log10(c + 1); 0 for words that meet their count later
            total = lambda x: np.bincount(f.doc, x, minlength=n)
            # the words outside the frequent ones, and how often each is in its text
            here, kinds = words.own(a, z), max(len(words.distinct), 1)
            outside = np.flatnonzero(words.codes[here] >> 32 == 0)
            met, tf = np.unique(np.repeat(np.arange(n), words.sizes[a:z])[outside] * kinds + words.place[here][outside], return_counts=True)
            rare = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(np.bincount(met // kinds, minlength=n))), pa.int32()),
                pa.StructArray.from_arrays([words.distinct.take(pa.array(met % kinds)), pa.array(tf, pa.int64())], ["word", "tf"]))
            yield pa.RecordBatch.from_arrays([
                b.column(0).slice(a, n), b.column(2).slice(a, n), pa.array(np.bincount(f.doc, minlength=n)), pa.array(total(own > 0).astype(np.int64)),
                pa.array(total(count)), pa.array(total(logs / math.log(10) + np.where(k < OWN, 0.0, count - m["leaf_logs"][f.leaves]))), rare],
                ["doc_id", "held_out", "n_tokens", "known", "counted", "modelled", "rare"])

    id_type = dict(d.dtypes)["doc_id"]
    rows = d.mapInArrow(scored, f"doc_id {id_type}, held_out boolean, n_tokens long, known long, counted double, modelled double, rare array<struct<word string, tf long>>")
    rows = written(rows.withColumn("uid", F.monotonically_increasing_id()), "scored")
    # no word outside the frequent ones has more than 1 / FREQUENT of the tokens
    rare = rows.select("uid", F.inline("rare")).join(counts, "word")
    rare = rare.groupBy("uid").agg(F.sum("tf").alias("more"), F.sum(F.col("tf") * F.log10(F.col("c") + 1)).alias("logs"))
    both = rows.drop("rare").join(rare, "uid", "left")
    logs = F.coalesce("logs", F.lit(0.0))
    return both.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(int(model["total"])).cast("long").alias("train_tokens"),
        (F.col("counted") + logs - F.col("n_tokens") * F.lit(base_log)).alias("base_score"), (F.col("modelled") + logs).alias("score"))
