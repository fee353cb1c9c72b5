"""Ranked lexical search by the Best Position Algorithm.

A term's impact in a document is its weight times its saturated, length-
normalised frequency, in whole numbers, so a document's score is the sum of
its impacts over a query's terms.  Document frequencies, lengths and counts
are taken over all documents; then the documents are dealt to shards of
bounded size, and a task holds one shard's impact lists: for each term its
documents by falling impact.

A query reads its lists in parallel, some more positions each round.  Every
document that comes up is looked up directly in the query's other lists, which
gives its whole score and marks its position there as seen.  A list's best
position is the end of the run of seen positions from the top, so it also
moves by what the direct accesses have seen and lies at or behind the last
position read.  No document that is still unseen can have more than the sum of
the impacts right behind the best positions; the search stops when the k-th
score is strictly above that sum (at equality an unseen document may tie and
have the smaller id).  The best k of the shards are merged by a window.

Edge cases: a null or empty text has no terms; a document without terms counts
nowhere; an item without terms gives no rows; rows with an equal item_id (null
included) are one item with the terms of all; each row of ``docs`` is a
document, so equal rows rank one after the other; ties go to the smaller
doc_id, null last; an item with fewer than k documents above 0 gives those;
empty tables give an empty result; columns other than the id and the text are
not read; a very long text is one row like any other.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import col, map_batches, texts, written

#: Term bytes: digits, letters (A-Z lowered) and all of non-ASCII; the others part terms.
FOLD = bytes(b if b >= 0x80 else ord(chr(b).lower()) if chr(b).isalnum() else 0x20 for b in range(256))
#: The queries' terms filter the documents' while reading up to this many of them;
#: with more of them the join alone does.
VOCABULARY = 1 << 20
#: Postings of a shard (its share of the documents of all the queries' terms).
SHARD = 500_000
#: Queries that travel as one row.
QUERIES = 256


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


def query_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``(item_id, term)``, distinct."""
    def one(b: pa.RecordBatch):
        ids, out = [], []
        for i, t in zip(b.column(0).to_pylist(), texts(b.column(1))):
            found = sorted(set(terms_of(t)))
            ids += [i] * len(found)
            out += found
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())], ["item_id", "term"])

    src = items.select(col(item_id).cast("long").alias("item_id"), col(text).alias("text"))
    return map_batches(src, one, "item_id long, term string").distinct()


def counted(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``(doc_id, n, terms, tfs, uid)``: every document's number of terms, and
    its counts of the terms that queries may ask for."""
    spark, known = docs.sparkSession, None
    if vocabulary.limit(VOCABULARY + 1).count() <= VOCABULARY:
        known = spark.sparkContext.broadcast({r[0].encode() for r in vocabulary.select("term").toLocalIterator()})

    def one(b: pa.RecordBatch):
        wanted = known.value if known else None
        for at in range(0, b.num_rows, 512):
            part = b.slice(at, 512)
            n, terms, tfs, offsets = [], [], [], [0]
            for t in texts(part.column(1)):
                found = terms_of(t)
                n.append(len(found))
                tf = Counter(found if wanted is None else filter(wanted.__contains__, found))
                terms += tf
                tfs += tf.values()
                offsets.append(len(terms))
            at_ = pa.array(offsets, pa.int32())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, pa.int64()), pa.ListArray.from_arrays(at_, pa.array(terms, pa.binary()).cast(pa.string())),
                                              pa.ListArray.from_arrays(at_, pa.array(tfs, pa.int64()))], ["doc_id", "n", "terms", "tfs"])

    src = docs.select(col("doc_id").cast("long").alias("doc_id"), col("text").alias("text"))
    return map_batches(src, one, "doc_id long, n long, terms array<string>, tfs array<long>").withColumn("uid", F.monotonically_increasing_id())


class Lists:
    """A shard's impact lists: a term's documents (as places in the order of
    ids) by falling impact, and the same by document for direct accesses."""

    def __init__(self, tid: np.ndarray, doc: np.ndarray, impact: np.ndarray, docs: int):
        order = np.lexsort((doc, -impact, tid))
        tid, self.doc, self.impact, self.docs = tid[order], doc[order], impact[order], docs
        terms, starts = np.unique(tid, return_index=True)
        self.span = dict(zip(terms.tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(tid)])))
        self.by_doc = np.lexsort((self.doc, tid))  # within a term's span, places by document
        self.sorted = self.doc[self.by_doc]

    def best(self, tids: list[int], k: int, step: int = 32) -> tuple[np.ndarray, np.ndarray, int]:
        """The k best documents and their scores, and how many were scored."""
        spans = [self.span[t] for t in tids if t in self.span]
        reached = [np.zeros(z - a + 1, bool) for a, z in spans]
        best = [0] * len(spans)
        scored, score, depth = np.zeros(self.docs, bool), np.zeros(self.docs, np.int64), 0
        while spans:
            read = np.concatenate([self.doc[a + depth:min(z, a + depth + step)] for a, z in spans])
            new = np.unique(read)
            new = new[~scored[new]]
            scored[new] = True
            bound = 0
            for i, (a, z) in enumerate(spans):
                if len(new):
                    own = self.sorted[a:z]
                    at = np.searchsorted(own, new)
                    hit = own[np.minimum(at, z - a - 1)] == new
                    place = self.by_doc[a + at[hit]]
                    score[new[hit]] += self.impact[place]
                    reached[i][place - a] = True
                best[i] += int(np.argmin(reached[i][best[i]:]))  # the last element is never reached
                bound += int(self.impact[a + best[i]]) if best[i] < z - a else 0
            depth += step
            step *= 2
            found = np.flatnonzero(scored)
            if not bound or (len(found) >= k and -np.partition(-score[found], k - 1)[k - 1] > bound):
                break
        found = np.flatnonzero(scored)
        top = found[np.lexsort((found, -score[found]))][:k]
        return top, score[top], len(found)


def search(docs: DataFrame, items: DataFrame, k: int = 10, shard: int = SHARD) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: each item's k best documents."""
    asked = written(query_terms(items), "asked")
    vocabulary = written(asked.select("term").distinct().withColumn("tid", F.monotonically_increasing_id()), "vocabulary")
    rows = written(counted(docs, vocabulary), "counted")
    total = rows.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = total["docs"], total["terms"] or 0
    flat = rows.select("uid", "doc_id", "n", F.explode(F.arrays_zip("terms", "tfs")).alias("t"))
    flat = flat.select("uid", "doc_id", "n", F.col("t.terms").alias("term"), F.col("t.tfs").alias("tf"))
    df = written(flat.groupBy("term").agg(F.count("*").alias("df")).join(vocabulary, "term"), "frequencies")
    shards = 1 + int(df.agg(F.sum("df")).first()[0] or 0) // shard
    w = F.floor(1000 * F.log((2 * F.lit(n_docs) + 2) / (2 * F.col("df") + 1))).cast("long")
    weights = df.select("term", "tid", w.alias("w")).filter("w > 0")
    m = F.expr(f"100 - 90 + (90 * n * {n_docs}L) div {max(n_terms, 1)}L")
    postings = flat.join(weights, "term").withColumn("m", m).select(
        F.pmod(F.xxhash64("uid"), F.lit(shards)).cast("int").alias("shard"), "tid", "doc_id", "uid", F.expr("w * ((1000000000L * tf) div (1000 * tf + 8 * m))").alias("impact"))
    # every shard gets every query: blocks of queries as rows behind the postings
    wanted = asked.join(weights, "term").groupBy("item_id").agg(F.sort_array(F.collect_list("tid")).alias("tids"))
    block = F.pmod(F.xxhash64("item_id"), F.lit(1 + wanted.count() // QUERIES))
    blocks = wanted.groupBy(block.alias("block")).agg(F.collect_list(F.struct("item_id", "tids")).alias("queries"))
    asks = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "queries")
    both = postings.withColumn("queries", F.lit(None).cast(asks.schema["queries"].dataType)).unionByName(asks, allowMissingColumns=True)

    def run(batches):
        own, parts, lists = None, [], None
        for b in batches:
            shard_of = b.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(shard_of)) + 1).tolist(), len(shard_of)]
            for a, z in zip(cuts, cuts[1:]):
                if a == z:
                    continue
                if shard_of[a] != own:
                    own, parts, lists = shard_of[a], [], None
                part = b.slice(a, z - a)
                post = part.filter(part.column(5).is_null())
                if post.num_rows:
                    parts.append(post.select([1, 2, 3, 4]))
                for queries in part.column(5).drop_null().to_pylist():
                    if not parts:
                        continue
                    if lists is None:
                        t = pa.Table.from_batches(parts)
                        tid, uid, impact = (t.column(i).to_numpy() for i in (0, 2, 3))
                        missing = t.column(1).is_null().to_numpy()
                        ids = t.column(1).fill_null(0).to_numpy()
                        first = np.unique(uid, return_index=True)[1]
                        first = first[np.lexsort((uid[first], ids[first], missing[first]))]
                        by_uid = np.argsort(uid[first])
                        lists = Lists(tid, by_uid[np.searchsorted(uid[first][by_uid], uid)], impact, len(first))
                        ids, missing, uids = ids[first], missing[first], uid[first]
                    out = []
                    for q in queries:
                        top, score, _ = lists.best(q["tids"], k)
                        out += [(q["item_id"], None if missing[d] else int(ids[d]), int(uids[d]), int(s)) for d, s in zip(top, score) if s > 0]
                    cols = list(zip(*out)) or [[], [], [], []]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["item_id", "doc_id", "uid", "score"])

    found = map_batches_whole(both.select("shard", "tid", "doc_id", "uid", "impact", "queries"), run, shards)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "uid")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def map_batches_whole(rows: DataFrame, run, shards: int) -> DataFrame:
    """``run`` over whole shards: postings first, then the queries."""
    from ..session import ship_package
    ship_package(rows.sparkSession)
    dealt = rows.repartition(max(shards, 2), "shard").sortWithinPartitions("shard", F.col("queries").isNotNull())
    return dealt.mapInArrow(run, "item_id long, doc_id long, uid long, score long")
