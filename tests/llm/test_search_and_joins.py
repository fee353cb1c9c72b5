"""Lexical search, tokenizer alignment and the n-gram Jaccard join against
brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from innsight.llm import alignment, lexical, setjoin
from innsight.llm.common import table

from .data import SF, edge_docs

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def lowered(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- lexical search ---------------------------------------------------------------------------------

def ranked(docs, items, k=10):
    terms = [TERM.findall(lowered(t)) for _, t in docs]
    n_docs, total = sum(map(bool, terms)), sum(map(len, terms))
    counts = [Counter(t) for t in terms]
    df = Counter(w for c in counts for w in c)
    asked = defaultdict(set)
    for i, t in items:
        asked[i] |= set(TERM.findall(lowered(t)))
    out = []
    for i, words in asked.items():
        scores = []
        for at, ((doc, _), c) in enumerate(zip(docs, counts)):
            n, s = sum(c.values()), 0
            for w in words & set(c):
                m = 100 - 90 + (90 * n * n_docs) // total
                s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((1000000000 * c[w]) // (1000 * c[w] + 8 * m))
            if s > 0:
                scores.append((-s, doc is None, doc or 0, at))
        out += [(i, r + 1, None if none else doc, -s) for r, (s, none, doc, _) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard", [lexical.SHARD, 40])
def test_search_equals_scoring_every_document(spark, shard):
    docs = edge_docs(spark)
    items = spark.createDataFrame([(1, "W1 w2 w2-w3, w4?", "x"), (2, None, "x"), (3, "", "x"), (1, "w5", "x"), (None, "lost ONE drei", "x"), (4, "unknown", "x"), (5, " ".join(f"w{i}" for i in range(120)), "x")],
                                  "item_id long, text string, doc_id string")
    got = rows_of(lexical.search(docs, items, shard=shard))
    assert got == ranked([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert any(r[0] is None for r in got)


def test_search_of_empty_tables(spark):
    docs, items = edge_docs(spark), table(spark, SF, "benchmark")
    assert lexical.search(docs.limit(0), items).count() == 0
    assert lexical.search(docs, items.limit(0)).count() == 0


def test_search_without_the_vocabulary_filter(spark, monkeypatch):
    monkeypatch.setattr(lexical, "VOCABULARY", 0)
    docs, items = table(spark, SF, "documents"), table(spark, SF, "benchmark")
    assert rows_of(lexical.search(docs, items)) == ranked([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])


def test_best_positions_stop_early_and_keep_ties():
    rng = np.random.default_rng(3)
    tid, doc, impact = [], [], []
    for t in range(4):
        who = rng.choice(20_000, 15_000, replace=False)
        tid += [t] * len(who)
        doc += who.tolist()
        impact += (1 + rng.pareto(1.2, len(who)) * 50).astype(int).tolist()
    lists = lexical.Lists(np.array(tid), np.array(doc), np.array(impact), 20_000)
    top, score, scored = lists.best([0, 1, 2, 3, 9], 10)
    total = np.bincount(doc, impact, 20_000).astype(int)
    want = np.lexsort((np.arange(20_000), -total))[:10]
    assert top.tolist() == want.tolist() and score.tolist() == total[want].tolist()
    assert scored < 5_000
    even = lexical.Lists(np.zeros(500, int), np.arange(500), np.full(500, 7), 500)  # ties: the first ids, all read
    assert even.best([0], 10)[0].tolist() == list(range(10)) and even.best([0], 10)[2] == 500


# --- alignment --------------------------------------------------------------------------------------

def aligned(docs):
    import sentencepiece
    from tokenizers import Tokenizer
    from innsight.llm.packing import byte_alphabet
    a_path, b_path = alignment.default_vocabularies()
    t = Tokenizer.from_file(a_path)
    t.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=b_path)
    alphabet = byte_alphabet()
    per, held = [], Counter()
    for doc, text in docs:
        spaced = (" " + (text or "")).encode()
        a = t.encode(spaced.decode(), add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        ab = [bytes(alphabet[c] for c in t.id_to_token(i)) for i in a]
        bb = [bytes([int(p[3:5], 16)]) if re.fullmatch(r"<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in map(sp.id_to_piece, b)]
        if b"".join(ab) != spaced or b"".join(bb) != spaced:
            a, b, ab, bb = [], [], [], []
        cut = lambda ids, parts: [(i, s, s + len(p)) for (i, p), s in zip(zip(ids, parts), np.cumsum([0] + [len(p) for p in parts]))]
        ca, cb = cut(a, ab), cut(b, bb)
        ends = sorted({e for *_, e in ca} & {e for *_, e in cb})
        links, j0 = [], 0
        for i, s, e in ca:
            while j0 < len(cb) and cb[j0][2] <= s:
                j0 += 1
            j = j0
            while j < len(cb) and cb[j][1] < e:
                links.append((i, cb[j][0]))
                j += 1
        groups = []
        for lo, hi in zip([0, *ends], ends):
            groups.append(",".join(str(i) for i, s, _ in ca if lo <= s < hi) + "|" + ",".join(str(i) for i, s, _ in cb if lo <= s < hi))
        held.update(set(links))
        per.append((doc, len(a), len(b), len(ends), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    best = defaultdict(int)
    for (a, _), c in held.items():
        best[a] = max(best[a], c)
    return held, sorted(((doc, na, nb, g, len(k), sum(held[p] == best[p[0]] for p in k), sum(held[p] for p in k), sha) for doc, na, nb, g, k, sha in per), key=repr)


def test_alignment_equals_brute_force(spark):
    docs = edge_docs(spark).filter("length(text) < 5000 or text is null").select("doc_id", "text", F.lit(1).alias("chunk"))
    more = spark.createDataFrame([(90, "<|endoftext|> a　b ﬁ   x", 1), (91, " spaced  out ", 1), (92, "日本語 \U0001f600", 1), (93, "</s><s><unk>", 1), (94, "▁ under", 1)], "doc_id long, text string, chunk int")
    docs = docs.union(more)
    held, want = aligned([tuple(r)[:2] for r in docs.collect()])
    for chunk, links in ((alignment.CHUNK, alignment.LINKS), (8, 100), (16, 10**9)):
        assert rows_of(alignment.align(docs, chunk=chunk, links=links)) == want
    counts = alignment.pair_counts(alignment.bitmaps(docs, chunk=16))
    assert {(r["a"], r["b"]): r["documents"] for r in counts.collect()} == dict(held)
    assert sum(r["links"] for r in counts.collect()) == sum(r[4] for r in want)
    assert any(r[1] == 0 and r[7] == "" for r in want)


def test_alignment_of_a_very_long_text_and_none(spark):
    text = " ".join(random.Random(2).choice(["alpha", "Beta", "gam", "12", "é"]) for _ in range(100_000))
    docs = spark.createDataFrame([(1, text), (2, "alpha Beta")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in alignment.align(docs).collect()}
    assert got[1]["n_groups"] >= 100_000 and got[2]["count_sum"] >= got[2]["n_links"]
    assert alignment.align(docs.limit(0)).count() == 0


def test_containers_hold_what_went_in():
    rng = np.random.default_rng(1)
    keys = np.unique(np.concatenate([(np.uint64(p) << np.uint64(16)) | rng.choice(64, n, replace=False).astype(np.uint64) for p, n in ((3, 1), (9, 64), (10, 40), (70, 4), (71, 60))]))
    pairs, cards, held = alignment.containers(keys, 64)
    cards = np.frombuffer(cards, "<u2").astype(np.int64)
    assert np.frombuffer(pairs, "<u4").tolist() == [3, 9, 10, 70, 71] and cards.tolist() == [1, 64, 40, 4, 60]
    assert alignment.opened(cards, held, 64).tolist() == (keys & np.uint64(0xFFFF)).tolist()


# --- n-gram Jaccard join ----------------------------------------------------------------------------

def joined(docs, size=3, percent=90):
    sets = []
    for _, text in docs:
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", lowered(text)) if x]
        sets.append({" ".join(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    label = list(range(len(docs)))
    by = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            by[g].append(i)
    meet = Counter((a, b) for v in by.values() for k, a in enumerate(v) for b in v[k + 1:])
    for (a, b), o in meet.items():
        if 100 * o >= percent * (len(sets[a]) + len(sets[b]) - o):
            la, lb = label[a], label[b]
            label = [la if x == lb else x for x in label]
    least = {}
    for (d, _), x in zip(docs, label):
        if d is not None:
            least[x] = min(least.get(x, d), d)
    return sorted(((d, len(s), least.get(x)) for (d, _), s, x in zip(docs, sets, label)), key=repr)


def near_copies(spark, base, copies, edits, start=1000, seed=4):
    rng = random.Random(seed)
    words = base.split()
    rows = []
    for i in range(copies):
        w = list(words)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10**6)}"
        rows.append((start + i, " ".join(w)))
    return spark.createDataFrame(rows, "doc_id long, text string")


@pytest.mark.parametrize("block", [setjoin.BLOCK, 3])
def test_join_equals_brute_force_on_edge_rows(spark, block, monkeypatch):
    monkeypatch.setattr(setjoin, "SLICE", 16)
    docs = edge_docs(spark).select("doc_id", "text", F.lit("c").alias("cls"))
    base = " ".join(f"b{i}" for i in range(150))
    other = " ".join(f"b{i % 90}" for i in range(160))
    docs = docs.union(near_copies(spark, base, 40, 5).withColumn("cls", F.lit("c"))).union(near_copies(spark, other, 25, 7, 2000).withColumn("cls", F.lit("c")))
    docs = docs.union(spark.createDataFrame([(3000, "One", "c"), (3001, "two words", "c"), (3002, "two  WORDS", "c"), (3003, "É two", "c")], "doc_id long, text string, cls string"))
    want = joined([tuple(r)[:2] for r in docs.collect()])
    assert rows_of(setjoin.link(docs, block=block)) == want
    assert len({r[2] for r in want if r[0] and 1000 <= r[0] < 2000}) > 1


def test_join_equals_brute_force_on_documents(spark):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    for size, percent in ((3, 90), (2, 60)):
        assert rows_of(setjoin.link(docs, size, percent)) == joined([tuple(r) for r in docs.collect()], size, percent)
    assert setjoin.link(docs.limit(0)).count() == 0
