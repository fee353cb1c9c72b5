"""The pipeline's stages, each against what its input calls for."""

import collections

import numpy as np
import pytest

import corpus_pipeline as P
from innsight.llm import mixing, packing, quality
from innsight.llm.common import least_labels, table, written

from .data import SF, edge_docs
from .test_text_operators import brute_lines, brute_print


@pytest.mark.parametrize("frame", ["edge", "documents", "empty"])
def test_stages(spark, frame):
    docs = table(spark, SF, "documents") if frame == "documents" else edge_docs(spark)
    docs = docs.limit(0) if frame == "empty" else docs
    ins, outs = [], []
    for name, stage in P.STAGES:
        ins.append(docs)
        docs = written(stage(spark, docs, SF), name)
        outs.append(docs)
    assert [n for n, _ in P.STAGES] == ["quality_rules", "line_dedup", "simhash_near_dedup", "mix_sources", "pack_sequences"]
    assert all(o.schema == ins[0].schema for o in outs[:-1])
    if frame == "empty":
        assert outs[-1].count() == 0
        return
    key = "doc_id" if frame == "documents" else "odd name"
    ids = lambda d: sorted(r[key] for r in d.collect())
    # quality: those kept, whole
    kept = collections.Counter(r["doc_id"] for r in quality.quality(ins[0]).filter("kept").collect())
    assert collections.Counter(r["doc_id"] for r in outs[0].collect()) == kept
    if frame == "documents":
        rows = [(r["doc_id"], r["text"]) for r in ins[1].orderBy("doc_id").collect()]
        gone = brute_lines(rows)
        left = {k: "\n".join(x for j, x in enumerate(t.split("\n")) if j not in gone[k]) for k, t in rows}
        assert {r["doc_id"]: r["text"] for r in outs[1].collect()} == {k: t for k, t in left.items() if t.strip()}
    # one document of each group
    rows = [(r[key], brute_print(r["text"])) for r in ins[2].orderBy("doc_id", key).collect() if len(r["text"] or "") < 10_000]
    fp = np.array([x for _, x in rows], np.uint64)
    a, b = np.nonzero(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3)
    lab = least_labels(a, b, len(fp)).tolist()
    if frame == "documents":
        long = sum(len(r["text"]) >= 10_000 for r in ins[2].collect())
        assert len(ids(outs[2])) >= len(set(lab)) and len(ids(outs[2])) <= len(set(lab)) + long
    # the mix repeats documents, three times at most
    times = collections.Counter(ids(outs[3]))
    assert set(times) <= set(ids(ins[3])) and max(times.values()) <= 3
    # every mixed document is packed
    assert outs[4].filter("start = 0 and piece = 0").count() == ins[4].count()
    # a sequence has one position, and full, gapless places
    seqs = collections.defaultdict(list)
    for r in outs[4].collect():
        seqs[r["sequence_id"]].append((r["offset"], r["length"], r["position"]))
    for held in seqs.values():
        held.sort()
        assert len({p for _, _, p in held}) == 1 and 0 <= held[0][2] <= 1
        assert [o for o, _, _ in held] == np.cumsum([0] + [n for _, n, _ in held[:-1]]).tolist() and sum(n for _, n, _ in held) <= 2048
    assert P.ORACLE_SQL is None


def test_the_packed_corpus_keeps_the_curriculum(spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(f"w{x}" for x in rng.integers(0, 500, int(rng.integers(20, 700)))), "en", "abc"[i % 3], 0) for i in range(2400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mixed = written(P.mix_sources(spark, docs, SF), "mixed")
    at = mixing.positions(mixed, P.KNOTS, "at").collect()
    assert len(at) == mixed.count()
    # the words that each source has given by a time follow the integral of its schedule
    for source, share in (("a", lambda t: 1.5 * t - 0.5 * t * t), ("b", lambda t: t), ("c", lambda t: (1.5 * t + 1.5 * t * t) / 3)):
        given = sorted((r["at"], len(r["text"].split())) for r in at if r["source"] == source)
        total = sum(n for _, n in given)
        begin = np.cumsum([0] + [n for _, n in given[:-1]])
        assert np.allclose([share(t) for t, _ in given], begin / total, atol=1e-9)
    packed = P.pack_sequences(spark, mixed, SF)
    out = packed.collect()
    assert [r["position"] for r in out] == sorted(r["position"] for r in out)
    # a piece's own time lies close to its sequence's
    time = collections.defaultdict(list)
    for r in at:
        time[r["doc_id"]].append(r["at"])
    off = [min(abs(r["position"] - t) for t in time[r["doc_id"]]) for r in out]
    assert np.mean(off) < 0.12 and np.mean([o < 0.25 for o in off]) > 0.9
    free = packing.pack(mixed).select("sequence_id").distinct().count()
    assert len({r["sequence_id"] for r in out}) <= 1.03 * free + 1
