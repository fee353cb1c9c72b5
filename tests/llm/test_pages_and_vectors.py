"""The WARC archive and the vector search against brute force."""

import base64
import collections
import hashlib

import numpy as np
import pytest

from innsight.llm import ann, warc
from innsight.llm.common import join_spread, table

from .data import SF


def records(rows, least):
    payload = [(i, u, (h or "").encode()) for i, u, h in rows]
    head = {}
    for i, _, b in payload:
        head[b] = max((x for x in (head.get(b), i) if x is not None), default=None)
    out, used = [], set()
    for i, u, b in sorted(payload, key=lambda r: (r[1] is not None, r[1] or "")):
        first = len(b) < least or (i == head[b] and b not in used)
        if first and len(b) >= least:
            used.add(b)
        out.append((repr(i), len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if first else "revisit", repr(None if first else head[b])))
    return sorted(out)


@pytest.mark.parametrize("least", [0, 2])
def test_archive_round_trip(spark, least):
    rows = [(1, "u", "x"), (2, "u", "x"), (2, "v", "x"), (2, "v", "long body"), (None, None, None), (None, "q", ""), (5, "a\r\nWARC-Type: fake", "é" * 5000), (6, "w", "é" * 5000), (6, "w", "é" * 5000)]
    for frame, want in ((spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, key string"), rows), (table(spark, SF, "pages"), None)):
        want = want or [(r["page_id"], r["url"], r["html"]) for r in frame.collect()]
        path = warc.archive_path(spark)
        warc.write(frame, path, least)
        got = warc.read(spark, path, with_bytes=True).collect()
        assert sorted((repr(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], repr(r["refers_to"])) for r in got) == records(want, least)
        bodies = collections.Counter((h or "").encode() for _, _, h in want)
        assert spark.read.parquet(f"{path}/payloads").count() == len(bodies)
        for r in got:
            head, _, body = bytes(r["record"]).partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\nWARC-Type: " + r["record_type"].encode()) and body.endswith(b"\r\n\r\n")
            assert (body[:-4] in bodies) if r["record_type"] == "response" else body == b"\r\n\r\n"
    path = warc.archive_path(spark)
    warc.write(frame.limit(0), path)
    assert warc.read(spark, path).count() == 0


def test_changed_payload_is_found(spark):
    path = warc.archive_path(spark)
    warc.write(spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string"), path)
    spark.read.parquet(f"{path}/payloads").selectExpr("key", "cast('abd' as binary) as payload").write.parquet(f"{path}/other")
    import os
    os.rename(f"{path}/payloads".removeprefix("file:"), f"{path}/old".removeprefix("file:"))
    os.rename(f"{path}/other".removeprefix("file:"), f"{path}/payloads".removeprefix("file:"))
    with pytest.raises(Exception, match="does not match"):
        warc.read(spark, path).collect()


def brute(rows, k=20):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    longest = max((len(v) for _, v in ok), default=0)
    ok = [(i, v) for i, v in ok if len(v) == longest]
    out = {}
    for q, x in ok:
        if q % 20 == 0:
            near = {}
            for i, v in ok:
                if i != q:
                    near[i] = max(near.get(i, -np.inf), float(x @ v))
            out[q] = sorted(((-s, i) for i, s in near.items()))[:k]
    return out


def test_search_edge_cases_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=4).round(2).tolist()) for i in range(70)]
    rows += [(80, [1.0, 0, 0, 0]), *[(100 + i, [1.0, 0, 0, 0]) for i in range(45)], (60, None), (61, []), (62, [0.0] * 4), (63, [1.0, None, 0, 0]), (64, [float("nan"), 0, 0, 1]), (65, [float("inf"), 0, 0, 1]), (66, [9.0, 9.0]), (None, [5.0] * 4), (3, rows[3][1])]
    rows = [(i, v and [None if x is None else float(x) for x in v]) for i, v in rows]
    d = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, list string")
    got = collections.defaultdict(list)
    for r in ann.search(d).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    want = brute(rows)
    assert got.keys() == want.keys()
    for q, near in want.items():
        assert [x[0] for x in got[q]] == list(range(1, len(near) + 1))
        assert [x[1] for x in got[q]] == [i for _, i in near] and np.allclose([x[2] for x in got[q]], [-s for s, _ in near])
    assert ann.search(d.limit(0)).count() == 0


def test_one_longer_vector_takes_no_part(spark):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=4).tolist()) for i in range(60)]
    kinds = "vec_id long, embedding array<double>"
    found = lambda x: sorted(map(tuple, ann.search(spark.createDataFrame(x, kinds)).collect()))
    got = found([*rows, (100, [1.0] * 5), (101, [2.0] * 3)])
    assert len(got) == 60 and got == found(rows)


def test_search_recall(spark):
    d = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = [(r["vec_id"], r["embedding"]) for r in d.select("vec_id", "embedding").collect()]
    want = brute(rows)
    got = collections.defaultdict(set)
    for r in ann.search(d).collect():
        got[r["query_id"]].add(r["vec_id"])
    hits = sum(len(got[q] & {i for _, i in near}) for q, near in want.items())
    assert hits >= 0.9 * sum(map(len, want.values())) and all(len(got[q]) == len(near) for q, near in want.items())


def test_join_spread_keeps_every_row(spark):
    big = spark.range(5000).selectExpr("case when id % 3 = 0 then 7 else id end as k", "id as salt")
    small = spark.createDataFrame([(7, "hot"), (8, "a"), (4000, "b")], "k long, v string")
    out = join_spread(big, small, ["k"], big["salt"])
    assert out.columns == ["k", "salt", "v"] and sorted(map(tuple, out.collect())) == sorted((7 if i % 3 == 0 else i, i, {7: "hot", 8: "a", 4000: "b"}[7 if i % 3 == 0 else i]) for i in range(5000) if i % 3 == 0 or i in (7, 8, 4000))
