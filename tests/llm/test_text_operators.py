"""Operators on documents against brute force, edge cases included."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from innsight.llm import common, lines, lm, mixing, packing, quality, secrets, simhash, substring
from innsight.llm.common import components, least_labels, table, written
from innsight.llm.queries import KNOTS

from .data import SF, edge_docs


@pytest.fixture(scope="module")
def docs(spark):
    return edge_docs(spark).cache()


def both(spark, docs):
    """The edge frame and the driver's documents."""
    return [docs, table(spark, SF, "documents")]


# mixing

def test_mix_targets_and_caps(spark, docs):
    for d in both(spark, docs):
        p = mixing.plan(d.select("doc_id", "source", "text"), KNOTS).collect()
        size = collections.Counter()
        for r in p:
            assert r["size"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) and 0 <= r["taken"] <= 3 * r["size"]
            size[r["source"]] += r["size"]
        total, w = sum(size.values()), {s: 1 + i % 3 for i, s in enumerate(sorted(size, key=lambda s: (s is None, (s or "").encode())))}
        goal, open_ = {s: 0.0 for s in size}, set(size)
        while open_:  # share, cap, share the rest
            rest = total - sum(goal[s] for s in size if s not in open_)
            share = {s: rest * w[s] / sum(w[x] for x in open_) for s in open_}
            full = {s for s in open_ if share[s] > 3 * size[s]}
            goal |= {s: 3 * size[s] if s in full else share[s] for s in open_}
            if not full:
                break
            open_ -= full
        taken = collections.Counter()
        for r in p:
            assert math.isclose(r["target"], goal[r["source"]], rel_tol=1e-9, abs_tol=1e-6) and r["source_size"] == size[r["source"]]
            taken[r["source"]] += r["taken"]
            assert sum(c["words"] for c in r["copies"] or []) == r["taken"]
            times = [c["time"] for c in r["copies"] or []]
            assert times == sorted(times) and all(0 <= t <= 1 for t in times)
        assert all(abs(taken[s] - goal[s]) <= 1 for s in size)


def test_time_inverts_the_integral(spark):
    for knots in KNOTS + [[(0, 0.0), (0.5, 2.0), (1, 0.0)], [(0, 0.0), (0.4, 0.0), (0.4001, 3.0), (1, 3.0)]]:
        k = F.array(*[F.struct(F.lit(float(t)).alias("t"), F.lit(float(w)).alias("w")) for t, w in knots])
        t, w = np.array(knots, float).T
        area = ((w[1:] + w[:-1]) / 2 * np.diff(t)).sum()
        rows = spark.range(0, 101).select((F.col("id") / 100).alias("u"), mixing.segments(k).alias("s")).select("u", mixing.time_of(F.col("s"), F.lit(float(area)), F.col("u")).alias("x")).collect()
        for r in rows:
            grid = np.unique(np.append(t[t < r["x"]], r["x"]))
            y = np.interp(grid, t, w)
            assert abs(((y[1:] + y[:-1]) / 2 * np.diff(grid)).sum() / area - r["u"]) < 1e-6


def test_mix_rows_are_whole_documents(spark, docs):
    m = mixing.mix(docs, KNOTS)
    assert m.columns == docs.columns and m.schema == docs.schema
    had = {tuple(r) for r in docs.collect()}
    got = [tuple(r) for r in m.collect()]
    assert set(got) <= had and max(collections.Counter(got).values()) <= 6  # two equal rows, three times each
    assert mixing.mix(docs.limit(0), KNOTS).count() == 0


# secrets

PATTERNS = [("assign", re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A), 2, 6), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24)]


def test_secrets(spark):
    far = " filler" * 60
    cases = {
        1: "é token = abcdef0 x secret:token:abcdef PASSWD='qwe' api_key=ZZZZZZ", 2: "AKIAAKIA AKIA" + "Q" * 16 + " " + "0f" * 40, 3: None, 4: "",
        5: "user=bob pwd=hunter22", 6: "user=bob" + far + " pwd=hunter22", 7: "https://db.example.net:5432 user: bob, secret=abcdefgh" + far + "ftp://alone.example.org",
        8: "AKIA" + "B" * 16 + "\n" + "aB3/" * 10, 9: "aB3/" * 10, 10: "token=" + "aB3/" * 10, 11: "x" * 50_000 + " user=ali pass=abcdefg",
    }
    d = spark.createDataFrame([(i, t, "z") for i, t in cases.items()] + [(5, cases[5], "z")], "doc_id long, text string, k1 string")
    got = collections.defaultdict(list)
    for r in secrets.scan(d).collect():
        got[r["doc_id"]].append(r)
    assert len(got[5]) == 2 and got[5][0] == got[5][1]
    for i, t in cases.items():
        want = sorted((m.start(), n, m.end()) for n, (_, p, g, least) in enumerate(PATTERNS) for m in p.finditer(t or "") if len(m.group(g)) >= least)
        assert [tuple(x) for x in got[i][0]["base"]] == [(PATTERNS[n][0], s, e) for s, n, e in want], i
        assert {tuple(x) for x in got[i][0]["base"]} <= {tuple(x) for x in got[i][0]["spans"]}
    kinds = {i: [x["kind"] for x in got[i][0]["spans"]] for i in cases}
    assert kinds[5] == ["account", "phrase"] and kinds[6] == [] and kinds[7] == ["endpoint", "account", "assign"]
    assert kinds[8] == ["access", "bare"] and kinds[9] == [] and kinds[10] == ["assign"] and kinds[11] == ["bare", "account", "phrase"]
    assert secrets.scan(d.limit(0)).count() == 0


# quality

def test_quality_counts(spark, docs):
    for d in both(spark, docs):
        out = quality.quality(d).collect()
        assert len(out) == d.count()
        byid = collections.defaultdict(list)
        for r in out:
            byid[r["doc_id"]].append(r)
        for r in d.collect():
            if r["doc_id"] is None:
                continue
            t = r["text"] or ""
            w = re.findall(r"[^\x20\x09-\x0D]+", t)
            own = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
            grams = collections.Counter(zip(w, w[1:], w[2:]))
            hit = {j for i, g in enumerate(zip(w, w[1:], w[2:])) if grams[g] > 1 for j in (i, i + 1, i + 2)}
            want = (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(own) - len(set(own)), len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w))
            for q in byid[r["doc_id"]]:
                assert (q["n_words"], q["word_chars"], q["n_symbols"], q["n_dup_lines"], q["n_repeat_words"], q["base_failed"]) == want
                assert not (q["base_failed"] and q["kept"])
    kept = quality.keep_good(docs)
    assert kept.schema == docs.schema and {r["odd name"] for r in kept.collect()} <= {r["odd name"] for r in docs.collect()}
    assert quality.quality(docs.limit(0)).count() == 0 and quality.keep_good(docs.limit(0)).count() == 0


def test_quality_rejects_the_odd_one(spark):
    good = " ".join("the cat of a house and the dog went to it with no words that is for them".split() * 1)
    words = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}on" for i in range(500)]
    rows = [(i, " ".join(x for j in range(60) for x in (words[(i * 7 + j * 3) % 500], ("the", "of", "and", "to")[(i + j) % 4])) + good, "en") for i in range(60)]
    rows.append((99, " ".join(f"{i}#%${i * i}&&" for i in range(80)), "en"))
    kept = {r["doc_id"]: r["kept"] for r in quality.quality(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert kept.pop(99) is False and all(kept.values())


def test_quality_by_every_language(spark):
    pick = lambda words, i: " ".join(words[(i * 7 + j * j) % len(words)] for j in range(80))
    english = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}on" for i in range(200)] + ["the", "of", "and"] * 40
    russian = [f"{chr(1072 + i % 30)}{chr(1072 + i // 30)}ние" for i in range(200)]
    rows = [(i, pick(english, i), "en") for i in range(300)] + [(1000 + i, pick(russian, i), "ru") for i in range(60)]
    rows += [(2000, " ".join(f"{i}#%${i * i}&&" for i in range(80)), "ru"), (2001, pick(russian, 99), None), (2002, pick(russian, 98), "uk")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = {r["doc_id"]: r for r in quality.quality(docs).collect()}
    assert all(out[1000 + i]["kept"] for i in range(60)) and out[1000]["class_distance"] < 0.3
    assert not out[2000]["kept"] and not out[2000]["base_failed"]
    assert out[2001]["kept"] and out[2002]["kept"] and out[2001]["class_distance"] is None and out[2002]["class_distance"] is None
    assert len(out) == len(rows) == quality.keep_good(docs).count() + 1


def test_quality_sql_states_every_language(spark, tmp_path):
    import duckdb

    from innsight.llm import queries
    pick = lambda words, i: " ".join(words[(i * 7 + j * j) % len(words)] for j in range(80))
    latin = [f"{chr(97 + i % 26)}{chr(97 + i // 26)}on" for i in range(200)]
    letters = [f"{chr(1072 + i % 30)}{chr(1072 + i // 30)}ние" for i in range(200)]
    few = {"en": ["the", "of", "and"], "fr": ["le", "de", "et"], "de": ["der", "und", "die"], "es": ["el", "de", "y"], "ru": []}
    junk = " ".join(f"{i}#%${i * i}&&" for i in range(80))
    rows = []
    for k, (lang, common) in enumerate(few.items()):
        source = letters if lang == "ru" else latin + common * 40
        rows += [(1000 * k + i, pick(source, i), lang) for i in range(60)] + [(1000 * k + 900, junk, lang), (1000 * k + 901, pick(letters, 5), lang), (1000 * k + 902, None, lang)]
    rows += [(9000 + i, pick(letters, i), "uk") for i in range(49)] + [(9100, pick(latin, 3), None), (9101, junk, None), (9102, "", None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = queries.QUERIES["op10_divergence_rules"](spark, str(tmp_path)).toPandas().sort_values("doc_id").reset_index(drop=True)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(queries.ORACLES["op10_divergence_rules"]).df().sort_values("doc_id").reset_index(drop=True)
    assert len(got) == len(want) == len(rows)
    for c in want.columns:
        a, b = got[c], want[c]
        assert (a.isna() == b.isna()).all() and (a.dropna().round(5) == b.dropna().round(5)).all(), c
    kept = dict(zip(got["doc_id"], got["kept"]))
    assert all(kept[4000 + i] for i in range(60)) and not kept[4900] and all(kept[9000 + i] for i in range(49))


# lines

def brute_lines(rows, long=lines.LONG):
    seen, out = set(), {}
    for i, (key, text) in enumerate(rows):
        ls = [(j, x.strip(" \t\n\r\x0b\x0c")) for j, x in enumerate((text or "").split("\n"))]
        ls = [x for x in ls if x[1]]
        runs = [((a[1], b[1]), a[0], b[0]) for a, b in zip(ls, ls[1:])] + [(x, j, j) for j, x in ls if len(re.findall(r"[^\x20\x09-\x0D]+", x)) >= long]
        gone = set()
        for g, a, b in sorted(runs, key=lambda r: r[1]):
            if g in seen:
                gone |= set(range(a, b + 1))
            seen.add(g)
        out[key] = sorted(gone)
    return out


def test_lines(spark, docs):
    text = ["a\nb\nc", "x\na\nb\n\nc\ny", "a\nc", "a\nb", "b\nc\nb\nc", None, "", " b \n\tc", "k " * 40, "q\n" + "k " * 40]
    d = spark.createDataFrame([(i, t, i) for i, t in enumerate(text)], "doc_id long, text string, gone int")
    for frame in (d, table(spark, SF, "documents")):
        rows = [(r["doc_id"], r["text"]) for r in frame.orderBy("doc_id").collect()]
        want = brute_lines(rows)
        out = lines.dedup(frame, marks=True)
        got = {r[0]: (list(r[-1]), r["text"]) for r in out.collect()}
        assert {k: v[0] for k, v in got.items()} == want
        for k, t in rows:
            assert got[k][1] == (t if not want[k] else "\n".join(x for j, x in enumerate(t.split("\n")) if j not in want[k]))
    out = lines.dedup(docs, drop_emptied=True)
    assert out.schema == docs.schema and lines.dedup(docs.limit(0)).count() == 0
    same = [r["text"] for r in out.filter("doc_id = 2").collect()]
    assert same == []  # the copy of document 1


def test_every_repeated_line_is_a_run_from_one_word(spark):
    frame = table(spark, SF, "documents")
    out = lines.dedup(frame, long_words=1, marks=True).collect()
    assert {r["doc_id"]: list(r["gone"]) for r in out} == brute_lines([(r["doc_id"], r["text"]) for r in frame.orderBy("doc_id").collect()], 1)
    left = collections.Counter(s for r in out for x in (r["text"] or "").split("\n") if (s := x.strip(" \t\n\r\x0b\x0c")))
    assert set(left.values()) == {1}


# simhash

def brute_print(text, n=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i:i + n]).encode(), 42) for i in range(max(1, len(w) - n + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(spark, docs):
    for d in both(spark, docs):
        rows = [(r["doc_id"], brute_print((r["text"] or "")[:10_000])) for r in d.collect() if len(r["text"] or "") < 10_000]
        short = d.filter("coalesce(length(text), 0) < 10000")
        fp = np.array([x for _, x in rows], np.uint64)
        a, b = np.nonzero(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3)
        lab = least_labels(a, b, len(fp))
        least = {}
        for (i, _), l in zip(rows, lab.tolist()):
            least[l] = min((x for x in (least.get(l), i) if x is not None), default=None)
        want = sorted((repr(i), x, repr(least[l])) for (i, x), l in zip(rows, lab.tolist()))
        assert sorted((repr(r["doc_id"]), r["fp"] % 2**64, repr(r["component_id"])) for r in simhash.near_duplicates(short).collect()) == want
        kept = simhash.keep_one(short)
        assert kept.schema == short.schema and kept.count() == len(set(lab.tolist()))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0 and simhash.keep_one(docs.limit(0)).count() == 0


def test_golay_keys_miss_no_link():
    rng, t = np.random.default_rng(3), simhash.golay_tables()
    for bits in range(4):
        x = rng.integers(0, 2**63, 2000, dtype=np.uint64)
        y = x.copy()
        for _ in range(bits):
            y ^= np.uint64(1) << rng.integers(0, 64, 2000, dtype=np.uint64)
        a, b = (set(zip(r.tolist(), k.tolist())) for r, k in (simhash.fuzzy_keys(x, t), simhash.fuzzy_keys(y, t)))
        assert len({r for r, _ in a & b}) == 2000


@pytest.mark.parametrize("block", [5, 64, 4096])
def test_simhash_blocks(spark, block):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**62, 4)
    z = sorted({int(b) ^ (1 << int(i)) ^ (1 << int(j)) ^ (1 << int(k)) for b in base for i, j, k in rng.integers(0, 62, (150, 3))})
    fp = np.array(z, np.uint64)
    a, b = np.nonzero(np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3)
    lab = least_labels(a, b, len(z))
    comp = {r["node"]: r["component"] for r in components(simhash.links(spark.createDataFrame([(x,) for x in z], "fp long"), 3, block)).collect()}
    assert [comp.get(x, x) for x in z] == [z[i] for i in lab.tolist()]


def test_components_of_a_long_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1300)] + [(5000, 5000), (-7, 3000), (3000, -7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(201)} | {i: 1000 for i in range(1000, 1300)} | {-7: -7, 3000: -7}


# substring

@pytest.mark.parametrize("block", [3, 512])
def test_lines_of_paragraphs(spark, block):
    d = table(spark, SF, "documents")
    held = []
    for r in d.collect():
        t = (r["text"] or "").encode().lower()
        w = t.split()
        held += [(r["doc_id"], at, frozenset(tuple(w[i:i + 5]) for i in range(at, at + n - 4))) for at, n in substring.line_places(t) if n >= substring.LINE]
    a, b = [], []
    for i, x in enumerate(held):
        for j in range(i):
            both_ = len(x[2] & held[j][2])
            if both_ and both_ >= 0.8 * (len(x[2]) + len(held[j][2]) - both_) - 1e-9:
                a.append(i)
                b.append(j)
    lab = least_labels(np.array(a, int), np.array(b, int), len(held)).tolist()
    size = collections.Counter(lab)
    want = collections.defaultdict(set)
    for x, l in zip(held, lab):
        if size[l] > 1:
            want[l].add(x[:2])
    got = collections.defaultdict(set)
    for r in substring.repeated(d, block=block).filter("kind = 'line'").collect():
        got[r["cluster"]].add((r["doc_id"], r["first_word"]))
    assert {frozenset(v) for v in got.values()} == {frozenset(v) for v in want.values()}


def test_passages_in_the_middle_of_lines(spark, docs):
    rng = np.random.default_rng(4)
    words = lambda n: " ".join(f"x{i}" for i in rng.integers(0, 10**6, n))
    passage = words(51)
    rows = [(i, words(150) + " " + passage + " " + words(130)) for i in range(6)] + [(10 + i, words(300)) for i in range(20)] + [(50, None), (51, ""), (None, passage)]
    out = substring.repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in out} == {0, 1, 2, 3, 4, 5, None}
    kept = collections.Counter(r["cluster"] for r in out if r["kept"])
    assert set(kept.values()) == {1} and all(r["cluster_doc"] == 0 for r in out if r["kind"] == "stretch")
    assert substring.repeated(docs).count() > 0 and substring.repeated(docs.limit(0)).count() == 0
    assert (1 - 0.8 ** 2) ** substring.tune_bands() <= 0.001


def test_short_lines_wrapped_paragraphs_and_short_texts(spark):
    rng = np.random.default_rng(6)
    words = lambda n: [f"x{i}" for i in rng.integers(0, 10**6, n)]
    wrap = lambda w: "\n".join(" ".join(w[i:i + 9]) for i in range(0, len(w), 9))
    line, short, brief, some, far = words(15), words(15), words(3), words(45), words(60)
    line2 = [*line[:14], "other"]  # 10 of 12 shingles
    text = {
        1: " ".join(words(30)) + "\n" + " ".join(line) + "\n" + " ".join(words(30)), 2: " ".join(words(40)) + "\n" + " ".join(line2),
        3: " ".join(short), 4: " ".join(short), 5: " ".join(brief), 6: " ".join(brief), 7: " ".join(words(12)),
        8: wrap(some), 9: wrap(["new", *some[:-1]]), 10: wrap(far) + "\n\n" + " ".join(words(50)), 11: " ".join(words(50)) + "\n \n" + " ".join([*far[:-1], "end"])}
    assert substring.block_places(text[8].encode()) == [(0, 45)] and substring.block_places(text[10].encode()) == [(0, 60), (60, 50)]
    out = substring.repeated(spark.createDataFrame(list(text.items()), "doc_id long, text string")).collect()
    linked = collections.defaultdict(set)
    for r in out:
        linked[r["kind"], r["cluster"]].add((r["doc_id"], r["first_word"], r["n_words"]))
    got = {(k, frozenset(v)) for (k, _), v in linked.items()}
    assert ("line", frozenset({(1, 30, 15), (2, 40, 15)})) in got
    assert {("line", frozenset({(3, 0, 15), (4, 0, 15)})), ("stretch", frozenset({(3, 0, 15), (4, 0, 15)})), ("stretch", frozenset({(5, 0, 3), (6, 0, 3)}))} <= got
    assert {("block", frozenset({(8, 0, 45), (9, 0, 45)})), ("block", frozenset({(10, 0, 60), (11, 50, 60)}))} <= got
    assert 7 not in {r["doc_id"] for r in out}


def test_shingles_without_a_step_a_word(monkeypatch):
    rng = np.random.default_rng(8)
    data = rng.integers(0, 256, 5000).astype(np.uint8).tobytes()
    starts = rng.integers(0, 4000, 600)
    stops = starts + np.arange(600) % 200
    for seed in (0, 1, 3):
        assert substring.hashes(data, starts, stops, seed).tolist() == [xxhash.xxh3_64_intdigest(data[a:z], seed) for a, z in zip(starts.tolist(), stops.tolist())]
    word = lambda: "x" * int(rng.choice([1, 2, 9, 60])) + str(rng.integers(0, 30))
    some = ["", " \n\t", "a b c d", "\x0bÉ\x1cb  c\r\nd\x0ce\n", *["".join(word() + str(rng.choice([" ", " ", "\t ", "\n", "\n \n"])) for _ in range(n)) for n in (5, 6, 14, 33, 34, 35, 400)]]
    held = [x.encode().lower() for x in some]
    t = substring.Texts(held)
    h, many = t.shingles()
    for i, x in enumerate(held):
        words, own = x.split(), h[t.first[i]:t.first[i] + many[i]]
        want = [xxhash.xxh3_64_intdigest(b" ".join(words[j:j + 5])) for j in range(max(1, len(words) - 4))] if words else []
        assert own.tolist() == want and t.first[i + 1] - t.first[i] == len(words)
        assert [n for text, n in zip(t.text, t.n) if text == i] == [len(y.split()) for y in x.split(b"\n")]
        if words:
            places = {max(k for k in range(j, min(j + 30, len(want))) if want[k] == min(want[j:j + 30])) for j in range(max(1, len(want) - 29))}
            assert (substring.anchors(h, t.first[i:i + 1], many[i:i + 1], 30) - t.first[i]).tolist() == sorted(places)
    same = np.array([3, 1, 1, 5, 1, 7], np.uint64)
    assert substring.anchors(same, np.array([0]), np.array([6]), 3).tolist() == [2, 4] and substring.anchors(same, np.array([0, 3]), np.array([3, 3]), 30).tolist() == [2, 4]

    steps, digest = [], xxhash.xxh3_64_intdigest
    monkeypatch.setattr(xxhash, "xxh3_64_intdigest", lambda *a: steps.append(1) or digest(*a))
    line = lambda: " ".join(f"word{i}" for i in rng.integers(0, 10**6, 30))
    text = pa.array(["\n".join(line() for _ in range(20)) for _ in range(20)])
    ids = pa.array(range(20), pa.int64())
    out = list(substring._paragraphs(11, 2, 5, 15, 30)(pa.RecordBatch.from_arrays([ids, ids, ids, text], ["k1", "k2", "doc_id", "text"])))
    assert sum(b.num_rows for b in out) > 800 and len(steps) < 500  # of 12,000 words: the lines' classes


def test_classes_that_collide_in_several_bands_are_compared_once(spark, monkeypatch):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(30):
        w = [f"x{k}" for k in rng.integers(0, 10**6, 60)]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join([*w[:-1], "other"]))]
    seen = {}
    monkeypatch.setattr(substring, "written", lambda df, name: seen.setdefault(name, written(df, name)))
    out = substring.repeated(spark.createDataFrame(rows, "doc_id long, text string")).filter("kind = 'line'").collect()
    pairs = collections.defaultdict(set)
    for r in out:
        pairs[r["cluster"]].add(r["doc_id"])
    assert sorted(map(sorted, pairs.values())) == [[2 * i, 2 * i + 1] for i in range(30)]
    assert seen["collisions"].count() == 60


@pytest.mark.parametrize("few", [0, 8])
def test_links_of_few_and_many(monkeypatch, few):
    monkeypatch.setattr(substring, "FEW", few)
    rng = np.random.default_rng(10)
    for n in (1, 2, 3, 8, 9):
        for _ in range(40):
            sets = [np.unique(rng.integers(0, 12, rng.integers(1, 12))).astype(np.uint64) for _ in range(n)]
            close = [(i, j) for i in range(n) for j in range(i) if 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))]
            edges = substring.link_sets(list(range(n)), sets, 0.8)
            label = lambda e: least_labels(np.array([x[0] for x in e], int), np.array([x[1] for x in e], int), n).tolist()
            assert label(edges) == label(close) and len(edges) == n - len(set(label(close)))


@pytest.mark.parametrize("shares", [3, 10_000])
def test_counted_join_of_a_hot_key(spark, monkeypatch, shares):
    monkeypatch.setattr(common, "SHARES", shares)
    big = spark.createDataFrame([(7 if i % 2 else i, i, i % 5) for i in range(400)] + [(None, 1, 1)], "k long, uid long, _salt long")
    small = big.filter("k is not null and (k = 7 or k % 3 = 0)").groupBy("k").count().selectExpr("k", "k + 1 as `_Salts`", "count")
    got = common.join_counted(big, small, "k", big["uid"])
    assert got.columns == ["k", "uid", "_salt", "_Salts"]
    assert sorted(map(tuple, got.collect())) == sorted((k, i, s, k + 1) for k, i, s in map(tuple, big.collect()) if k is not None and (k == 7 or k % 3 == 0))
    assert common.join_counted(big, small.limit(0), "k", big["uid"]).count() == 0


# packing

def test_packing(spark, docs):
    path = packing.default_vocabulary()
    fast, library = packing.encoder(path), packing.encoder(path, True)
    for x in ["<|endoftext|> a<|endoftext|>", "a" * 3000, " \n\t x  ", "", "Ünï  日本 🙂 don't 1234"]:
        assert fast(x) == library(x)
    for d in both(spark, docs):
        out = packing.pack(d).collect()
        want = collections.Counter()
        for r in d.collect():
            ids = library(r["text"] or "") + [0]
            cuts = [0, *range((len(ids) - 1) % 2048 + 1, len(ids) + 1, 2048)]
            for i, (a, z) in enumerate(zip(cuts, cuts[1:])):
                want[(r["doc_id"], i, a, z - a, zlib.crc32(np.array(ids[a:z], "<u4").tobytes()), tuple(ids[a:z]))] += 1
        assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], tuple(r["ids"])) for r in out) == want
        bins = collections.defaultdict(list)
        for r in out:
            bins[r["sequence_id"]].append((r["offset"], r["length"]))
        for b in bins.values():
            at = 0
            for offset, length in sorted(b):
                assert offset == at
                at += length
            assert at <= 2048
        assert len(bins) <= 1 + math.ceil(1.05 * sum(r["length"] for r in out) / 2048)
    assert packing.pack(docs.limit(0)).count() == 0


def test_few_open_bins_close_the_fullest():
    bins = packing.Bins(10, 2)
    # the third closes bin 1, so the last finds no three places left there
    assert [bins.put(n) for n in (6, 7, 5, 4, 3)] == [(0, 0), (1, 0), (2, 0), (0, 6), (2, 5)]


# language model

def test_language_model(spark, docs):
    for d in both(spark, docs):
        rows = d.collect()
        toks = [[*(r["text"] or "").encode().lower().split(), b""] for r in rows]
        held = [zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 7 == 2 for r in rows]
        c = collections.Counter(w for t, h in zip(toks, held) if not h for w in t)
        n, v = sum(c.values()), len(c)
        want = sorted((repr(r["doc_id"]), h, len(t), sum(c[w] > 0 for w in t), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), 4)) for r, t, h in zip(rows, toks, held))
        out = lm.score(d).collect()
        assert sorted((repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in out) == want
    unseen = [r for r in out if r["held_out"]]
    assert sum(r["score"] for r in unseen) > sum(r["base_score"] for r in unseen)
    assert lm.score(docs.limit(0)).count() == 0


def test_model_sums_to_one(spark):
    d = spark.createDataFrame([(i, "a b a c b a d e f g h i j k l m") for i in range(40)], "doc_id long, text string")
    counts = lm.word_counts(d)
    m = lm.fit(d, counts)
    known = {r["word"].encode(): r["c"] for r in counts.collect()}
    codes = lm.Codes(m["frequent"])
    f = lm.Flat([b"a b a".split()], codes)
    scores, e, total = lm.class_scores(m["weights"], m["prior"], lm.histories(f.crc, f.at))
    p = e / total[:, None]
    assert np.allclose(p.sum(1), 1, atol=1e-5)
    within = collections.Counter()
    for w, c in known.items():
        k = int(lm.classes(np.array([codes[w]]))[0])
        within[k] += 1.0 if k < lm.OWN else (c + 1) / 10 ** m["class_logs"][k]
    for k in range(lm.OWN, lm.CLASSES):  # and one place for all unseen words
        assert math.isclose(within[k] + 10 ** -m["class_logs"][k], 1, rel_tol=1e-9)


def test_model_words_are_looked_up_once():
    t = pa.array([None, "", " \t", " A b\t\nc\x0bD\x0ce \r", "b a b \u00c9 \u00e9 a\x1cb x\x85y"] * 50)
    looked = []

    class Seen(dict):
        def __missing__(self, word):
            looked.append(word)
            return zlib.crc32(word)

    words = lm.Words(t, Seen())
    want = [(x or "").encode().lower().split() for x in t.to_pylist()]
    assert words.sizes.tolist() == [len(w) for w in want] and words.codes.tolist() == [zlib.crc32(w) for x in want for w in x]
    assert sorted(looked) == sorted({w for x in want for w in x})
    whole, parts = lm.Flat(want, lm.Codes([])), [lm.Flat.of(words, a, z, lm.Codes([])) for a, z in words.groups(7)]
    assert np.concatenate([f.codes for f in parts]).tolist() == whole.codes.tolist() and sum(len(f.at) for f in parts) == len(whole.at)
    none = lm.Words(t.slice(0, 3), Seen())
    assert len(none.codes) == 0 and [f for f in none.groups()] == [(0, 3)] and len(lm.Flat.of(none, 0, 3, lm.Codes([])).at) == 3


@pytest.mark.parametrize("frequent", [[], [b"", b"a", b"\xc3\xa9"], [b"%d" % i for i in range(300)]])
def test_model_codes_without_a_step_a_word(monkeypatch, frequent):
    t = pa.array([None, "", "a B \u00e9 b", " ".join(map(str, range(500))), "x\x85y z\u2003w"])
    want = [lm.Codes(frequent)[w] for x in t.to_pylist() for w in (x or "").encode().lower().split()]

    def missing(codes, word):
        raise AssertionError(f"{word} was looked up alone")

    monkeypatch.setattr(lm.Codes, "__missing__", missing)
    assert lm.Words(t, lm.Codes(frequent)).codes.tolist() == want
    assert len(lm.Words(t.slice(0, 2), lm.Codes(frequent)).codes) == 0


def test_model_row_sums():
    rng = np.random.default_rng(5)
    for r in (rng.integers(0, 40, 500), np.arange(9), np.zeros(7)):
        g, r = rng.normal(size=(len(r), lm.CLASSES)).astype(np.float32), r.astype(np.uint16)
        u, n, sums = lm.row_sums(g, r)
        assert u.tolist() == sorted(set(r.tolist())) and n.tolist() == [int((r == x).sum()) for x in u]
        assert np.allclose(sums, [g[r == x].astype(float).sum(0) for x in u], atol=1e-4)
    w = np.zeros((6, lm.CLASSES), np.float32)
    lm.whole_rows(w)[np.array([4, 1])] = lm.whole_rows(g[:2].copy())
    assert np.array_equal(w[[4, 1]], g[:2]) and not w[[0, 2, 3, 5]].any()


def test_model_within_classes(spark):
    rng = random.Random(3)
    follow = {f"x{i}": f"y{i}" for i in range(60)}
    d = spark.createDataFrame([(i, " ".join(f"{x} {follow[x]}" for x in rng.sample(sorted(follow), 30))) for i in range(200)], "doc_id long, text string")
    counts = lm.word_counts(d)
    m = lm.fit(d, counts)
    codes = lm.Codes(m["frequent"])

    def logs(docs, codes=codes):
        f = lm.Flat(docs, codes)
        return f, lm.way_logs(f, m)

    # all leaves and own classes after one history sum to one, and so do the words of a leaf with one place for all unseen ones
    leaves = [b"%d" % i for i in range(lm.LEAVES)]
    each = {b"": codes[b""], b"x1": codes[b"x1"], b"y1": codes[b"y1"]} | {w: i for i, w in enumerate(leaves)} | {b"own%d" % i: i + 1 << 32 for i in range(lm.OWN)}
    f, p = logs([[b"x1", b"y1", w] for w in [*leaves, *(b"own%d" % i for i in range(lm.OWN))]], each)
    assert math.isclose(np.exp(p[2::4]).sum(), 1, rel_tol=1e-4)
    within = np.zeros(lm.LEAVES)
    for r in counts.collect():
        code = np.array([codes[r["word"].encode()]])
        if lm.classes(code)[0] >= lm.OWN:
            within[lm.leaves(code)[0]] += (r["c"] + 1) / 10 ** m["leaf_logs"][lm.leaves(code)[0]]
    assert np.allclose(within + 10 ** -m["leaf_logs"], 1)
    # history chooses among the words of one shared class
    kind = lambda w: int(lm.classes(np.array([codes[w.encode()]]))[0])
    pairs = [(x, y, z) for x, y in follow.items() for z in follow.values() if z != y and kind(z) == kind(y) >= lm.OWN]
    assert len(pairs) > 100
    _, right = logs([[x.encode(), y.encode()] for x, y, _ in pairs])
    _, wrong = logs([[x.encode(), z.encode()] for x, _, z in pairs])
    assert (right[1::3] - wrong[1::3]).mean() > 0.5
