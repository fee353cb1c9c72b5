"""The registered queries of the training-data operators, with DuckDB SQL
where it can state them.

A query reads its whole table, calls its operator with production parameters
and derives the contract's columns from the operator's result.  op4 (a trained
model), op5, op6 and op13 (components), op7 and op12 (tokenizer ids) and op9
(an approximate search) have no SQL; tests hold them against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, ann, lexical, lines, lm, mixing, packing, quality, secrets, setjoin, simhash, substring, warc
from .common import table, written

#: Schedules of the weights 1 (falling), 2 (even) and 3 (rising).
KNOTS = [[(0, 1.5), (1, 0.5)], [(0, 2.0), (1, 2.0)], [(0, 1.5), (1, 4.5)]]


def op1_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed to weights 1, 2, 3; range-sorted by the time of the first copy."""
    d = table(spark, sf_dir, "documents")
    sized = written(d.select("doc_id", "source", mixing.words(F.col("text")).alias("n")), "sized")
    p = mixing.plan(sized, KNOTS, size=F.col("n"))
    first = F.round(F.get("copies", F.lit(0))["time"], 6)
    return p.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken", first.alias("first_time")).orderBy(F.col("first_time").asc_nulls_last(), "doc_id")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = secrets.scan(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda p: p["kind"] == kind)).cast("long").alias(f"n_{kind}")
    joined = lambda c: F.array_join(F.transform(c, lambda p: F.concat_ws(":", p["kind"], p["start"], p["end"])), ",")
    return s.select("doc_id", *[count(k) for k in ("assign", "access", "hex")], F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op3_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = warc.archive_path(spark)
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.read(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(table(spark, sf_dir, "documents"))


def op5_paragraph_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated(table(spark, sf_dir, "documents"))


def op6_golay_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return n.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), with_ids=False)


def op8_line_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = lines.dedup(table(spark, sf_dir, "documents"), marks=True)
    return d.select("doc_id", "n_lines", F.size("gone").cast("long").alias("n_gone"), F.array_join("gone", ",").alias("gone"), "text")


def op9_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(table(spark, sf_dir, "embeddings"))


def op10_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quality.quality(table(spark, sf_dir, "documents"))
    return q.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    F.round("class_distance", 6).alias("class_distance"), F.round("common_distance", 6).alias("common_distance"), "kept")


def op11_best_position_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


def op13_prefix_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.link(table(spark, sf_dir, "documents")).withColumnRenamed("n_grams", "n_shingles")


_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"

_OP1 = f"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, 1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS w FROM d GROUP BY source),
r AS (SELECT *, 3.0::DOUBLE * source_size AS cap, 3.0::DOUBLE * source_size / w AS ratio, (sum(source_size) OVER ())::DOUBLE AS total FROM s),
v AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS lev FROM r),
t AS (SELECT source, source_size, w, least(cap, coalesce((SELECT first(lev ORDER BY ratio, source NULLS LAST) FROM v WHERE ratio >= lev) * w, cap)) AS target FROM v),
p AS (SELECT d.doc_id, d.size, t.source_size, t.target, t.w, round(t.target)::BIGINT AS wanted,
        coalesce(sum(d.size) OVER (PARTITION BY t.source ORDER BY md5(d.doc_id::VARCHAR), d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS b
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
k AS (SELECT *, CASE WHEN source_size > 0 THEN wanted // source_size ELSE 0 END AS passes FROM p),
x AS (SELECT *, CASE WHEN size > 0 THEN passes * size + greatest(least(wanted - passes * source_size - b, size), 0) ELSE 0 END AS taken FROM k),
u AS (SELECT *, CASE WHEN taken > 0 THEN least(b / target, 1.0) END AS share FROM x)
SELECT doc_id, size::BIGINT AS size, source_size, round(target, 6) AS target, taken::BIGINT AS taken,
       round(CASE w WHEN 1 THEN 2 * share / (1.5 + sqrt(2.25 - 2 * share)) WHEN 2 THEN share ELSE 6 * share / (1.5 + sqrt(2.25 + 18 * share)) END, 6) AS first_time
FROM u"""


def _op2_spans() -> str:
    """A SELECT of (doc_id, k, s, e) for each kind, joined by UNION ALL."""
    out = []
    for i, (_, pattern, group, least) in enumerate(secrets.BASE + secrets.WEAK):
        p = pattern.replace("'", "''")
        out.append(f"""
SELECT doc_id, {i} AS k, list_sum(list_transform(b[1:j], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:j - 1], lambda x: length(x))), 0) AS s, length(m[j]) AS n
FROM (SELECT doc_id, m, b, v, unnest(range(1, len(m) + 1)) AS j FROM (
  SELECT doc_id, regexp_extract_all(text, '{p}') AS m, regexp_extract_all(text, '{p}', {group}) AS v, string_split_regex(text, '{p}') AS b
  FROM d WHERE regexp_matches(text, '{p}')))
WHERE length(v[j]) >= {least}""")
    return "\nUNION ALL\n".join(out)


_KINDS = [k for k, *_ in secrets.BASE + secrets.WEAK]
_ROLES = [secrets.ROLE[k] for k in _KINDS]
_OP2 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
raw AS (SELECT doc_id, k, s::BIGINT AS s, (s + n)::BIGINT AS e FROM ({_op2_spans()})),
p AS (SELECT *, {_KINDS}[k + 1] AS kind, {_ROLES}[k + 1] AS role FROM raw a
      WHERE k < 3 OR NOT EXISTS (SELECT 1 FROM raw b WHERE b.doc_id = a.doc_id AND b.k < 3 AND b.s <= a.s AND a.e <= b.e)),
near AS (SELECT a.doc_id, a.k, a.s, a.e, a.role, bool_or(b.role = 'secret') AS sec, bool_or(b.role = 'identifier') AS ide, bool_or(b.role = 'endpoint') AS endp
         FROM p a JOIN p b ON a.doc_id = b.doc_id AND (a.k, a.s, a.e) <> (b.k, b.s, b.e) AND b.s - a.e <= 200 AND a.s - b.e <= 200 WHERE a.k >= 3 GROUP BY ALL),
more AS (SELECT doc_id, k, s, e FROM near WHERE CASE role WHEN 'identifier' THEN sec WHEN 'secret' THEN ide OR endp ELSE ide AND sec END),
base AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex,
           string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k, e) AS t FROM p WHERE k < 3 GROUP BY doc_id),
every AS (SELECT doc_id, string_agg({_KINDS}[k + 1] || ':' || s || ':' || e, ',' ORDER BY s, k, e) AS t
          FROM (SELECT doc_id, k, s, e FROM p WHERE k < 3 UNION ALL SELECT * FROM more) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base.t, '')) AS base_sha256, coalesce(every.t, '') AS spans
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN every USING (doc_id)"""

_OP3 = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages),
m AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS head FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> head THEN head END AS refers_to
FROM m"""

_OP8 = rf"""
WITH l AS (SELECT doc_id, i - 1 AS i, trim(s, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS s FROM (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS s, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
w AS (SELECT doc_id, i, s, lead(i) OVER o AS j, lead(s) OVER o AS t FROM l WHERE s <> '' WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT doc_id, i, j, s || chr(10) || t AS gram FROM w WHERE j IS NOT NULL
      UNION ALL SELECT doc_id, i, i, s FROM w WHERE len(regexp_extract_all(s, '{_WORD}')) >= {lines.LONG}),
f AS (SELECT *, row_number() OVER (PARTITION BY gram ORDER BY doc_id, i) AS nth FROM g),
x AS (SELECT doc_id, list_sort(list_distinct(flatten(list(range(i, j + 1))))) AS gone FROM f WHERE nth > 1 GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_lines FROM w GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_gone, coalesce(array_to_string(gone, ','), '') AS gone,
       CASE WHEN gone IS NULL THEN text ELSE coalesce(array_to_string(list_transform(list_filter(range(1, len(string_split(text, chr(10))) + 1), lambda k: NOT list_contains(gone, k - 1)), lambda k: string_split(text, chr(10))[k]), chr(10)), '') END AS text
FROM documents d LEFT JOIN x USING (doc_id) LEFT JOIN n USING (doc_id)"""


def _op10() -> str:
    known = "CASE lang " + " ".join("WHEN '{}' THEN [{}]".format(k, ", ".join(f"'{w}'" for w in v)) for k, v in quality.COMMON.items()) + " END"
    steps, left = [], "bare"
    for name, pattern in quality.CLASSES:
        quoted = pattern.replace("'", "''")
        steps.append(f"s_{name} AS (SELECT *, regexp_replace({left}, '{quoted}', '', 'g') AS no_{name} FROM {'b' if left == 'bare' else 's_' + left[3:]})")
        left = f"no_{name}"
    chain = ["bare", *[f"no_{n}" for n, _ in quality.CLASSES]]
    classes = ", ".join([f"length({a}) - length({b})" for a, b in zip(chain, chain[1:])] + [f"length({chain[-1]})"])
    n = len(chain)
    m = max(map(len, quality.COMMON.values())) + 1

    def distance(p: str, q: str) -> str:
        total = lambda a: f"list_sum({a})::DOUBLE"
        pairs = f"list_transform(range(1, len({p}) + 1), lambda i: struct_pack(x := {p}[i] / {total(p)}, y := {q}[i] / {total(q)}))"
        term = lambda v: f"CASE WHEN z.{v} > 0 THEN z.{v} * log2(2 * z.{v} / (z.x + z.y)) ELSE 0 END"
        return f"CASE WHEN {total(p)} > 0 AND {total(q)} > 0 THEN sqrt(greatest(0, list_sum(list_transform({pairs}, lambda z: {term('x')} + {term('y')})) / 2)) END"

    return rf"""
WITH a AS (SELECT doc_id, lang, coalesce(text, '') AS text, {known} AS known FROM documents),
b AS (SELECT *, regexp_replace(text, '{_SPACE}+', '', 'g') AS bare, regexp_extract_all(text, '{_WORD}') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM a),
{', '.join(steps)},
g AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS gram FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM b)),
r AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g) WHERE c > 1),
c AS (SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words FROM r, (VALUES (0), (1), (2)) v(j) GROUP BY doc_id),
f AS (SELECT doc_id, lang, len(words) AS n_words, length(bare) AS word_chars,
        length(no_digit) - length(regexp_replace(no_digit, '[#*$%&|<>]+', '', 'g')) AS n_symbols,
        len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
        [{classes}] AS classes, known,
        CASE WHEN known IS NOT NULL THEN list_append(list_transform(known, lambda k: len(list_filter(words, lambda w: lower(w) = k))),
          len(words) - len(list_filter(words, lambda w: list_contains(known, lower(w))))) END AS commons
      FROM s_{quality.CLASSES[-1][0]} LEFT JOIN c USING (doc_id)),
ref AS (SELECT lang, [{', '.join(f'sum(classes[{i}])' for i in range(1, n + 1))}] AS cr, [{', '.join(f'sum(commons[{i}])' for i in range(1, m + 1))}] AS wr FROM f WHERE known IS NOT NULL GROUP BY lang),
other AS (SELECT lang, [{', '.join(f'sum(classes[{i}])' for i in range(1, n + 1))}] AS cr FROM f WHERE known IS NULL AND lang IS NOT NULL GROUP BY lang HAVING count(*) >= 50),
j AS (SELECT f.*, coalesce(ref.cr, other.cr) AS cr, ref.wr AS wr FROM f LEFT JOIN ref ON f.lang = ref.lang LEFT JOIN other ON f.lang = other.lang),
k AS (SELECT *, {distance('classes', 'cr')} AS cd, {distance('commons', 'wr')} AS wd, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM j)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       base_failed, round(cd, 6) AS class_distance, round(wd, 6) AS common_distance,
       NOT base_failed AND NOT (n_words >= 50 AND (coalesce(cd, 0) > 0.3 OR coalesce(wd, 0) > 0.4 OR (coalesce(cd, 0) > 0.18 AND coalesce(wd, 0) > 0.27))) AS kept
FROM k"""


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_OP11 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_TERM}') AS t FROM documents),
g AS (SELECT count(*) AS big_n, sum(len(t))::BIGINT AS big_l FROM d WHERE len(t) > 0),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '{_TERM}')) AS term FROM benchmark),
p AS (SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(t) AS n, unnest(t) AS term FROM d) WHERE term IN (SELECT term FROM i) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, g GROUP BY term, big_n),
s AS (SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * big_n) // big_l)))))::BIGINT AS score
      FROM i JOIN w USING (term) JOIN p USING (term), g GROUP BY item_id, r, doc_id),
k AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, r)::INT AS rank, doc_id, score FROM s WHERE score > 0)
SELECT * FROM k WHERE rank <= 10"""


QUERIES = {f.__name__: f for f in (
    op1_curriculum_mix, op2_secret_scan, op3_warc_archive, op4_maxent_lm, op5_paragraph_minhash, op6_golay_simhash,
    op7_best_fit_packing, op8_line_winnowing, op9_posting_lists, op10_divergence_rules,
    op11_best_position_search, op12_pair_bitmaps, op13_prefix_jaccard)}
ORACLES = {"op1_curriculum_mix": _OP1, "op2_secret_scan": _OP2, "op3_warc_archive": _OP3, "op8_line_winnowing": _OP8, "op10_divergence_rules": _op10(), "op11_best_position_search": _OP11}
