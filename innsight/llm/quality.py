"""Quality rules by distribution divergence (DataFrame functions only).

Each document gets counts of its words, lines and repeated windows, a
histogram of character classes and one of its language's common words.  The
language references are the same histograms summed over all documents of the
language; a language without common words has a reference of character classes
if ``min_reference`` documents or more are in it.  A document whose Jensen-Shannon distance to its reference exceeds
a threshold is rejected, unless it is too short for its histogram to mean
anything (minimum-length guard); very short and very repetitive documents
fail the base rules.

Edge cases: a null text has no words (base-failed, as n_words < 50); a null
language, and one of too few documents, has no reference: its documents go by
the base rules alone; an empty table gives an empty result; equal rows get
equal rows; columns other than doc_id, text and lang are not read.
Three-word windows are compared by their 64-bit hashes within one text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, col, doc_key, fresh, join_spread, written

#: Common words by language (the parameter's default).
COMMON = {
    "en": ["the", "of", "and", "to", "in", "that", "is", "for", "on", "with", "by", "it"],
    "fr": ["de", "la", "le", "et", "les", "des", "un", "en", "que", "pour", "dans", "par"],
    "de": ["der", "die", "und", "das", "in", "den", "von", "zu", "mit", "ist", "auf", "für"],
    "es": ["de", "la", "el", "que", "en", "y", "los", "se", "del", "un", "con", "por"],
}
#: Character classes taken off a text one after the other; what is left is the last class.
CLASSES = [("lower", "[a-z]+"), ("upper", "[A-Z]+"), ("digit", "[0-9]+"), ("point", "[.,;:!?'\"()-]+"), ("letter", "[^\\x00-\\x7F]+")]


def bound(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def repeated_words(words: Column, n: Column) -> Column:
    """How many words lie in three-word windows that occur twice or more."""
    grams = F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(words[i], words[i + 1], words[i + 2]))

    def covered(s: Column) -> Column:
        last = F.size(s) - 1
        twice = lambda e, i: F.when(i > 0, s[F.greatest(i - 1, F.lit(0))]["h"] == e["h"]).otherwise(False) | F.when(i < last, s[F.least(i + 1, last)]["h"] == e["h"]).otherwise(False)
        at = F.sort_array(F.transform(F.filter(s, twice), lambda e: e["p"]))
        return bound(at, lambda p: F.aggregate(
            F.transform(p, lambda x, i: F.when(i < F.size(p) - 1, F.least(F.lit(3), p[F.least(i + 1, F.size(p) - 1)] - x)).otherwise(3)),
            F.lit(0).cast("long"), lambda a, x: a + x))

    return F.when(n < 3, F.lit(0).cast("long")).otherwise(bound(grams, lambda g: F.when(
        F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(
        bound(F.sort_array(F.transform(g, lambda h, i: F.struct(h.alias("h"), i.alias("p")))), covered))))


def features(docs: DataFrame, common: dict[str, list[str]] = COMMON) -> DataFrame:
    """One pass over the texts: ``(k1, k2, doc_id, lang, counts, classes,
    commons)`` for every row, without the text."""
    known = reduce(lambda w, kv: w.when(F.col("lang") == kv[0], F.array(*[F.lit(x) for x in kv[1]])), list(common.items())[1:],
                   F.when(F.col("lang") == next(iter(common)), F.array(*[F.lit(x) for x in next(iter(common.values()))])))
    d = docs.select(col("doc_id").alias("doc_id"), col("lang").alias("lang"), F.coalesce(col("text"), F.lit("")).alias("text"))
    d = d.withColumn("bare", F.regexp_replace("text", SPACE + "+", "")).withColumn("words", F.filter(F.split("text", SPACE + "+"), lambda w: w != ""))
    d = d.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))).withColumn("known", known)
    d = d.withColumn("n_words", F.size("words"))
    left = "bare"
    for name, pattern in CLASSES:
        d = d.withColumn(f"no_{name}", F.regexp_replace(left, pattern, ""))
        left = f"no_{name}"
    steps = ["bare", *[f"no_{name}" for name, _ in CLASSES]]
    found = F.filter(F.transform("words", lambda w: F.lower(w)), lambda w: F.array_contains(F.col("known"), w))
    d = d.withColumn("found", F.when(F.col("known").isNotNull(), found))
    return d.select(
        *[k.alias(f"k{i}") for i, k in enumerate(doc_key(F.col("doc_id"), F.col("text")), 1)], "doc_id", "lang",
        F.col("n_words").cast("long").alias("n_words"), F.length("bare").cast("long").alias("word_chars"),
        (F.length("no_digit") - F.length(F.regexp_replace("no_digit", "[#*$%&|<>]+", ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words"), F.col("n_words")).alias("n_repeat_words"),
        F.array(*[(F.length(a) - F.length(b)).cast("long") for a, b in zip(steps, steps[1:])], F.length(steps[-1]).cast("long")).alias("classes"),
        F.when(F.col("known").isNotNull(), F.concat(
            F.transform("known", lambda k: F.size(F.filter(F.col("found"), lambda w: w == k)).cast("long")),
            F.array((F.col("n_words") - F.size("found")).cast("long")))).alias("commons"))


def distance(p: Column, q: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two count arrays; null
    where either sums to zero."""
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x)
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    def both(x, y):
        m = (x + y) / 2
        return part(x, m) + part(y, m)

    share = lambda a: F.transform(a, lambda x: F.try_divide(x, total(a)))
    halves = F.zip_with(share(p), share(q), both)
    return F.when((total(p) > 0) & (total(q) > 0), F.sqrt(F.greatest(F.lit(0.0), F.aggregate(halves, F.lit(0.0), lambda s, x: s + x) / 2)))


def references(feats: DataFrame, common: dict[str, list[str]] = COMMON) -> tuple[dict, bool]:
    """The histograms summed by the languages of ``common``, and whether
    there are documents in others."""
    n, m = len(CLASSES) + 1, max(len(v) for v in common.values()) + 1
    lang = F.when(F.col("lang").isin(*common), F.col("lang"))
    sums = feats.groupBy(lang.alias("lang")).agg(
        *[F.sum(F.col("classes")[i]).alias(f"c{i}") for i in range(n)], *[F.sum(F.get("commons", F.lit(i))).alias(f"w{i}") for i in range(m)], F.count("lang").alias("named")).collect()
    refs = {r["lang"]: ([r[f"c{i}"] or 0 for i in range(n)], [r[f"w{i}"] or 0 for i in range(len(common[r["lang"]]) + 1)]) for r in sums if r["lang"] is not None}
    return refs, any(r["lang"] is None and r["named"] for r in sums)


def other_references(feats: DataFrame, common: dict[str, list[str]], min_reference: int) -> DataFrame:
    """``(lang, other_ref)``: the character classes summed by each language
    outside ``common`` that has ``min_reference`` documents."""
    sums = feats.filter(~F.col("lang").isin(*common)).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.array(*[F.sum(F.col("classes")[i]).cast("double") for i in range(len(CLASSES) + 1)]).alias("other_ref"))
    return sums.filter(F.col("n") >= min_reference).select("lang", "other_ref")


def verdicts(feats: DataFrame, common: dict[str, list[str]] = COMMON, min_words: int = 50, max_classes: float = 0.3,
             max_commons: float = 0.4, both: tuple[float, float] = (0.18, 0.27), guard: int = 50, min_reference: int = 50) -> DataFrame:
    """``feats`` with ``base_failed``, the two distances and ``kept``: false
    for a document of ``guard`` words or more with one distance over its
    limit, or the two over the pair of limits ``both``."""
    refs, others = references(feats, common)
    arr = lambda a: F.array(*[F.lit(float(x)) for x in a])
    classes = commons = F.lit(None).cast("array<double>")
    if others:  # as many as the data has languages: joined, not collected
        cols = feats.columns
        feats = join_spread(feats, other_references(feats, common, min_reference), ["lang"], F.col("k1"), "left").select(*cols, "other_ref")
        classes = F.col("other_ref")
    for lang, (c, w) in refs.items():
        classes = F.when(F.col("lang") == lang, arr(c)).otherwise(classes)
        commons = F.when(F.col("lang") == lang, arr(w)).otherwise(commons)
    out = feats.withColumn("class_ref", classes).withColumn("common_ref", commons)
    out = out.withColumn("class_distance", distance(F.col("classes"), F.col("class_ref"))).withColumn("common_distance", distance(F.col("commons"), F.col("common_ref")))
    base = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    far = (F.coalesce("class_distance", F.lit(0.0)) > max_classes) | (F.coalesce("common_distance", F.lit(0.0)) > max_commons) | (
        (F.coalesce("class_distance", F.lit(0.0)) > both[0]) & (F.coalesce("common_distance", F.lit(0.0)) > both[1]))
    return out.withColumn("base_failed", base).withColumn("kept", ~base & ~((F.col("n_words") >= guard) & far)).drop("class_ref", "common_ref", "other_ref")


def quality(docs: DataFrame, **params) -> DataFrame:
    """A row for each document: its counts, distances and verdict."""
    return verdicts(written(features(docs, params.get("common", COMMON)), "quality"), **params)


def keep_good(docs: DataFrame, **params) -> DataFrame:
    """The documents that are kept, with their own columns."""
    k1, k2 = fresh(docs, "k1", "k2")
    keys = doc_key(col("doc_id"), col("text"))
    bad = quality(docs, **params).filter("not kept").select(F.col("k1").alias(k1), F.col("k2").alias(k2))
    return docs.withColumn(k1, keys[0]).withColumn(k2, keys[1]).join(bad, [k1, k2], "left_anti").select(*[col(c) for c in docs.columns])
