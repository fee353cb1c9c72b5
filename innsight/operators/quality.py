"""Data-quality profiling (DQ1-DQ15, SET1, SET3, SET4, JOI6-JOI8, AGG9-AGG12,
AGG28, AGG29, SRT2, SRT6, SRC4, SRC5).

All reports are distributed aggregations whose *results* are small (one row
per column or per check).  Column-wise reports use one pass over the data:
either one wide ``agg`` or a ``stack`` into (column, value) rows followed by
``groupBy`` -- never a loop of jobs per column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ranking import column_quantiles

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def _stack(df: DataFrame, cols: list[str], value_type: str = "string") -> DataFrame:
    """(column_name, value) rows for ``cols`` (one pass, an Expand-free
    ``explode`` of an array of structs)."""
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast(value_type).alias("value"))
                    for c in cols])
    return df.select(F.explode(arr).alias("_s")).select("_s.column_name", "_s.value")


def missing_report(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """DQ1: (column_name, missing_count, missing_pct) in one pass."""
    cols = df.columns
    row = df.agg(F.count(F.lit(1)).alias("_rows"),
                 *[F.count(F.col(f"`{c}`")).alias(f"m{i}") for i, c in enumerate(cols)])
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), (F.col("_rows") - F.col(f"m{i}")).alias("missing_count"))
                    for i, c in enumerate(cols)])
    out = row.select("_rows", F.explode(arr).alias("_s")).select(
        "_s.column_name", "_s.missing_count",
        (F.col("_s.missing_count") * 100.0 / F.col("_rows")).cast("double").alias("missing_pct"))
    return out.where(F.col("missing_count") > 0) if only_missing else out


def shape(tables: dict[str, DataFrame]) -> DataFrame:
    """DQ2: (table_name, n_rows, n_columns)."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns"))
        for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def low_cardinality_values(df: DataFrame, max_distinct: int = 14, cols: list[str] | None = None) -> DataFrame:
    """DQ3: value counts of text columns with 1..max_distinct distinct
    non-null values, from one aggregate.  Each column has a frequent-item
    sketch, merged map-side, with room for four times as many values; a column
    that never fills it is counted exactly.  One that overflows holds more
    than ``max_distinct`` values and leaves: its sketch has more items, or
    they miss some of the rows, or the column's HyperLogLog estimate is far
    beyond the limit.  No value is a row before the columns are chosen."""
    cols = string_columns(df) if cols is None else cols
    if not cols:
        return df.sparkSession.createDataFrame([], "column_name string, value string, value_count long")
    room = 4 * (max_distinct + 1)
    named = df.select(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(cols)])
    row = named.agg(*[f for i in range(len(cols)) for f in (
        F.expr(f"approx_top_k(v{i}, {max_distinct + 1}, {room}) FILTER (WHERE v{i} IS NOT NULL)").alias(f"top{i}"),
        F.count(f"v{i}").alias(f"n{i}"), F.approx_count_distinct(f"v{i}").alias(f"d{i}"))])
    reports = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"top{i}").alias("top"), F.col(f"n{i}").alias("n"), F.col(f"d{i}").alias("d"))
                        for i, c in enumerate(cols)])
    held = F.aggregate("top", F.lit(0).cast("long"), lambda s, x: s + x["count"])
    few = F.size("top").between(1, max_distinct) & (held == F.col("n")) & (F.col("d") <= 2 * max_distinct)
    return (row.select(F.inline(reports)).where(few).select("column_name", F.inline("top"))
            .select("column_name", F.col("item").alias("value"), F.col("count").alias("value_count")))


def describe(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """AGG9: count, mean, std, min, 25/50/75 % (exact, interpolated), max and
    missing % per numeric column, from one aggregate over all columns and one
    scan for the quartiles."""
    def figures(c: Column) -> list[Column]:
        return [F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"),
                F.try_divide(F.count_if(c.isNull()) * 100.0, F.count(F.lit(1))).cast("double").alias("missing_pct")]

    out = column_quantiles(df, cols or numeric_columns(df), [0.25, 0.5, 0.75], ["q25", "q50", "q75"], figures)
    return out.select("column_name", "count", "mean", "std", "min", "max", "missing_pct", "q25", "q50", "q75")


def domain_checks(listings_raw: DataFrame, price_col: str = "price_clean") -> DataFrame:
    """DQ4 / FLT8: counts of out-of-domain values in one row."""
    p = F.col(price_col)
    return listings_raw.agg(
        F.count_if(p < 0).alias("negative_price"), F.count_if(p == 0).alias("zero_price"),
        F.count_if(F.col("minimum_nights") > F.col("maximum_nights")).alias("min_gt_max_nights"),
        F.count_if(F.col("minimum_nights") > 365).alias("min_nights_over_365"),
        F.count_if(F.col("availability_365") == 0).alias("availability_zero"),
        F.count_if(F.col("availability_365") == 365).alias("availability_full"))


def orphans(facts: DataFrame, dims: DataFrame, fact_key: str = "listing_id", dim_key: str = "id") -> DataFrame:
    """JOI6: fact rows whose key has no dimension row (left_anti)."""
    return facts.join(dims.select(F.col(dim_key).alias(fact_key)), fact_key, "left_anti")


def without_facts(dims: DataFrame, facts: DataFrame, fact_key: str = "listing_id", dim_key: str = "id") -> DataFrame:
    """JOI6: dimension rows with no fact (left_anti)."""
    return dims.join(facts.select(F.col(fact_key).alias(dim_key)), dim_key, "left_anti")


def with_facts(dims: DataFrame, facts: DataFrame, fact_key: str = "listing_id", dim_key: str = "id") -> DataFrame:
    """JOI7: dimension rows with at least one fact (left_semi)."""
    return dims.join(facts.select(F.col(fact_key).alias(dim_key)), dim_key, "left_semi")


def key_presence(dims: DataFrame, facts: dict[str, DataFrame], fact_key: str = "listing_id", dim_key: str = "id") -> DataFrame:
    """How many rows of ``dims`` and of each fact stand under a key: ``(key,
    dims, <fact>...)``, null where a table lacks it.  Every table is counted by
    its key in one scan before the counts meet, so a hot key is one row a task
    and tables bucketed by the key need no exchange.  Null keys match nothing
    and stay a row for each table."""
    out = dims.groupBy(F.col(dim_key).alias("key")).agg(F.count(F.lit(1)).alias("dims"))
    for name, f in facts.items():
        out = out.join(f.groupBy(F.col(fact_key).alias("key")).agg(F.count(F.lit(1)).alias(name)), "key", "full")
    return out


def referential_integrity(listings: DataFrame, reviews: DataFrame, calendar: DataFrame) -> DataFrame:
    """DQ5: (check_name, row_count) for orphans both ways and coverage, from
    one pass over each table."""
    held = key_presence(listings, {"reviews": reviews, "calendar": calendar})
    rows = lambda c, when: F.coalesce(F.sum(F.when(when, F.col(c))), F.lit(0)).cast("long")
    checks = {
        "reviews_orphan_rows": rows("reviews", F.col("dims").isNull()),
        "calendar_orphan_rows": rows("calendar", F.col("dims").isNull()),
        "listings_without_reviews": rows("dims", F.col("reviews").isNull()),
        "listings_without_calendar": rows("dims", F.col("calendar").isNull()),
        "listings_with_reviews": rows("dims", F.col("reviews").isNotNull()),
    }
    one = held.agg(*[c.alias(name) for name, c in checks.items()])
    return one.select(F.inline(F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(n).alias("row_count")) for n in checks])))


def lookup_mismatches(values: DataFrame, value_col: str, reference: DataFrame, ref_col: str) -> DataFrame:
    """JOI8: distinct names on one side missing from the other, both ways:
    (side, name)."""
    a = values.select(F.col(value_col).alias("name")).where(F.col("name").isNotNull()).distinct()
    b = reference.select(F.col(ref_col).alias("name")).where(F.col("name").isNotNull()).distinct()
    return (a.join(b, "name", "left_anti").select(F.lit("not_in_reference").alias("side"), "name")
            .unionByName(b.join(a, "name", "left_anti").select(F.lit("unused_reference").alias("side"), "name")))


def duplicate_counts(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """SET3 (keys None: whole row, nulls equal) / SET4 (key subset): rows
    beyond the first of each group, as one number."""
    keys = keys or df.columns
    g = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("duplicate_rows"))


def list_field_report(df: DataFrame, raw_col: str, parsed: F.Column) -> DataFrame:
    """DQ7 / AGG29: parse rate, length statistics and distinct members of a
    nested text field (members via explode + count_distinct, whole table)."""
    d = df.select(F.col(raw_col).alias("raw"), F.from_json(F.col(raw_col), "array<string>").alias("arr"))
    stats = d.agg(F.count("raw").alias("non_null"), F.count("arr").alias("parsed"),
                  F.avg(F.size(F.coalesce("arr", F.array().cast("array<string>")))).alias("avg_items"),
                  F.max(F.size("arr")).alias("max_items"))
    members = (d.select(F.explode("arr").alias("m")).where(F.col("m").isNotNull())
               .agg(F.count_distinct("m").alias("distinct_members")))
    return _one_row_join(stats, members)


def _one_row_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Side by side of two one-row frames (equi-join on a constant key)."""
    return a.withColumn("_one", F.lit(1)).join(b.withColumn("_one", F.lit(1)), "_one").drop("_one")


def two_source_comparison(df: DataFrame, numeric_col: str, text_col: str) -> DataFrame:
    """DQ8: missing in each source, both, and recoverable from the other."""
    a, b = F.col(numeric_col), F.col(text_col)
    return df.agg(F.count_if(a.isNull()).alias("numeric_missing"), F.count_if(b.isNull()).alias("text_missing"),
                  F.count_if(a.isNull() & b.isNull()).alias("both_missing"),
                  F.count_if(a.isNull() & b.isNotNull()).alias("recoverable_from_text"))


def top_n(df: DataFrame, col: str, n: int = 10, context: list[str] | None = None, tiebreak: str = "id") -> DataFrame:
    """SRT2: n largest rows (nulls last, id as tie-break)."""
    sel = [tiebreak, col] + [c for c in (context or []) if c not in (tiebreak, col)]
    return df.select(*sel).orderBy(F.col(col).desc_nulls_last(), F.col(tiebreak).asc()).limit(n)


def review_text_report(reviews_raw: DataFrame, min_len: int = 5) -> DataFrame:
    """DQ12: null and short comments, distinct listings and reviewers."""
    c = F.col("comments")
    return reviews_raw.agg(F.count(F.lit(1)).alias("reviews"), F.count_if(c.isNull()).alias("null_comments"),
                           F.count_if(F.length(F.coalesce(c, F.lit(""))) < min_len).alias("short_comments"),
                           F.count_distinct("listing_id").alias("distinct_listings"),
                           F.count_distinct("reviewer_id").alias("distinct_reviewers"))


def quality_gate(df: DataFrame, col: str = "price_clean", max_null_pct: float = 5.0,
                 not_null: list[str] | None = None) -> DataFrame:
    """DQ13: rule rows (rule, observed, passed): null share of ``col`` under
    the limit, and not-null contract columns.  An empty batch passes none."""
    not_null = not_null or ["id"]
    row = df.agg(F.try_divide(F.sum(F.col(col).isNull().cast("long")) * 100.0, F.count(F.lit(1))).cast("double").alias("r0"),
                 *[F.sum(F.col(c).isNull().cast("long")).cast("double").alias(f"r{i + 1}")
                   for i, c in enumerate(not_null)])
    rules = [(f"null_pct_{col}<= {max_null_pct}", "r0", F.coalesce(F.col("r0") <= max_null_pct, F.lit(False)))] + [
        (f"not_null_{c}", f"r{i + 1}", F.coalesce(F.col(f"r{i + 1}") == 0, F.lit(False))) for i, c in enumerate(not_null)]
    arr = F.array(*[F.struct(F.lit(n).alias("rule"), F.col(r).alias("observed"), ok.alias("passed"))
                    for n, r, ok in rules])
    return row.select(F.explode(arr).alias("_s")).select("_s.rule", "_s.observed", "_s.passed")


def freshness(df: DataFrame, as_of: str, col: str = "last_scraped", max_age_days: int = 7) -> DataFrame:
    """DQ14: newest scrape date, its age in days and the pass flag."""
    newest = F.max(F.col(col).try_cast("date"))
    return df.agg(newest.alias("newest")).select(
        "newest", F.datediff(F.to_date(F.lit(as_of)), F.col("newest")).alias("age_days"),
        (F.datediff(F.to_date(F.lit(as_of)), F.col("newest")) <= max_age_days).alias("fresh"))


def date_range(df: DataFrame, raw_col: str) -> DataFrame:
    """AGG28: min, max, span in days, unparseable (text present, no date)."""
    d = F.col(raw_col).try_cast("date")
    return df.agg(F.min(d).alias("min_date"), F.max(d).alias("max_date"),
                  F.count_if(d.isNull() & F.col(raw_col).isNotNull()).alias("unparseable")).withColumn(
        "span_days", F.datediff("max_date", "min_date"))


def schema_listing(tables: dict[str, DataFrame]) -> DataFrame:
    """SRC4: (file, ordinal, column_name, data_type) from each table's schema."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(name, i, f.name, f.dataType.simpleString())
            for name, df in tables.items() for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "file string, ordinal int, column_name string, data_type string")


def sample_row(df: DataFrame, *order_cols: str) -> DataFrame:
    """SRC5: the first row (by ``order_cols``) shown as (column_name, value)."""
    first = df.orderBy(*[F.col(c).asc_nulls_last() for c in order_cols]).limit(1)
    return _stack(first, df.columns)


def sample_rows(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """SRC5: (table_name, column_name, value) of a sample row of each table,
    the first in the order of its columns given; a table without rows has none."""
    parts = [sample_row(df, *order).select(F.lit(name).alias("table_name"), "column_name", "value") for name, (df, order) in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
