"""Registered queries: data-quality profiling (DQ*, SET1/3/4, JOI6-8,
AGG9-12, AGG28-29, SRT2, SRT6, SRC4, SRC5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.silver import valid_price
from ..sources.fixtures import LISTINGS_COLUMNS, SCRAPE_DATE
from . import oracle as O
from .registry import register

LISTING_STRING_COLUMNS = [
    "host_since", "last_scraped", "price", "room_type", "property_type", "host_is_superhost",
    "host_has_profile_pic", "host_identity_verified", "instant_bookable", "neighbourhood_cleansed",
    "neighbourhood_group_cleansed", "host_neighbourhood", "license", "calendar_updated", "bathrooms_text",
    "amenities", "host_verifications", "host_response_rate", "host_acceptance_rate", "first_review", "last_review"]
# The columns of the descriptive table.
DESCRIBE_COLUMNS = [
    "price_clean", "price_capped", "accommodates", "bathrooms_final", "bedrooms", "minimum_nights", "availability_365",
    "number_of_reviews", "review_scores_rating", "calculated_host_listings_count", "estimated_annual_revenue_approx",
    "occupancy_rate_upper_bound"]
_ALL_LISTING_COLUMNS = [n for n, _ in LISTINGS_COLUMNS]


def _union_sql(template: str, cols: list[str]) -> str:
    return "\nUNION ALL\n".join(template.format(c=c) for c in cols)


_DQ1_SQL = ("SELECT * FROM (" + _union_sql(
    "SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count, "
    "CAST((count(*) - count({c})) * 100.0 / count(*) AS DOUBLE) AS missing_pct FROM listings_raw",
    _ALL_LISTING_COLUMNS) + ") m WHERE missing_count > 0")


@register("dq1_missing_report", O.rounded(_DQ1_SQL, ["missing_pct"]))
def dq1_missing_report(lk):
    """DQ1: missing count and share per raw listing column (only > 0)."""
    return Q.missing_report(lk.listings_raw)


@register("dq2_shape", O.with_ctes(
    f"SELECT 'listings_raw' AS table_name, count(*) AS n_rows, {len(LISTINGS_COLUMNS)} AS n_columns FROM listings_raw "
    "UNION ALL SELECT 'calendar_raw', count(*), 7 FROM calendar_raw "
    "UNION ALL SELECT 'reviews_raw', count(*), 6 FROM reviews_raw"))
def dq2_shape(lk):
    """DQ2: rows and columns of each raw table."""
    return Q.shape({"listings_raw": lk.listings_raw, "calendar_raw": lk.calendar_raw,
                    "reviews_raw": lk.reviews_raw})


_DQ3_SQL = ("SELECT u.column_name, u.value, count(*) AS value_count FROM (" + _union_sql(
    "SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM listings_raw", LISTING_STRING_COLUMNS) +
    ") u WHERE u.value IS NOT NULL AND u.column_name IN (SELECT column_name FROM (" + _union_sql(
    "SELECT '{c}' AS column_name, count(DISTINCT {c}) AS nd FROM listings_raw", LISTING_STRING_COLUMNS) +
    ") d WHERE nd BETWEEN 1 AND 14) GROUP BY u.column_name, u.value")


@register("dq3_low_cardinality", O.with_ctes(_DQ3_SQL))
def dq3_low_cardinality(lk):
    """DQ3: value counts of text columns with 1-14 distinct values."""
    return Q.low_cardinality_values(lk.listings_raw, cols=LISTING_STRING_COLUMNS)


@register("dq4_domain_checks", O.with_ctes(
    "SELECT count(*) FILTER (WHERE price_clean < 0) AS negative_price, "
    "count(*) FILTER (WHERE price_clean = 0) AS zero_price, "
    "count(*) FILTER (WHERE minimum_nights > maximum_nights) AS min_gt_max_nights, "
    "count(*) FILTER (WHERE minimum_nights > 365) AS min_nights_over_365, "
    "count(*) FILTER (WHERE availability_365 = 0) AS availability_zero, "
    "count(*) FILTER (WHERE availability_365 = 365) AS availability_full "
    "FROM (SELECT *, TRY_CAST(regexp_replace(price, '[$,]', '', 'g') AS DOUBLE) AS price_clean FROM listings_raw) x"))
def dq4_domain_checks(lk):
    """DQ4 / FLT8: negative or zero price, min > max nights, extremes."""
    from ..functions.cleaning import money_to_double
    return Q.domain_checks(lk.listings_raw.withColumn("price_clean", money_to_double("price")))


@register("dq5_referential_integrity", O.with_ctes(
    "SELECT 'reviews_orphan_rows' AS check_name, count(*) AS row_count FROM reviews_silver r "
    "WHERE NOT EXISTS (SELECT 1 FROM listings_silver l WHERE l.id = r.listing_id) "
    "UNION ALL SELECT 'calendar_orphan_rows', count(*) FROM calendar_silver c "
    "WHERE NOT EXISTS (SELECT 1 FROM listings_silver l WHERE l.id = c.listing_id) "
    "UNION ALL SELECT 'listings_without_reviews', count(*) FROM listings_silver l "
    "WHERE NOT EXISTS (SELECT 1 FROM reviews_silver r WHERE l.id = r.listing_id) "
    "UNION ALL SELECT 'listings_without_calendar', count(*) FROM listings_silver l "
    "WHERE NOT EXISTS (SELECT 1 FROM calendar_silver c WHERE l.id = c.listing_id) "
    "UNION ALL SELECT 'listings_with_reviews', count(*) FROM listings_silver l "
    "WHERE EXISTS (SELECT 1 FROM reviews_silver r WHERE l.id = r.listing_id)"))
def dq5_referential_integrity(lk):
    """DQ5 (JOI6 both ways, JOI7) on the Silver tables."""
    return Q.referential_integrity(lk.listings, lk.reviews, lk.calendar)


@register("joi6_orphan_reviews", O.with_ctes(
    "SELECT r.listing_id, r.id FROM reviews_silver r ANTI JOIN listings_silver l ON l.id = r.listing_id"))
def joi6_orphan_reviews(lk):
    """JOI6: reviews of listings that are not in Silver listings (left_anti)."""
    return Q.orphans(lk.reviews, lk.listings.select("id")).select("listing_id", "id")


@register("joi6_listings_without_reviews", O.with_ctes(
    "SELECT l.id FROM listings_silver l ANTI JOIN reviews_silver r ON l.id = r.listing_id"))
def joi6_listings_without_reviews(lk):
    """JOI6: listings with no review (left_anti)."""
    return Q.without_facts(lk.listings.select("id"), lk.reviews)


@register("joi7_listings_with_reviews", O.with_ctes(
    "SELECT count(*) AS listings_with_reviews FROM listings_silver l SEMI JOIN reviews_silver r ON l.id = r.listing_id"))
def joi7_listings_with_reviews(lk):
    """JOI7: semi-join count."""
    return Q.with_facts(lk.listings.select("id"), lk.reviews).agg(F.count(F.lit(1)).alias("listings_with_reviews"))


@register("joi8_lookup_mismatches", O.with_ctes(
    "SELECT 'not_in_reference' AS side, name FROM (SELECT DISTINCT neighbourhood_cleansed AS name FROM listings_silver "
    "WHERE neighbourhood_cleansed IS NOT NULL EXCEPT SELECT neighbourhood FROM neighbourhoods_raw) a "
    "UNION ALL SELECT 'unused_reference', name FROM (SELECT DISTINCT neighbourhood AS name FROM neighbourhoods_raw "
    "WHERE neighbourhood IS NOT NULL EXCEPT SELECT neighbourhood_cleansed FROM listings_silver) b"))
def joi8_lookup_mismatches(lk):
    """JOI8: neighbourhood names not matched against the reference list (the
    explicit name column, not the all-null group column)."""
    return Q.lookup_mismatches(lk.listings, "neighbourhood_cleansed", lk.neighbourhoods_raw, "neighbourhood")


@register("set1_key_intersection", O.with_ctes(
    "SELECT count(*) AS common_keys FROM (SELECT id FROM listings_silver INTERSECT SELECT listing_id FROM calendar_silver) k"))
def set1_key_intersection(lk):
    """SET1: listing keys present in both listings and calendar (intersect)."""
    return (lk.listings.select("id").intersect(lk.calendar.select(F.col("listing_id").alias("id")))
            .agg(F.count(F.lit(1)).alias("common_keys")))


@register("set1_key_difference", O.with_ctes(
    "SELECT listing_id FROM (SELECT listing_id FROM calendar_silver EXCEPT SELECT id FROM listings_silver) k"))
def set1_key_difference(lk):
    """SET1: calendar keys without a listing (set difference)."""
    return lk.calendar.select("listing_id").subtract(lk.listings.select(F.col("id").alias("listing_id")))


@register("set3_full_row_duplicates", O.with_ctes(
    "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM "
    "(SELECT count(*) AS n FROM reviews_raw GROUP BY ALL_COLUMNS_PLACEHOLDER) g"
    .replace("ALL_COLUMNS_PLACEHOLDER", "listing_id, id, date, reviewer_id, reviewer_name, comments")))
def set3_full_row_duplicates(lk):
    """SET3: whole-row duplicates in raw reviews (nulls compare equal)."""
    return Q.duplicate_counts(lk.reviews_raw)


@register("set4_key_duplicates", O.with_ctes(
    "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM "
    "(SELECT count(*) AS n FROM reviews_raw GROUP BY id) g"))
def set4_key_duplicates(lk):
    """SET4: duplicate review ids."""
    return Q.duplicate_counts(lk.reviews_raw, ["id"])


@register("set4_composite_key_duplicates", O.with_ctes(
    "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows FROM "
    "(SELECT count(*) AS n FROM calendar_raw GROUP BY listing_id, date) g"))
def set4_composite_key_duplicates(lk):
    """SET4 / DQ6: duplicate (listing_id, date) calendar rows."""
    return Q.duplicate_counts(lk.calendar_raw, ["listing_id", "date"])


@register("dq7_amenities_report", O.rounded(
    "SELECT count(amenities) AS non_null, "
    "count(*) FILTER (WHERE (CASE WHEN json_valid(amenities) THEN json_type(amenities) END) = 'ARRAY') AS parsed, "
    "avg(CASE WHEN (CASE WHEN json_valid(amenities) THEN json_type(amenities) END) = 'ARRAY' THEN json_array_length(amenities) "
    "ELSE 0 END) AS avg_items, "
    "max(CASE WHEN (CASE WHEN json_valid(amenities) THEN json_type(amenities) END) = 'ARRAY' THEN json_array_length(amenities) END) "
    "AS max_items, (SELECT count(DISTINCT m) FROM (SELECT unnest(from_json(CASE WHEN (CASE WHEN json_valid(amenities) "
    "THEN json_type(amenities) END) = 'ARRAY' THEN amenities END, '[\"VARCHAR\"]')) AS m FROM listings_raw) u) AS distinct_members "
    "FROM listings_raw", ["avg_items"]))
def dq7_amenities_report(lk):
    """DQ7 / AGG29: nested JSON field: parse rate, size, distinct members."""
    return Q.list_field_report(lk.listings_raw, "amenities", F.col("amenities"))


@register("agg29_distinct_amenities", O.with_ctes(
    "SELECT m AS amenity, count(*) AS listing_count FROM (SELECT unnest(from_json(CASE WHEN (CASE WHEN json_valid(amenities) "
    "THEN json_type(amenities) END) = 'ARRAY' THEN amenities END, '[\"VARCHAR\"]')) AS m FROM listings_raw) u "
    "WHERE m IS NOT NULL GROUP BY m"))
def agg29_distinct_amenities(lk):
    """AGG29: every distinct member across all lists (whole table) with counts."""
    from ..functions.cleaning import json_string_list
    return (lk.listings_raw.select(F.explode(json_string_list("amenities")).alias("amenity"))
            .groupBy("amenity").agg(F.count(F.lit(1)).alias("listing_count")))


@register("dq8_bathrooms_sources", O.with_ctes(
    "SELECT count(*) FILTER (WHERE bathrooms IS NULL) AS numeric_missing, "
    "count(*) FILTER (WHERE bathrooms_text IS NULL) AS text_missing, "
    "count(*) FILTER (WHERE bathrooms IS NULL AND bathrooms_text IS NULL) AS both_missing, "
    "count(*) FILTER (WHERE bathrooms IS NULL AND bathrooms_text IS NOT NULL) AS recoverable_from_text "
    "FROM listings_raw"))
def dq8_bathrooms_sources(lk):
    """DQ8: numeric vs text bathrooms."""
    return Q.two_source_comparison(lk.listings_raw, "bathrooms", "bathrooms_text")


_DESCRIBE_SQL = _union_sql(
    "SELECT '{c}' AS column_name, count({c}) AS count, avg({c}) AS mean, stddev_samp({c}) AS std, "
    "CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
    "CAST((count(*) - count({c})) * 100.0 / count(*) AS DOUBLE) AS missing_pct, "
    "quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75 "
    "FROM gold", DESCRIBE_COLUMNS)


@register("agg9_describe", O.rounded(_DESCRIBE_SQL, ["mean", "std", "min", "max", "missing_pct", "q25", "q50", "q75"]))
def agg9_describe(lk):
    """AGG9: describe() table of numeric Gold columns with missing %."""
    return Q.describe(lk.gold, DESCRIBE_COLUMNS)


@register("dq9_price_describe", O.rounded(
    "SELECT count(price_clean) AS count, avg(price_clean) AS mean, stddev_samp(price_clean) AS std, "
    "min(price_clean) AS min, quantile_cont(price_clean, 0.25) AS q25, quantile_cont(price_clean, 0.5) AS q50, "
    "quantile_cont(price_clean, 0.75) AS q75, max(price_clean) AS max FROM listings_silver",
    ["mean", "std", "min", "q25", "q50", "q75", "max"]))
def dq9_price_describe(lk):
    """DQ9: price distribution of Silver listings."""
    return Q.describe(lk.listings, ["price_clean"]).drop("column_name", "missing_pct")


@register("srt2_top_prices", O.rounded(
    "SELECT id, price_clean, room_type, neighbourhood_cleansed FROM listings_silver "
    "ORDER BY price_clean DESC NULLS LAST, id LIMIT 10", ["price_clean"]))
def srt2_top_prices(lk):
    """SRT2 / DQ9: ten most expensive listings with context columns."""
    return Q.top_n(lk.listings, "price_clean", 10, ["room_type", "neighbourhood_cleansed"])


@register("dq10_availability_reviews", O.rounded(
    "SELECT avg(availability_365) AS availability_mean, quantile_cont(availability_365, 0.5) AS availability_median, "
    "count(*) FILTER (WHERE availability_365 = 0) AS availability_zero, "
    "count(*) FILTER (WHERE availability_365 = 365) AS availability_full, "
    "avg(number_of_reviews) AS reviews_mean, max(number_of_reviews) AS reviews_max FROM listings_silver",
    ["availability_mean", "availability_median", "reviews_mean"]))
def dq10_availability_reviews(lk):
    """DQ10: availability and review-count extremes."""
    from ..operators.ranking import exact_quantiles
    s = lk.listings
    a = s.agg(F.avg("availability_365").alias("availability_mean"),
              F.count_if(F.col("availability_365") == 0).alias("availability_zero"),
              F.count_if(F.col("availability_365") == 365).alias("availability_full"),
              F.avg("number_of_reviews").alias("reviews_mean"), F.max("number_of_reviews").alias("reviews_max"))
    med = exact_quantiles(s, "availability_365", [0.5], names=["availability_median"])
    return Q._one_row_join(a, med)


@register("dq12_review_text", O.with_ctes(
    "SELECT count(*) AS reviews, count(*) FILTER (WHERE comments IS NULL) AS null_comments, "
    "count(*) FILTER (WHERE length(coalesce(comments, '')) < 5) AS short_comments, "
    "count(DISTINCT listing_id) AS distinct_listings, count(DISTINCT reviewer_id) AS distinct_reviewers "
    "FROM reviews_raw"))
def dq12_review_text(lk):
    """DQ12: review-text quality."""
    return Q.review_text_report(lk.reviews_raw)


@register("dq13_quality_gate", O.rounded(
    "SELECT * FROM (SELECT 'null_pct_price_clean<= 5.0' AS rule, "
    "CAST(count(*) FILTER (WHERE price_clean IS NULL) * 100.0 / count(*) AS DOUBLE) AS observed, "
    "count(*) FILTER (WHERE price_clean IS NULL) * 100.0 / count(*) <= 5.0 AS passed "
    "FROM (SELECT CASE WHEN isnan(p) THEN NULL ELSE p END AS price_clean, id FROM "
    "(SELECT TRY_CAST(regexp_replace(price, '[$,]', '', 'g') AS DOUBLE) AS p, id FROM listings_raw) a) b "
    "UNION ALL SELECT 'not_null_id', CAST(count(*) - count(id) AS DOUBLE), count(*) - count(id) = 0 "
    "FROM listings_raw) r", ["observed"]))
def dq13_quality_gate(lk):
    """DQ13: batch gate on null-price share and a not-null contract."""
    from ..functions.cleaning import money_to_double
    return Q.quality_gate(lk.listings_raw.withColumn("price_clean", money_to_double("price")))


@register("dq14_freshness", O.with_ctes(
    f"SELECT newest, CAST(date_diff('day', newest, DATE '{SCRAPE_DATE}') AS INTEGER) AS age_days, "
    f"date_diff('day', newest, DATE '{SCRAPE_DATE}') <= 7 AS fresh "
    "FROM (SELECT max(TRY_CAST(last_scraped AS DATE)) AS newest FROM listings_raw) m"))
def dq14_freshness(lk):
    """DQ14: newest last_scraped no older than 7 days."""
    return Q.freshness(lk.listings_raw, SCRAPE_DATE)


@register("agg28_review_date_range", O.with_ctes(
    "SELECT min(TRY_CAST(last_review AS DATE)) AS min_date, max(TRY_CAST(last_review AS DATE)) AS max_date, "
    "count(*) FILTER (WHERE TRY_CAST(last_review AS DATE) IS NULL AND last_review IS NOT NULL) AS unparseable, "
    "CAST(date_diff('day', min(TRY_CAST(last_review AS DATE)), max(TRY_CAST(last_review AS DATE))) AS INTEGER) "
    "AS span_days FROM listings_raw"))
def agg28_review_date_range(lk):
    """AGG28: date range, span and unparseable count."""
    return Q.date_range(lk.listings_raw, "last_review")


@register("agg10_room_type_shares", O.rounded(
    "SELECT room_type, count(*) AS listing_count, count(*) * 100.0 / sum(count(*)) OVER () AS share_pct "
    "FROM listings_silver WHERE room_type IS NOT NULL GROUP BY room_type", ["share_pct"]))
def agg10_room_type_shares(lk):
    """AGG10 / WIN6: value counts and shares."""
    from ..operators.analytics import value_shares
    return value_shares(lk.listings, "room_type")


@register("agg11_distinct_counts", O.with_ctes(
    "SELECT count(DISTINCT host_id) AS distinct_hosts, count(DISTINCT neighbourhood_cleansed) AS distinct_neighbourhoods, "
    "count(DISTINCT property_type) AS distinct_property_types FROM listings_silver"))
def agg11_distinct_counts(lk):
    """AGG11: exact distinct counts (nunique: nulls excluded)."""
    return lk.listings.agg(F.count_distinct("host_id").alias("distinct_hosts"),
                           F.count_distinct("neighbourhood_cleansed").alias("distinct_neighbourhoods"),
                           F.count_distinct("property_type").alias("distinct_property_types"))


@register("agg12_distinct_stacked", O.with_ctes(
    "SELECT count(DISTINCT id) AS distinct_ids FROM (SELECT id_a AS id FROM dup_pairs UNION ALL "
    "SELECT id_b FROM dup_pairs) u"))
def agg12_distinct_stacked(lk):
    """AGG12: distinct over two stacked id columns."""
    from ..operators.duplicates import duplicate_pairs
    p = duplicate_pairs(lk.priced)
    return (p.select(F.col("id_a").alias("id")).union(p.select(F.col("id_b").alias("id")))
            .agg(F.count_distinct("id").alias("distinct_ids")))


@register("srt6_first_rows", O.with_ctes(
    "SELECT id, host_id, price FROM listings_raw ORDER BY id LIMIT 5"))
def srt6_first_rows(lk):
    """SRT6: first rows as a sample, by an order key."""
    return lk.listings_raw.select("id", "host_id", "price").orderBy("id").limit(5)


@register("src4_columns")
def src4_columns(lk):
    """SRC4: columns of each raw table (schema only)."""
    return Q.schema_listing({"listings": lk.listings_raw, "calendar": lk.calendar_raw,
                             "reviews": lk.reviews_raw, "neighbourhoods": lk.neighbourhoods_raw})


@register("src5_sample_values", O.with_ctes(
    "SELECT column_name, value FROM (SELECT CAST(listing_id AS VARCHAR) AS listing_id, CAST(id AS VARCHAR) AS id, "
    "CAST(date AS VARCHAR) AS date, CAST(reviewer_id AS VARCHAR) AS reviewer_id, reviewer_name, comments "
    "FROM reviews_raw ORDER BY reviews_raw.id LIMIT 1) s "
    "UNPIVOT INCLUDE NULLS (value FOR column_name IN (COLUMNS(* EXCLUDE ()) ))"
    .replace("COLUMNS(* EXCLUDE ()) ", "listing_id, id, date, reviewer_id, reviewer_name, comments")))
def src5_sample_values(lk):
    """SRC5: one sample row shown as column: value."""
    return Q.sample_row(lk.reviews_raw, "id")


# Each raw file and the columns that order it.
_SAMPLED = {
    "listings_raw": ["id"], "reviews_raw": ["id"], "neighbourhoods_raw": ["neighbourhood"],
    "calendar_raw": ["listing_id", "date", "available", "price", "minimum_nights", "maximum_nights"],
}


@register("src5_sample_rows", O.with_ctes(" UNION ALL ".join(
    f"SELECT '{t}' AS table_name, column_name, value FROM (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM (SELECT * FROM {t} "
    f"ORDER BY {', '.join(f'{c} NULLS LAST' for c in order)} LIMIT 1) r) s UNPIVOT INCLUDE NULLS (value FOR column_name IN (*))"
    for t, order in _SAMPLED.items())))
def src5_sample_rows(lk):
    """SRC5: a sample row of every raw file as column: value."""
    return Q.sample_rows({t: (getattr(lk, t), order) for t, order in _SAMPLED.items()})
