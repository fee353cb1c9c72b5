"""Registered queries: cleaning scalars, Silver, Gold, star schema, Q1-Q4,
duplicate pairs (SRC*, SCL*, FLT1-3, JOI1-5, AGG1-6, AGG14, WIN1, SET2, SET5,
DQ11, DQ15, JOB1-5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..functions import derived as D
from ..functions import geo as GEO
from ..operators import duplicates as DUP
from ..operators import warehouse as W
from ..operators.silver import collapse_rare, valid_price
from . import oracle as O
from .registry import register

_ARRAYS = ["amenities_list", "host_verifications_list"]


def _silver_flat(lk):
    s = lk.listings
    return s.withColumn("host_verifications_count", F.size("host_verifications_list")).drop(*_ARRAYS)


@register("job1_silver_listings", O.rounded("SELECT * FROM listings_silver", O.SILVER_LISTING_DOUBLES))
def job1_silver_listings(lk):
    """JOB1 (SCL1-SCL18, FLT1, AGG6, AGG14, DQ11 flag): Silver listings,
    list columns shown by their length."""
    return _silver_flat(lk)


@register("job2_silver_calendar", O.rounded("SELECT * FROM calendar_silver", ["minimum_nights", "maximum_nights"]))
def job2_silver_calendar(lk):
    """JOB2 (SCL5, SCL4, SCL18, FLT2)."""
    return lk.calendar


@register("job3_silver_reviews", O.with_ctes("SELECT * FROM reviews_silver"))
def job3_silver_reviews(lk):
    """JOB3 (SCL5, SCL14, SCL15, FLT3)."""
    return lk.reviews


@register("agg1_review_summary", O.with_ctes("SELECT * FROM review_summary"))
def agg1_review_summary(lk):
    return lk.review_summary


@register("agg2_calendar_summary", O.rounded("SELECT * FROM calendar_summary", ["occupancy_rate_upper_bound"]))
def agg2_calendar_summary(lk):
    return lk.calendar_summary


@register("agg3_neighbourhood_aggregates",
          O.rounded("SELECT * FROM nbhd_agg", ["median_price", "avg_rating", "listing_density_rank"]))
def agg3_neighbourhood_aggregates(lk):
    """AGG3 + WIN1 (average rank, descending)."""
    return lk.neighbourhoods


@register("job4_gold_master", O.rounded("SELECT * FROM gold", O.GOLD_DOUBLES))
def job4_gold_master(lk):
    """JOB4 (JOI1-JOI3, SCL17, SCL19-SCL22)."""
    return lk.gold.withColumn("host_verifications_count", F.size("host_verifications_list")).drop(*_ARRAYS)


@register("set5_dim_date", O.with_ctes("SELECT * FROM dim_date"))
def set5_dim_date(lk):
    """SET5 + SCL23 (JOB5 date dimension)."""
    return lk.dim_date


@register("q1_top_neighbourhoods", O.rounded(
    "SELECT DISTINCT neighbourhood_cleansed, median_price, listing_count FROM gold "
    "ORDER BY median_price DESC NULLS LAST, neighbourhood_cleansed LIMIT 10", ["median_price"]))
def q1_top_neighbourhoods(lk):
    """SRT1 / Q1 on dim_listing."""
    return W.q1_top_neighbourhoods(lk.gold)


@register("q2_occupancy_by_room_type", O.rounded(
    "SELECT room_type, avg(occupancy_rate_upper_bound) AS avg_occupancy_upper_bound FROM gold GROUP BY room_type",
    ["avg_occupancy_upper_bound"]))
def q2_occupancy_by_room_type(lk):
    """AGG4 / Q2."""
    return W.q2_occupancy_by_room_type(lk.gold)


@register("q3_superhost_rating", O.rounded(
    "SELECT host_is_superhost, sum(review_scores_rating) / count(review_scores_rating) AS avg_rating, count(*) AS listing_count "
    "FROM gold GROUP BY ALL", ["avg_rating"]))
def q3_superhost_rating(lk):
    """AGG4 / Q3 (null group kept)."""
    return W.q3_superhost_rating(lk.gold)


@register("q4_weekend_availability", O.rounded(
    "SELECT isodow(date) >= 6 AS is_weekend, count(*) FILTER (available_bool) / count(*) AS avg_availability_rate "
    "FROM calendar_silver WHERE date IS NOT NULL GROUP BY 1", ["avg_availability_rate"]))
def q4_weekend_availability(lk):
    """AGG5 on JOI4 / Q4 / STA23."""
    return W.q4_weekend_availability(lk.calendar, lk.dim_date)


@register("joi5_duplicate_pairs", O.rounded("SELECT * FROM dup_pairs", ["distance_km"]))
def joi5_duplicate_pairs(lk):
    """JOI5: same-host pairs under 50 m (on price-filtered, unrounded rows)."""
    return DUP.duplicate_pairs(lk.priced)


@register("dq11_duplicate_summary", O.with_ctes(
    "SELECT CAST(count(*) AS BIGINT) AS pair_count, "
    "(SELECT count(*) FROM dup_ids) AS listings_involved, count(DISTINCT host_id) AS hosts_involved FROM dup_pairs"))
def dq11_duplicate_summary(lk):
    """DQ11 / AGG30: pair count, listings and hosts involved."""
    return DUP.Duplicates(lk.priced).summary()


@register("agg30_pairs_per_host", O.with_ctes(
    "SELECT host_id, count(*) AS pair_count FROM dup_pairs GROUP BY host_id"))
def agg30_pairs_per_host(lk):
    """AGG30: candidate pairs per host."""
    return DUP.Duplicates(lk.priced).per_host()


@register("set2_flagged_ids", O.with_ctes("SELECT id FROM dup_ids"))
def set2_flagged_ids(lk):
    """SET2: ids on either side of a pair, de-duplicated."""
    return DUP.Duplicates(lk.priced).flagged().select("id")


@register("agg6_price_cap", O.rounded("SELECT cap AS price_cap FROM l_cap", ["price_cap"]))
def agg6_price_cap(lk):
    """AGG6: exact 0.99 quantile of the valid prices."""
    from ..operators.ranking import exact_quantiles
    return exact_quantiles(lk.priced, "price_clean", [0.99], names=["price_cap"])


@register("agg14_property_type_groups", O.with_ctes(
    "SELECT property_type_grouped, count(*) AS listing_count FROM listings_silver GROUP BY property_type_grouped"))
def agg14_property_type_groups(lk):
    """AGG14: rare categories collapsed; counts per final group."""
    d = collapse_rare(lk.priced, "property_type", "property_type_grouped")
    return d.groupBy("property_type_grouped").agg(F.count(F.lit(1)).alias("listing_count"))


@register("flt2_calendar_dropped", O.with_ctes(
    "SELECT count(*) AS dropped_rows FROM calendar_raw WHERE coalesce(minimum_nights > maximum_nights, false)"))
def flt2_calendar_dropped(lk):
    """FLT2 report: rows removed because minimum > maximum nights."""
    return lk.calendar_raw.where(C.flag_gt("minimum_nights", F.col("maximum_nights"))).agg(
        F.count(F.lit(1)).alias("dropped_rows"))


@register("flt1_price_dropped", O.with_ctes(
    "SELECT (SELECT count(*) FROM listings_raw) - (SELECT count(*) FROM l_priced) AS dropped_rows"))
def flt1_price_dropped(lk):
    """FLT1 report: rows dropped for a missing or negative price."""
    raw = lk.listings_raw.withColumn("price_clean", C.money_to_double("price"))
    return raw.agg(F.count(F.when(~(F.col("price_clean").isNotNull() & (F.col("price_clean") >= 0)), 1))
                   .alias("dropped_rows"))


@register("dq15_dim_date_types")
def dq15_dim_date_types(lk):
    """DQ15: dim_date column types against the contract (schema-level)."""
    return W.schema_check(lk.dim_date)


# Scalar cleaning / derivation functions one by one over the raw listings:
# (name, Spark column, DuckDB expression, is_double)
def _scalar_specs():
    yield ("scl01_money_to_double", lambda: C.money_to_double("price"),
           "CASE WHEN isnan(TRY_CAST(regexp_replace(price, '[$,]', '', 'g') AS DOUBLE)) THEN NULL "
           "ELSE TRY_CAST(regexp_replace(price, '[$,]', '', 'g') AS DOUBLE) END", True)
    yield ("scl02_percent_to_double", lambda: C.percent_to_double("host_response_rate"),
           "TRY_CAST(replace(host_response_rate, '%', '') AS DOUBLE)", True)
    yield ("scl03_first_number", lambda: C.first_number_or("bathrooms_text", "bathrooms"),
           "CASE WHEN bathrooms_text IS NULL THEN bathrooms ELSE "
           "TRY_CAST(regexp_extract(bathrooms_text, '(\\d+\\.?\\d*)', 1) AS DOUBLE) END", True)
    yield ("scl04_tf_to_bool", lambda: C.tf_to_bool("host_is_superhost"),
           "CASE host_is_superhost WHEN 't' THEN true WHEN 'f' THEN false END", False)
    yield ("scl05_date_or_null", lambda: C.to_date_or_null("last_review"), "TRY_CAST(last_review AS DATE)", False)
    yield ("scl06_json_list_length", lambda: C.list_length(C.json_string_list("amenities")),
           "CASE WHEN (CASE WHEN json_valid(amenities) THEN json_type(amenities) END) = 'ARRAY' THEN json_array_length(amenities) "
           "ELSE 0 END", False)
    yield ("scl07_literal_list_length", lambda: C.list_length(C.literal_string_list("host_verifications")),
           "CASE WHEN json_valid(replace(regexp_replace(host_verifications, '\\bNone\\b', 'null', 'g'), '''', '\"')) "
           "THEN json_array_length(replace(regexp_replace(host_verifications, '\\bNone\\b', 'null', 'g'), '''', '\"')) "
           "ELSE 0 END", False)
    yield ("scl08_amenities_first", lambda: F.get(C.json_string_list("amenities"), 0),
           "CASE WHEN (CASE WHEN json_valid(amenities) THEN json_type(amenities) END) = 'ARRAY' THEN amenities->>0 END", False)
    yield ("scl09_title_trim", lambda: C.title_trim("neighbourhood_cleansed"),
           "concat(upper(substr(trim(neighbourhood_cleansed), 1, 1)), lower(substr(trim(neighbourhood_cleansed), 2)))",
           False)
    yield ("scl10_round_half_even", lambda: C.round_half_even("latitude", 3), "round_even(latitude, 3)", True)
    yield ("scl11_cap_upper", lambda: C.cap_upper("bedrooms", 2.0),
           "CASE WHEN bedrooms IS NULL THEN NULL ELSE least(bedrooms, 2.0) END", True)
    yield ("scl12_floor_lower", lambda: C.floor_lower("bathrooms", 0.1),
           "CASE WHEN bathrooms IS NULL THEN NULL ELSE greatest(bathrooms, 0.1) END", True)
    yield ("scl13_replace_value", lambda: C.replace_value("bedrooms", 0, 1.0),
           "CASE WHEN bedrooms = 0 THEN 1.0 ELSE bedrooms END", True)
    yield ("scl14_fill_text", lambda: C.fill_text("bathrooms_text"), "coalesce(bathrooms_text, '')", False)
    yield ("scl15_short_text", lambda: C.is_short_text(C.fill_text("bathrooms_text"), 5),
           "length(coalesce(bathrooms_text, '')) < 5", False)
    yield ("scl16_flag_gt", lambda: C.flag_gt("minimum_nights", 365), "coalesce(minimum_nights > 365, false)", False)
    yield ("scl19_tenure_years", lambda: D.tenure_years(C.to_date_or_null("host_since"), "2025-09-28", 365.0),
           "date_diff('day', TRY_CAST(host_since AS DATE), DATE '2025-09-28') / 365.0", True)
    yield ("scl23_day_of_week", lambda: D.day_of_week_sun0(C.to_date_or_null("last_review")),
           "CAST(dayofweek(TRY_CAST(last_review AS DATE)) AS INTEGER)", False)
    yield ("scl24_month_name", lambda: D.month_short_name(F.month(C.to_date_or_null("last_review"))),
           "strftime(TRY_CAST(last_review AS DATE), '%b')", False)
    yield ("scl25_log1p", lambda: F.log1p(F.col("accommodates")), "ln(1 + accommodates)", True)
    yield ("scl27_host_type", lambda: D.host_type("calculated_host_listings_count"),
           "CASE WHEN calculated_host_listings_count = 1 THEN 'Casual (1 listing)' "
           "WHEN calculated_host_listings_count <= 5 THEN 'Semi-Pro (2–5)' ELSE 'Commercial (6+)' END", False)
    yield ("scl28_two_way_label", lambda: D.two_way_label("number_of_reviews", 10, "High", "Low"),
           "CASE WHEN number_of_reviews > 10 THEN 'High' ELSE 'Low' END", False)
    yield ("scl29_bool_label", lambda: D.bool_label(C.tf_to_bool("host_is_superhost"), "Superhost", "Not Superhost"),
           "CASE host_is_superhost WHEN 't' THEN 'Superhost' WHEN 'f' THEN 'Not Superhost' END", False)
    yield ("scl30_effect_words", lambda: D.effect_size_words((F.col("review_scores_rating") - 4.0) * 2),
           "CASE WHEN abs((review_scores_rating - 4.0) * 2) < 0.2 THEN 'Negligible' "
           "WHEN abs((review_scores_rating - 4.0) * 2) < 0.5 THEN 'Small' "
           "WHEN abs((review_scores_rating - 4.0) * 2) < 0.8 THEN 'Medium' ELSE 'Large' END", False)
    yield ("geo1_haversine_to_centre", lambda: GEO.haversine_km("latitude", "longitude", F.lit(-33.9249), F.lit(18.4241)),
           O.HAVERSINE_SQL.format(lat1="latitude", lon1="longitude", lat2="-33.9249", lon2="18.4241"), True)
    yield ("geo2_flat_distance", lambda: GEO.flat_distance_km("latitude", "longitude"),
           "sqrt(pow((latitude - -33.9249) * 111.0, 2) + pow((longitude - 18.4241) * 111.0 * cos(radians(-33.9249)), 2))",
           True)


def _register_scalar(name, col, sql, is_double):
    @register(name, O.rounded(f"SELECT id, {sql} AS value FROM listings_raw", ["value"] if is_double else []))
    def _q(lk):
        return lk.listings_raw.select("id", col().alias("value"))
    _q.__doc__ = f"{name.split('_')[0].upper()}: scalar function over every raw listing."


for _spec in _scalar_specs():
    _register_scalar(*_spec)


def _bucket_query(name, col, bins, labels, sql_col):
    conds = " ".join(f"WHEN {sql_col} > {lo} AND {sql_col} <= {hi} THEN '{lab}'"
                     for lo, hi, lab in zip(bins[:-1], bins[1:], labels))
    orders = " ".join(f"WHEN {sql_col} > {lo} AND {sql_col} <= {hi} THEN {i}"
                      for i, (lo, hi) in enumerate(zip(bins[:-1], bins[1:])))
    sql = (f"SELECT label, CAST(bucket_order AS INTEGER) AS bucket_order, count(*) AS listing_count FROM ("
           f"SELECT CASE {conds} END AS label, CASE {orders} END AS bucket_order FROM listings_raw) b "
           f"GROUP BY label, bucket_order")

    @register(name, O.with_ctes(sql))
    def _q(lk):
        lab, order = D.right_closed_bucket(F.col(col), bins, labels)
        return (lk.listings_raw.select(lab.alias("label"), order.alias("bucket_order"))
                .groupBy("label", "bucket_order").agg(F.count(F.lit(1)).alias("listing_count")))
    _q.__doc__ = "SCL26: right-closed buckets, outside -> null label."


_bucket_query("scl26_min_night_buckets", "minimum_nights", D.MIN_NIGHT_BINS, D.MIN_NIGHT_LABELS,
              "minimum_nights")
_bucket_query("scl26_demand_tiers", "number_of_reviews_ltm", D.DEMAND_TIER_BINS, D.DEMAND_TIER_LABELS,
              "number_of_reviews_ltm")
