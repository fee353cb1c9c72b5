"""Bronze -> Silver cleaning jobs (JOB1 listings, JOB2 calendar, JOB3 reviews).

Each job is a lazy DataFrame plan built from native column expressions.  One
scalar is computed eagerly because later expressions depend on it: the
99th-percentile price cap (exact, skew-safe).  Row counts in/out are available through
``pyspark.sql.Observation`` (see ``plans/medallion.py``) without extra jobs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..session import bucketed
from ..sources.fixtures import CITY_NAME
from .duplicates import DUPLICATE_DISTANCE_KM, Duplicates
from .ranking import exact_quantiles

# Fixed values of the cleaning rules.
PRICE_CAP_QUANTILE = 0.99
RARE_CATEGORY_PCT = 1.0
LONG_TERM_NIGHTS = 365
MIN_COMMENT_LENGTH = 5
LISTING_DATE_COLUMNS = ["host_since", "last_review", "first_review"]
LISTING_BOOL_COLUMNS = ["host_is_superhost", "host_has_profile_pic", "host_identity_verified", "instant_bookable"]
LISTING_PERCENT_COLUMNS = ["host_response_rate", "host_acceptance_rate"]
LISTING_DROP_COLUMNS = ["calendar_updated", "neighbourhood_group_cleansed", "license", "host_neighbourhood",
                        "bathrooms", "amenities", "host_verifications"]
CALENDAR_DROP_COLUMNS = ["price", "adjusted_price"]


def valid_price(df: DataFrame, price_col: str = "price") -> DataFrame:
    """SCL1 + FLT1: parse money text, keep rows with a non-negative price."""
    out = df.withColumn("price_clean", C.money_to_double(price_col))
    return out.where(F.col("price_clean").isNotNull() & (F.col("price_clean") >= 0))


def price_cap_value(df: DataFrame, q: float = PRICE_CAP_QUANTILE) -> float | None:
    """AGG6: exact global quantile of ``price_clean`` (one scalar)."""
    return exact_quantiles(df, "price_clean", [q], names=["cap"]).first()["cap"]


def cap_prices(df: DataFrame, cap: float) -> DataFrame:
    """SCL11 + SCL16: capped price and strict outlier flag."""
    return (df.withColumn("price_capped", C.cap_upper("price_clean", cap))
              .withColumn("is_price_outlier", C.flag_gt("price_clean", cap)))


def collapse_rare(df: DataFrame, col: str, out: str, min_pct: float = RARE_CATEGORY_PCT,
                  other: str = "Other") -> DataFrame:
    """AGG14: categories under ``min_pct`` % of the non-null rows -> 'Other';
    null stays null.  Only the categories that stay are joined back, at most
    100 / ``min_pct`` rows, so they are broadcast and no row is shuffled by its
    category."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_cnt"))
    total = counts.agg(F.sum("_cnt").alias("_tot")).withColumn("_one", F.lit(1))
    kept = (counts.withColumn("_one", F.lit(1)).join(total, "_one")
            .where(F.col("_cnt") * 100.0 / F.col("_tot") >= min_pct).select(F.col(col).alias("_cat")))
    return (df.join(F.broadcast(kept) if min_pct >= 0.1 else kept, F.col(col) == F.col("_cat"), "left")
              .withColumn(out, F.when(F.col(col).isNull(), F.lit(None).cast("string"))
                          .when(F.col("_cat").isNull(), F.lit(other)).otherwise(F.col(col)))
              .drop("_cat"))


def priced_listings(raw: DataFrame, seen=None) -> DataFrame:
    """The price-filtered raw listings as a table: they feed the cap, the
    duplicate search and the main path.  ``seen`` is called with the number of
    raw rows."""
    return bucketed(valid_price(raw), "id", counted=raw, seen=seen)


def clean_listings(raw: DataFrame, city: str = CITY_NAME, duplicate_km: float = DUPLICATE_DISTANCE_KM) -> DataFrame:
    """JOB1: Bronze listings -> Silver listings."""
    return finish_listings(priced_listings(raw), city, duplicate_km)


def finish_listings(df: DataFrame, city: str = CITY_NAME, duplicate_km: float = DUPLICATE_DISTANCE_KM) -> DataFrame:
    """JOB1 after the price filter."""
    cap = price_cap_value(df)
    df = cap_prices(df, cap)
    # on the price-filtered rows with unrounded coordinates
    df = Duplicates(df, duplicate_km).flag(df)
    for c in LISTING_DATE_COLUMNS:
        if c in df.columns:
            df = df.withColumn(c, C.to_date_or_null(c))
    df = df.withColumn("bathrooms_final", C.first_number_or("bathrooms_text", "bathrooms"))
    for c in LISTING_PERCENT_COLUMNS:
        if c in df.columns:
            df = df.withColumn(c, C.percent_to_double(c))
    for c in LISTING_BOOL_COLUMNS:
        if c in df.columns:
            df = df.withColumn(c, C.tf_to_bool(c))
    df = (df.withColumn("amenities_list", C.json_string_list("amenities"))
            .withColumn("amenities_count", C.list_length("amenities_list"))
            .withColumn("host_verifications_list", C.literal_string_list("host_verifications")))
    df = collapse_rare(df, "property_type", "property_type_grouped")
    df = (df.withColumn("is_long_term_only", C.flag_gt("minimum_nights", LONG_TERM_NIGHTS))
            .withColumn("latitude", C.round_half_even("latitude", 5))
            .withColumn("longitude", C.round_half_even("longitude", 5)))
    if "neighbourhood_cleansed" in df.columns:
        df = df.withColumn("neighbourhood_cleansed", C.title_trim("neighbourhood_cleansed"))
    df = df.withColumn("city", F.lit(city))
    return C.drop_if_present(df, LISTING_DROP_COLUMNS)


def clean_calendar(raw: DataFrame) -> DataFrame:
    """JOB2: typed date and availability, empty price columns dropped, rows
    with minimum_nights > maximum_nights removed (a null comparison keeps)."""
    df = (raw.withColumn("date", C.to_date_or_null("date"))
             .withColumn("available_bool", C.tf_to_bool("available")))
    df = C.drop_if_present(df, CALENDAR_DROP_COLUMNS)
    return df.where(~C.flag_gt("minimum_nights", F.col("maximum_nights")))


def flag_reviews(raw: DataFrame, min_len: int = MIN_COMMENT_LENGTH) -> DataFrame:
    """JOB3 before the drop: typed date, empty text for null comments, flag."""
    return (raw.withColumn("date", C.to_date_or_null("date"))
               .withColumn("comments", C.fill_text("comments"))
               .withColumn("is_low_quality", C.is_short_text("comments", min_len)))
