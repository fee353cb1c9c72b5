"""Silver -> Gold: per-listing fact summaries, neighbourhood aggregates and
the wide master table (AGG1-AGG3, WIN1, JOI1-JOI3, SCL19-SCL22, JOB4).

Facts are reduced to one row per listing *before* the joins (partial
aggregation map-side, one shuffle on ``listing_id``), so the master join is
listing x listing-sized summaries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import derived as D
from ..sources.fixtures import SCRAPE_DATE
from .ranking import attach_average_rank, grouped_median


def review_summary(reviews_flagged: DataFrame) -> DataFrame:
    """AGG1 on reviews *before* the short-comment drop: counts and dates over
    the kept reviews, plus the number of dropped (low-quality) ones.

    The reference sums the flag after the drop, so its count is always 0; we
    count before the drop (documented choice)."""
    keep = ~F.col("is_low_quality")
    return reviews_flagged.groupBy("listing_id").agg(
        F.count(F.when(keep, F.col("id"))).alias("review_count_computed"),
        F.min(F.when(keep, F.col("date"))).alias("first_review_date"),
        F.max(F.when(keep, F.col("date"))).alias("last_review_date"),
        F.sum(F.col("is_low_quality").cast("long")).alias("low_quality_review_count"))


def calendar_summary(calendar: DataFrame) -> DataFrame:
    """AGG2: available days, known days, unavailable days, occupancy upper
    bound (0 known days -> null)."""
    s = calendar.groupBy("listing_id").agg(
        F.coalesce(F.sum(F.col("available_bool").cast("long")), F.lit(0)).alias("days_available"),
        F.count("available_bool").alias("total_days"))
    return (s.withColumn("days_unavailable", F.col("total_days") - F.col("days_available"))
             .withColumn("occupancy_rate_upper_bound",
                         F.try_divide(F.col("days_unavailable").cast("double"), F.col("total_days"))))


def neighbourhood_aggregates(listings: DataFrame, key: str = "neighbourhood_cleansed") -> DataFrame:
    """AGG3 + WIN1: median capped price, listing count, mean rating and the
    average rank of the count (descending) per neighbourhood (null keys
    dropped, as pandas groupby does)."""
    src = listings.where(F.col(key).isNotNull())
    med = grouped_median(src, "price_capped", [key], name="median_price")
    agg = src.groupBy(key).agg(F.count("id").alias("listing_count"),
                               F.avg("review_scores_rating").alias("avg_rating"))
    joined = agg.join(med, key, "left")
    return attach_average_rank(joined, "listing_count", descending=True, out="listing_density_rank")


def derive_listing_fields(df: DataFrame, as_of: str = SCRAPE_DATE, tenure_divisor: float = 365.25) -> DataFrame:
    """SCL19-SCL21."""
    return (df.withColumn("host_tenure_years", D.tenure_years("host_since", as_of, tenure_divisor))
              .withColumn("review_frequency_per_year", D.reviews_per_year("number_of_reviews", "host_tenure_years"))
              .withColumn("price_per_bedroom", D.price_per_bedroom("price_capped", "bedrooms")))


def build_master(listings: DataFrame, reviews_sum: DataFrame, calendar_sum: DataFrame,
                 nbhd: DataFrame, as_of: str = SCRAPE_DATE) -> DataFrame:
    """JOB4: left joins on the listing key (JOI1, JOI2), neighbourhood lookup
    (JOI3, suffix ``_nbhd`` on clash), revenue proxy (SCL22), constant caveat
    flags (SCL17) and derived fields."""
    m = listings.join(reviews_sum, listings["id"] == reviews_sum["listing_id"], "left").drop("listing_id")
    m = m.join(calendar_sum, m["id"] == calendar_sum["listing_id"], "left").drop("listing_id")
    nb = nbhd.select("neighbourhood_cleansed", "median_price", "listing_count")
    clash = [c for c in ("median_price", "listing_count") if c in m.columns]
    for c in clash:
        nb = nb.withColumnRenamed(c, f"{c}_nbhd")
    m = m.join(nb, "neighbourhood_cleansed", "left")
    m = (m.withColumn("estimated_annual_revenue_approx", F.col("price_capped") * F.col("days_unavailable"))
          .withColumn("is_revenue_estimate_approximate", F.lit(True))
          .withColumn("occupancy_includes_host_blocks", F.lit(True)))
    return derive_listing_fields(m, as_of)
