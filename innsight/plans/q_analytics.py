"""Registered queries: market analytics (AGG7-AGG27, WIN2-WIN6, SRT3-SRT5,
GEO3-GEO8, JOI9, FLT4-FLT10, JOB6-JOB13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import derived as D
from ..functions import geo as GEO
from ..operators import analytics as A
from ..operators.ranking import exact_quantiles
from ..sources.fixtures import SCRAPE_DATE
from . import oracle as O
from .registry import register

# Disruption window of AGG25 and first year of AGG22 / AGG23, placed inside the
# fixture's review dates (1995-2001); the operators' defaults are the original's.
DISRUPTION_START, DISRUPTION_END = "1998-03-01", "1999-06-01"
RECENT_YEAR = 1998


# The levels of the one-hot columns.
ROOM_LEVELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]

O.register("calendar_typed", "SELECT * REPLACE (TRY_CAST(date AS DATE) AS date) FROM calendar_raw")


def _available():
    return F.when(F.col("available") == "t", 1.0).otherwise(0.0)


def _labels_values(labels):
    return ", ".join(f"('{lab}', {i})" for i, lab in enumerate(labels))


def _bucket_case(col, bins, labels, what="label"):
    parts = []
    for i, (lo, hi, lab) in enumerate(zip(bins[:-1], bins[1:], labels)):
        val = f"'{lab}'" if what == "label" else str(i)
        parts.append(f"WHEN {col} > {lo} AND {col} <= {hi} THEN {val}")
    return "CASE " + " ".join(parts) + " END"


@register("agg7_median_by_room_type", O.rounded(
    "SELECT room_type, quantile_cont(price_capped, 0.5) AS median FROM eda "
    "WHERE room_type IS NOT NULL AND price_capped IS NOT NULL GROUP BY room_type", ["median"]))
def agg7_median_by_room_type(lk):
    """AGG7: grouped exact median (outliers excluded, FLT4)."""
    return exact_quantiles(lk.eda.where(F.col("room_type").isNotNull()), "price_capped", [0.5], ["room_type"],
                           names=["median"])


@register("agg7_global_medians", O.rounded(
    "SELECT quantile_cont(price_capped, 0.5) AS median_price, avg(price_capped) AS mean_price, "
    "quantile_cont(review_scores_rating, 0.5) AS median_rating FROM eda",
    ["median_price", "mean_price", "median_rating"]))
def agg7_global_medians(lk):
    """AGG7: global medians of price and rating, mean price."""
    e = lk.eda
    a = exact_quantiles(e, "price_capped", [0.5], names=["median_price"])
    b = exact_quantiles(e, "review_scores_rating", [0.5], names=["median_rating"])
    m = e.agg(F.avg("price_capped").alias("mean_price"))
    return A.attach_row(A.attach_row(a, b), m)


@register("agg8_price_by_room_type", O.rounded(
    "SELECT room_type, avg(price_capped) AS mean, count(price_capped) AS count, "
    "quantile_cont(price_capped, 0.5) AS median FROM eda WHERE room_type IS NOT NULL AND price_capped IS NOT NULL "
    "GROUP BY room_type", ["mean", "median"]))
def agg8_price_by_room_type(lk):
    """AGG8: median / mean / count per group."""
    return A.group_stats(lk.eda, "price_capped", ["room_type"])


@register("agg13_rating_share", O.rounded(
    "SELECT avg(CASE WHEN review_scores_rating IS NOT NULL THEN CAST(review_scores_rating >= 4.5 AS DOUBLE) END) * 100 "
    "AS share_pct, avg(CAST(review_scores_rating IS NULL AS DOUBLE)) * 100 AS null_pct FROM gold",
    ["share_pct", "null_pct"]))
def agg13_rating_share(lk):
    """AGG13: share of ratings >= 4.5, share missing (price outliers included)."""
    return A.share_meeting(lk.gold, "review_scores_rating", 4.5)


_HOST_SEG_SQL = f"""
SELECT segment, CAST(segment_order AS INTEGER) AS segment_order, count(*) AS hosts,
       CAST(sum(listing_count) AS BIGINT) AS listings,
       count(*) * 100.0 / (SELECT count(*) FROM (SELECT host_id FROM gold GROUP BY host_id) x) AS pct_hosts,
       sum(listing_count) * 100.0 / (SELECT count(*) FROM gold WHERE host_id IS NOT NULL) AS pct_listings
FROM (SELECT host_id, count(*) AS listing_count,
             {_bucket_case('count(*)', D.HOST_LISTING_BINS, D.HOST_LISTING_LABELS)} AS segment,
             {_bucket_case('count(*)', D.HOST_LISTING_BINS, D.HOST_LISTING_LABELS, 'order')} AS segment_order
      FROM gold WHERE host_id IS NOT NULL GROUP BY host_id) h
GROUP BY segment, segment_order"""


@register("agg15_host_segments", O.rounded(_HOST_SEG_SQL, ["pct_hosts", "pct_listings"]))
def agg15_host_segments(lk):
    """AGG15: hosts and listings per listings-per-host segment."""
    return A.host_segments(lk.gold)


_HOST_TYPE_SQL = f"""
SELECT s.host_type, CAST(s.segment_order AS INTEGER) AS segment_order, CAST(coalesce(c.n, 0) AS BIGINT) AS listing_count,
       coalesce(c.n * 100.0 / (SELECT count(*) FROM gold), 0.0) AS share_pct
FROM (VALUES {_labels_values(D.HOST_TYPE_LABELS)}) s(host_type, segment_order)
LEFT JOIN (SELECT CASE WHEN calculated_host_listings_count = 1 THEN 'Casual (1 listing)'
                       WHEN calculated_host_listings_count <= 5 THEN 'Semi-Pro (2–5)' ELSE 'Commercial (6+)' END AS host_type,
                  count(*) AS n FROM gold GROUP BY 1) c ON c.host_type = s.host_type"""


@register("agg16_host_type_shares", O.rounded(_HOST_TYPE_SQL, ["share_pct"]))
def agg16_host_type_shares(lk):
    """AGG16 + SCL27: listings per host type in fixed order, missing -> 0."""
    return A.host_type_shares(lk.gold)


def _hist_sql(src, col, bins):
    return f"""
SELECT CAST(s.bin AS INTEGER) AS bin, r.lo + s.bin * r.w AS bin_start, r.lo + (s.bin + 1) * r.w AS bin_end,
       CAST(coalesce(c.n, 0) AS BIGINT) AS count
FROM (SELECT min({col}) AS lo, max({col}) AS hi, (max({col}) - min({col})) / {bins} AS w FROM {src}
      WHERE {col} IS NOT NULL) r
CROSS JOIN range(0, {bins}) s(bin)
LEFT JOIN (SELECT CAST(least(floor(CASE WHEN r2.w > 0 THEN ({col} - r2.lo) / r2.w ELSE 0 END), {bins - 1}) AS INTEGER) AS bin,
                  count(*) AS n
           FROM {src}, (SELECT min({col}) AS lo, (max({col}) - min({col})) / {bins} AS w FROM {src}) r2
           WHERE {col} IS NOT NULL GROUP BY 1) c ON c.bin = s.bin"""


@register("agg17_price_histogram", O.rounded(_hist_sql("eda", "price_capped", 60), ["bin_start", "bin_end"]))
def agg17_price_histogram(lk):
    """AGG17: 60 equal-width bins of price (last bin closed)."""
    return A.histogram(lk.eda, "price_capped", 60)


@register("agg17_availability_histogram", O.rounded(_hist_sql("gold", "availability_365", 50), ["bin_start", "bin_end"]))
def agg17_availability_histogram(lk):
    """AGG17: 50 bins of availability."""
    return A.histogram(lk.gold, "availability_365", 50)


_BOX_SQL = """
SELECT q.room_type, q.q1, q.median, q.q3, count(e.price_capped) AS n,
       min(CASE WHEN e.price_capped BETWEEN q.q1 - 1.5 * (q.q3 - q.q1) AND q.q3 + 1.5 * (q.q3 - q.q1) THEN e.price_capped END) AS whisker_low,
       max(CASE WHEN e.price_capped BETWEEN q.q1 - 1.5 * (q.q3 - q.q1) AND q.q3 + 1.5 * (q.q3 - q.q1) THEN e.price_capped END) AS whisker_high,
       count(*) FILTER (WHERE NOT (e.price_capped BETWEEN q.q1 - 1.5 * (q.q3 - q.q1) AND q.q3 + 1.5 * (q.q3 - q.q1))) AS outliers
FROM (SELECT room_type, quantile_cont(price_capped, 0.25) AS q1, quantile_cont(price_capped, 0.5) AS median,
             quantile_cont(price_capped, 0.75) AS q3
      FROM eda WHERE room_type IS NOT NULL AND price_capped IS NOT NULL GROUP BY room_type) q
JOIN eda e ON e.room_type = q.room_type AND e.price_capped IS NOT NULL
GROUP BY q.room_type, q.q1, q.median, q.q3"""


@register("agg18_box_by_room_type", O.rounded(_BOX_SQL, ["q1", "median", "q3", "whisker_low", "whisker_high"]))
def agg18_box_by_room_type(lk):
    """AGG18 / JOB10: box-plot statistics of price per room type."""
    return A.box_stats(lk.eda, "price_capped", ["room_type"])


@register("agg19_neighbourhood_order", O.rounded(
    "SELECT neighbourhood_cleansed, median, row_number() OVER (ORDER BY median DESC NULLS LAST, neighbourhood_cleansed) "
    "AS position FROM (SELECT neighbourhood_cleansed, quantile_cont(price_capped, 0.5) AS median FROM eda "
    "WHERE neighbourhood_cleansed IS NOT NULL AND price_capped IS NOT NULL GROUP BY 1) m", ["median"]))
def agg19_neighbourhood_order(lk):
    """AGG19: neighbourhoods ordered by median price."""
    return A.order_by_median(lk.eda, "price_capped", "neighbourhood_cleansed").select(
        "neighbourhood_cleansed", "median", F.col("position").cast("long").alias("position"))


_MONTHLY_SQL = """
SELECT CAST(last_day(s.m) AS DATE) AS month_end, CAST(coalesce(c.cnt, 0) AS BIGINT) AS count
FROM (SELECT unnest(generate_series(CAST(date_trunc('month', min(date)) AS DATE), CAST(date_trunc('month', max(date)) AS DATE),
                                    INTERVAL 1 MONTH)) AS m FROM reviews_flagged WHERE date IS NOT NULL) s
LEFT JOIN (SELECT last_day(date) AS month_end, count(*) AS cnt FROM reviews_flagged WHERE date IS NOT NULL GROUP BY 1) c
  ON c.month_end = CAST(last_day(s.m) AS DATE)"""
O.register("monthly_reviews", _MONTHLY_SQL)


@register("agg20_monthly_reviews", O.with_ctes("SELECT * FROM monthly_reviews"))
def agg20_monthly_reviews(lk):
    """AGG20: reviews per month with a full month spine; every review counts,
    short comments too."""
    return A.monthly_counts(lk.reviews_flagged, "date")


@register("win2_moving_average", O.rounded(
    "SELECT month_end, count, CASE WHEN count(count) OVER w = 6 THEN avg(count) OVER w END AS moving_avg "
    "FROM monthly_reviews WINDOW w AS (ORDER BY month_end ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING)", ["moving_avg"]))
def win2_moving_average(lk):
    """WIN2 / JOB6: centred 6-month moving average of monthly reviews."""
    return A.centered_moving_average(A.monthly_counts(lk.reviews_flagged, "date"), "month_end", "count")


@register("agg25_disruption_periods", O.rounded(
    f"SELECT *, 100.0 - 100.0 * mean_during / nullif(mean_before, 0) AS drop_pct, "
    f"100.0 * mean_after / nullif(mean_before, 0) AS recovery_pct FROM ("
    f"SELECT avg(CASE WHEN month_end < DATE '{DISRUPTION_START}' THEN count END) AS mean_before, "
    f"avg(CASE WHEN month_end >= DATE '{DISRUPTION_START}' AND month_end <= DATE '{DISRUPTION_END}' THEN count END) AS mean_during, "
    f"avg(CASE WHEN month_end > DATE '{DISRUPTION_END}' THEN count END) AS mean_after FROM monthly_reviews) p",
    ["mean_before", "mean_during", "mean_after", "drop_pct", "recovery_pct"]))
def agg25_disruption_periods(lk):
    """AGG25 / JOB6: mean monthly reviews before / during / after a window."""
    return A.period_comparison(A.monthly_counts(lk.reviews_flagged, "date"), "count", DISRUPTION_START, DISRUPTION_END)


O.register("month_counts", f"SELECT CAST(date_part('month', date) AS INTEGER) AS month, count(*) AS cnt FROM reviews_flagged "
                           f"WHERE date >= DATE '{RECENT_YEAR}-01-01' GROUP BY 1")


@register("agg22_month_of_year", O.rounded(
    "SELECT c.month, c.cnt AS count, strftime(make_date(2000, c.month, 1), '%b') AS month_name, "
    "(SELECT month FROM month_counts ORDER BY cnt DESC, month LIMIT 1) AS peak_month, (SELECT max(cnt) FROM month_counts) AS peak_count, "
    "(SELECT month FROM month_counts ORDER BY cnt, month LIMIT 1) AS trough_month, (SELECT min(cnt) FROM month_counts) AS trough_count, "
    "(SELECT 100.0 * max(cnt) / min(cnt) - 100.0 FROM month_counts) AS swing_pct FROM month_counts c",
    ["swing_pct"]))
def agg22_month_of_year(lk):
    """AGG22 / JOB6: reviews per calendar month, peak, trough, swing."""
    return A.month_of_year_profile(lk.reviews_flagged, "date", RECENT_YEAR)


@register("agg21_weekly_availability", O.rounded(
    "SELECT s.week_end, m.weekly_mean FROM (SELECT unnest(generate_series(min(w), max(w), INTERVAL 7 DAY)) AS week_end "
    "FROM (SELECT CAST(date_trunc('week', date) AS DATE) + 6 AS w FROM calendar_typed WHERE date IS NOT NULL) a) s "
    "LEFT JOIN (SELECT CAST(date_trunc('week', date) AS DATE) + 6 AS week_end, "
    "avg(CASE WHEN available = 't' THEN 1.0 ELSE 0.0 END) AS weekly_mean FROM calendar_typed WHERE date IS NOT NULL "
    "GROUP BY 1) m ON m.week_end = CAST(s.week_end AS DATE)", ["weekly_mean"]))
def agg21_weekly_availability(lk):
    """AGG21 / JOB13: weekly availability rate over every calendar row, weeks
    end on Sunday (null availability counts as unavailable here)."""
    return A.weekly_mean(lk.calendar_typed, "date", _available())


@register("job13_availability_overall", O.rounded(
    "SELECT 100.0 * count(*) FILTER (available = 't') / count(*) AS availability_pct, "
    "100.0 * count(*) FILTER (available IS DISTINCT FROM 't') / count(*) AS occupancy_proxy_pct FROM calendar_raw",
    ["availability_pct", "occupancy_proxy_pct"]))
def job13_availability_overall(lk):
    """JOB13 / AGG13: overall availability rate and occupancy proxy."""
    v = _available()
    return lk.calendar_typed.agg((F.avg(v) * 100).alias("availability_pct"),
                                 ((1 - F.avg(v)) * 100).alias("occupancy_proxy_pct"))


@register("agg23_price_by_review_month", O.rounded(
    "SELECT CAST(month(last_review) AS INTEGER) AS review_month, avg(price_capped) AS mean, count(price_capped) AS count, "
    f"quantile_cont(price_capped, 0.5) AS median FROM eda WHERE last_review >= DATE '{RECENT_YEAR}-01-01' AND price_capped IS NOT NULL "
    "GROUP BY 1", ["mean", "median"]))
def agg23_price_by_review_month(lk):
    """AGG23: price by month of the last review (proxy), recent years only."""
    return A.group_stats(lk.eda.where(F.year("last_review") >= RECENT_YEAR).withColumn("review_month", F.month("last_review")), "price_capped", ["review_month"])


@register("agg24_min_nights_by_month", O.rounded(
    "SELECT CAST(month(date) AS INTEGER) AS month, avg(minimum_nights) AS mean, count(minimum_nights) AS count, "
    "quantile_cont(minimum_nights, 0.5) AS median FROM calendar_typed WHERE date IS NOT NULL AND minimum_nights IS NOT NULL "
    "GROUP BY 1", ["mean", "median"]))
def agg24_min_nights_by_month(lk):
    """AGG24: minimum-night policy by calendar month, over every calendar row."""
    return A.group_stats(lk.calendar_typed.where(F.col("date").isNotNull()).withColumn("month", F.month("date")), "minimum_nights", ["month"])


# The profile's columns.
_PROFILE_COLS = ["price_capped", "accommodates", "minimum_nights", "availability_365", "calculated_host_listings_count"]
O.register("flt9_flagged", """
SELECT *, coalesce(number_of_reviews >= (SELECT quantile_cont(number_of_reviews, 0.75) FROM gold)
          AND review_scores_rating < 4.3, false) AS high_volume_low_score FROM eda""")


def _flagged(lk):
    """FLT9: the third quartile is taken over all of Gold, the rows are those
    without price outliers."""
    q3 = exact_quantiles(lk.gold, "number_of_reviews", [0.75], names=["_q3"])
    high = (F.col("number_of_reviews") >= F.col("_q3")) & (F.col("review_scores_rating") < 4.3)
    return A.attach_row(lk.eda, q3).withColumn("high_volume_low_score", F.coalesce(high, F.lit(False)))


@register("agg26_segment_profile", O.rounded(
    "SELECT high_volume_low_score, column_name, quantile_cont(value, 0.5) AS median FROM (" + "\nUNION ALL\n".join(
        f"SELECT high_volume_low_score, '{c}' AS column_name, CAST({c} AS DOUBLE) AS value FROM flt9_flagged"
        for c in _PROFILE_COLS) + ") u WHERE value IS NOT NULL GROUP BY 1, 2", ["median"]))
def agg26_segment_profile(lk):
    """AGG26 / FLT9: medians of a segment (high volume, low score) vs the rest."""
    f = _flagged(lk)
    arr = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in _PROFILE_COLS])
    st = f.select("high_volume_low_score", F.explode(arr).alias("_s")).select(
        "high_volume_low_score", "_s.column_name", "_s.value")
    return exact_quantiles(st, "value", [0.5], ["high_volume_low_score", "column_name"], names=["median"])


@register("flt9_high_volume_low_score", O.with_ctes(
    "SELECT count(*) FILTER (WHERE high_volume_low_score) AS flagged, count(*) AS listings FROM flt9_flagged"))
def flt9_high_volume_low_score(lk):
    """FLT9: compound predicate reviews >= Q3 and score < 4.3."""
    return _flagged(lk).agg(F.count_if("high_volume_low_score").alias("flagged"), F.count(F.lit(1)).alias("listings"))


@register("agg27_neighbourhood_summary", O.rounded(
    "SELECT neighbourhood_cleansed, count(*) AS listing_count, quantile_cont(price_capped, 0.5) AS median_price, "
    "quantile_cont(occupancy_rate_upper_bound, 0.5) AS median_occupancy, avg(review_scores_rating) AS mean_rating "
    "FROM eda WHERE neighbourhood_cleansed IS NOT NULL GROUP BY 1 ORDER BY listing_count DESC, neighbourhood_cleansed "
    "LIMIT 15", ["median_price", "median_occupancy", "mean_rating"]))
def agg27_neighbourhood_summary(lk):
    """AGG27: neighbourhood summary, top 15 by listings."""
    e = lk.eda.where(F.col("neighbourhood_cleansed").isNotNull())
    k = ["neighbourhood_cleansed"]
    base = e.groupBy(*k).agg(F.count(F.lit(1)).alias("listing_count"), F.avg("review_scores_rating").alias("mean_rating"))
    mp = exact_quantiles(e, "price_capped", [0.5], k, names=["median_price"])
    mo = exact_quantiles(e, "occupancy_rate_upper_bound", [0.5], k, names=["median_occupancy"])
    return (base.join(mp, k, "left").join(mo, k, "left")
            .orderBy(F.col("listing_count").desc(), F.col("neighbourhood_cleansed")).limit(15))


@register("win3_win4_lorenz_gini", O.rounded("""
SELECT any_value(n) AS hosts, CAST(any_value(t) AS BIGINT) AS listings,
       1 - 2 * ((sum(cum / t) - (min(cum) FILTER (WHERE i = 1) / any_value(t) + 1.0) / 2) / (any_value(n) - 1)) AS gini,
       (1 - max(CASE WHEN i = floor(n * 0.8) + 1 THEN cum END) / any_value(t)) * 100 AS pct_listings_top20,
       (1 - max(CASE WHEN i = floor(n * 0.9) + 1 THEN cum END) / any_value(t)) * 100 AS pct_listings_top10
FROM (SELECT c, row_number() OVER (ORDER BY c, host_id) AS i,
             sum(c) OVER (ORDER BY c, host_id ROWS UNBOUNDED PRECEDING) AS cum,
             count(*) OVER () AS n, sum(c) OVER () AS t
      FROM (SELECT host_id, count(*) AS c FROM gold WHERE host_id IS NOT NULL GROUP BY host_id) h) s""",
    ["gini", "pct_listings_top20", "pct_listings_top10"]))
def win3_win4_lorenz_gini(lk):
    """WIN3 + WIN4 / JOB7: Lorenz shares and Gini of listings per host."""
    return A.lorenz_gini(lk.gold)


@register("win5_rating_ecdf", O.rounded(
    "SELECT review_scores_rating, count(*) AS n, sum(count(*)) OVER (ORDER BY review_scores_rating) / "
    "sum(count(*)) OVER () AS ecdf FROM gold WHERE review_scores_rating IS NOT NULL GROUP BY 1",
    ["review_scores_rating", "ecdf"]))
def win5_rating_ecdf(lk):
    """WIN5: empirical CDF of ratings (price outliers included)."""
    return A.ecdf(lk.gold, "review_scores_rating")


_GEO7_BASE = ("SELECT neighbourhood_cleansed, avg(review_scores_rating) AS mean_score, count(review_scores_rating) AS n "
              "FROM gold WHERE neighbourhood_cleansed IS NOT NULL GROUP BY 1 HAVING count(review_scores_rating) >= 20")


@register("geo7_best_worst_neighbourhoods", O.rounded(
    f"(SELECT *, 'top' AS \"end\" FROM ({_GEO7_BASE}) a ORDER BY mean_score DESC, neighbourhood_cleansed LIMIT 10) "
    f"UNION ALL (SELECT *, 'bottom' FROM ({_GEO7_BASE}) b ORDER BY mean_score ASC, neighbourhood_cleansed LIMIT 10)",
    ["mean_score"]))
def geo7_best_worst_neighbourhoods(lk):
    """GEO7 / SRT3 / FLT7: best and worst neighbourhoods by mean score among
    those with >= 20 scored listings (HAVING)."""
    g = (lk.gold.where(F.col("neighbourhood_cleansed").isNotNull()).groupBy("neighbourhood_cleansed")
         .agg(F.avg("review_scores_rating").alias("mean_score"), F.count("review_scores_rating").alias("n"))
         .where(F.col("n") >= 20))
    return A.head_tail(g, "mean_score", "neighbourhood_cleansed", 10)


@register("flt7_having_min_count", O.with_ctes(
    "SELECT room_type, count(*) AS listing_count FROM eda GROUP BY room_type HAVING count(*) >= 20"))
def flt7_having_min_count(lk):
    """FLT7: groups kept only with at least 20 rows."""
    return lk.eda.groupBy("room_type").agg(F.count(F.lit(1)).alias("listing_count")).where(F.col("listing_count") >= 20)


@register("srt4_top_property_types", O.with_ctes(
    "SELECT property_type_grouped, count(*) AS listing_count FROM eda WHERE property_type_grouped IS NOT NULL "
    "GROUP BY 1 ORDER BY listing_count DESC, property_type_grouped LIMIT 5"))
def srt4_top_property_types(lk):
    """SRT4: top 5 categories by count."""
    return A.top_k_counts(lk.eda, "property_type_grouped", 5)


@register("flt6_top_neighbourhood_members", O.with_ctes(
    "SELECT count(*) AS listings FROM eda WHERE neighbourhood_cleansed IN (SELECT neighbourhood_cleansed FROM eda "
    "WHERE neighbourhood_cleansed IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, neighbourhood_cleansed LIMIT 10)"))
def flt6_top_neighbourhood_members(lk):
    """FLT6: rows whose key is in a computed key set (top 10 neighbourhoods)."""
    keys = A.top_k_counts(lk.eda, "neighbourhood_cleansed", 10)
    return A.in_key_set(lk.eda, keys, "neighbourhood_cleansed").agg(F.count(F.lit(1)).alias("listings"))


@register("flt5_complete_cases", O.with_ctes(
    "SELECT count(*) AS complete_rows FROM eda WHERE price_capped IS NOT NULL AND accommodates IS NOT NULL "
    "AND bedrooms IS NOT NULL AND bathrooms_final IS NOT NULL AND review_scores_rating IS NOT NULL"))
def flt5_complete_cases(lk):
    """FLT5: complete cases over the regression columns."""
    cols = ["price_capped", "accommodates", "bedrooms", "bathrooms_final", "review_scores_rating"]
    return A.complete_cases(lk.eda, cols).agg(F.count(F.lit(1)).alias("complete_rows"))


@register("flt10_reviews_by_year_since", O.with_ctes(
    "SELECT CAST(year(date) AS INTEGER) AS year, count(*) AS reviews FROM reviews_silver WHERE year(date) >= 1998 "
    "GROUP BY 1"))
def flt10_reviews_by_year_since(lk):
    """FLT10: period filter (year >= start) then count per year."""
    r = lk.reviews.where(F.year("date") >= 1998)
    return r.groupBy(F.year("date").alias("year")).agg(F.count(F.lit(1)).alias("reviews"))


_HEX_X = ("(longitude - (SELECT min(longitude) FROM eda)) * (60 / ((SELECT max(longitude) FROM eda) - "
          "(SELECT min(longitude) FROM eda)))")
_HEX_Y = ("(latitude - (SELECT min(latitude) FROM eda)) * (34 / ((SELECT max(latitude) FROM eda) - "
          "(SELECT min(latitude) FROM eda)))")


@register("geo3_hexbin_median_price", O.rounded(f"""
SELECT cell, count(*) AS n, quantile_cont(price_capped, 0.5) AS median_value FROM (
  SELECT price_capped,
         CASE WHEN pow(ix - round_even(ix, 0), 2) + 3.0 * pow(iy - round_even(iy, 0), 2) < pow(ix - floor(ix) - 0.5, 2) + 3.0 * pow(iy - floor(iy) - 0.5, 2)
              THEN CAST(round_even(ix, 0) AS BIGINT) * 35 + CAST(round_even(iy, 0) AS BIGINT)
              ELSE 61 * 35 + CAST(floor(ix) AS BIGINT) * 34 + CAST(floor(iy) AS BIGINT) END AS cell
  FROM (SELECT price_capped, {_HEX_X} AS ix, {_HEX_Y} AS iy FROM eda
        WHERE longitude IS NOT NULL AND latitude IS NOT NULL AND price_capped IS NOT NULL) a) c
GROUP BY cell HAVING count(*) >= 3""", ["median_value"]))
def geo3_hexbin_median_price(lk):
    """GEO3: hexagonal grid (gridsize 60), median price per cell, >= 3 points."""
    return A.hexbin_median(lk.eda, "longitude", "latitude", "price_capped")


@register("geo4_density_grid", O.with_ctes(
    "SELECT CAST(floor(latitude / 0.01) AS BIGINT) AS cell_lat, CAST(floor(longitude / 0.01) AS BIGINT) AS cell_lon, "
    "count(*) AS n FROM gold WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2"))
def geo4_density_grid(lk):
    """GEO4: point density on a 0.01-degree grid."""
    return A.grid_counts(lk.gold, "latitude", "longitude", 0.01)


@register("geo5_score_grid", O.rounded(
    "SELECT CAST(floor(latitude / 0.01) AS BIGINT) AS cell_lat, CAST(floor(longitude / 0.01) AS BIGINT) AS cell_lon, "
    "round(sum(CAST(round(review_scores_rating * 100) AS BIGINT)) / (count(*) * 100.0), 4) AS mean_value, count(*) AS n, "
    "(SELECT quantile_cont(review_scores_rating, 0.05) FROM gold WHERE latitude IS NOT NULL AND longitude IS NOT NULL) AS colour_floor "
    "FROM gold WHERE review_scores_rating IS NOT NULL AND latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2", ["mean_value", "colour_floor"]))
def geo5_score_grid(lk):
    """GEO5: mean score per grid cell with the 5 % quantile as colour floor."""
    scored = lk.gold.dropna(subset=["review_scores_rating", "latitude", "longitude"])
    g = A.grid_mean(scored, "latitude", "longitude", "review_scores_rating", 0.01).withColumn("mean_value", F.round("mean_value", 4))
    q = exact_quantiles(scored, "review_scores_rating", [0.05], names=["colour_floor"])
    return A.attach_row(g, q)


@register("geo6_density_by_room_type", O.with_ctes(
    "SELECT room_type, CAST(floor(latitude / 0.01) AS BIGINT) AS cell_lat, CAST(floor(longitude / 0.01) AS BIGINT) AS cell_lon, "
    "count(*) AS n FROM eda WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY 1, 2, 3"))
def geo6_density_by_room_type(lk):
    """GEO6: density per room type."""
    return A.grid_counts(lk.eda, "latitude", "longitude", 0.01, ["room_type"])


_FLAT = ("sqrt(pow((latitude - -33.9249) * 111.0, 2) + pow((longitude - 18.4241) * 111.0 * cos(radians(-33.9249)), 2))")


@register("geo8_distance_price", O.rounded(
    f"SELECT corr(d, p) AS r, regr_slope(p, d) AS slope, regr_intercept(p, d) AS intercept, count(*) AS n "
    f"FROM (SELECT {_FLAT} AS d, price_capped AS p FROM eda) x WHERE d IS NOT NULL AND p IS NOT NULL",
    ["r", "slope", "intercept"]))
def geo8_distance_price(lk):
    """GEO8 / STA19: distance to centre vs price, r and trend line."""
    return A.distance_price_trend(lk.eda, "latitude", "longitude", "price_capped")


@register("joi9_room_type_alignment", O.rounded(
    "SELECT room_type, coalesce(100.0 * count(*) FILTER (high_volume_low_score) / "
    "nullif((SELECT count(*) FROM flt9_flagged WHERE high_volume_low_score AND room_type IS NOT NULL), 0), 0.0) AS flagged_pct, "
    "100.0 * count(*) / (SELECT count(*) FROM flt9_flagged WHERE room_type IS NOT NULL) AS all_pct "
    "FROM flt9_flagged WHERE room_type IS NOT NULL GROUP BY room_type", ["flagged_pct", "all_pct"]))
def joi9_room_type_alignment(lk):
    """JOI9: room-type shares of the flagged segment (FLT9) against all
    listings, outer alignment, missing -> 0."""
    f = _flagged(lk)
    a = A.value_shares(f.where("high_volume_low_score"), "room_type")
    b = A.value_shares(f, "room_type")
    return A.outer_align(a, b, "room_type", "share_pct", "share_pct").toDF("room_type", "flagged_pct", "all_pct")


@register("job8_response_rate_trend", O.rounded(
    "SELECT regr_slope(review_scores_rating, host_response_rate) AS slope, "
    "regr_intercept(review_scores_rating, host_response_rate) AS intercept, regr_count(review_scores_rating, host_response_rate) AS n "
    "FROM eda", ["slope", "intercept"]))
def job8_response_rate_trend(lk):
    """JOB8 / STA19: trend line of review score on host response rate."""
    both = lk.eda.dropna(subset=["host_response_rate", "review_scores_rating"])
    return both.agg(F.regr_slope("review_scores_rating", "host_response_rate").alias("slope"),
                    F.regr_intercept("review_scores_rating", "host_response_rate").alias("intercept"),
                    F.count(F.lit(1)).alias("n"))


@register("job8_superhost_comparison", O.rounded(
    "SELECT CASE WHEN host_is_superhost THEN 'Superhost' ELSE 'Not Superhost' END AS superhost_label, count(*) AS listings, "
    "quantile_cont(price_capped, 0.5) AS median_price, quantile_cont(review_scores_rating, 0.5) AS median_rating "
    "FROM eda WHERE host_is_superhost IS NOT NULL GROUP BY 1", ["median_price", "median_rating"]))
def job8_superhost_comparison(lk):
    """JOB8 (SCL29, AGG7): medians of price and rating per superhost badge
    (the badge is already boolean in Silver; null badge dropped)."""
    e = lk.eda.where(F.col("host_is_superhost").isNotNull()).withColumn(
        "superhost_label", D.bool_label("host_is_superhost", "Superhost", "Not Superhost"))
    k = ["superhost_label"]
    n = e.groupBy(*k).agg(F.count(F.lit(1)).alias("listings"))
    mp = exact_quantiles(e, "price_capped", [0.5], k, names=["median_price"])
    mr = exact_quantiles(e, "review_scores_rating", [0.5], k, names=["median_rating"])
    return n.join(mp, k, "left").join(mr, k, "left")


_TIER_SQL = f"""
SELECT s.tier, CAST(s.tier_order AS INTEGER) AS tier_order, CAST(coalesce(c.listings, 0) AS BIGINT) AS listings, m.median_price
FROM (VALUES {_labels_values(D.DEMAND_TIER_LABELS)}) s(tier, tier_order)
LEFT JOIN (SELECT {_bucket_case('number_of_reviews_ltm', D.DEMAND_TIER_BINS, D.DEMAND_TIER_LABELS)} AS tier,
                  count(*) AS listings FROM gold GROUP BY 1) c ON c.tier = s.tier
LEFT JOIN (SELECT {_bucket_case('number_of_reviews_ltm', D.DEMAND_TIER_BINS, D.DEMAND_TIER_LABELS)} AS tier,
                  quantile_cont(price_capped, 0.5) AS median_price FROM eda GROUP BY 1) m ON m.tier = s.tier"""


@register("job11_demand_tiers", O.rounded(_TIER_SQL, ["median_price"]))
def job11_demand_tiers(lk):
    """JOB11 (SCL26, AGG16, AGG8): listings per demand tier over all of Gold,
    median price per tier without price outliers."""
    lab, _ = D.right_closed_bucket("number_of_reviews_ltm", D.DEMAND_TIER_BINS, D.DEMAND_TIER_LABELS)
    e = lk.eda.withColumn("tier", lab)
    seg = A.segment_counts(lk.gold.withColumn("tier", lab), "tier", D.DEMAND_TIER_LABELS, name="listings").select(
        "tier", F.col("segment_order").alias("tier_order"), "listings")
    med = exact_quantiles(e.where(F.col("tier").isNotNull()), "price_capped", [0.5], ["tier"], names=["median_price"])
    return seg.join(med, "tier", "left")


_TENURE = "date_diff('day', host_since, DATE '2025-09-28') / 365.0"


@register("job12_tenure_tiers", O.rounded(
    f"SELECT tier, avg(price_capped) AS mean, count(price_capped) AS count, quantile_cont(price_capped, 0.5) AS median "
    f"FROM (SELECT price_capped, {_bucket_case(_TENURE, D.TENURE_BINS, D.TENURE_LABELS)} AS tier FROM eda) t "
    f"WHERE tier IS NOT NULL AND price_capped IS NOT NULL GROUP BY tier", ["mean", "median"]))
def job12_tenure_tiers(lk):
    """JOB12 (SCL19 with 365, SCL26, AGG8): price by host tenure tier."""
    lab, _ = D.right_closed_bucket(D.tenure_years("host_since", SCRAPE_DATE, 365.0), D.TENURE_BINS, D.TENURE_LABELS)
    return A.group_stats(lk.eda.withColumn("tier", lab), "price_capped", ["tier"])


@register("job10_price_by_property_type", O.rounded(
    "SELECT property_type_grouped, avg(price_capped) AS mean, count(price_capped) AS count, "
    "quantile_cont(price_capped, 0.5) AS median FROM eda WHERE property_type_grouped IS NOT NULL "
    "AND price_capped IS NOT NULL GROUP BY 1", ["mean", "median"]))
def job10_price_by_property_type(lk):
    """JOB10: price structure by property type."""
    return A.group_stats(lk.eda, "price_capped", ["property_type_grouped"])


@register("scl31_one_hot_room_type", O.with_ctes(
    "SELECT id, " + ", ".join(
        f"CAST(room_type = '{lv}' AS INTEGER) AS \"room_type_{lv}\""
        for lv in ["2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]) + " FROM eda"))
def scl31_one_hot_room_type(lk):
    """SCL31: a dummy column per level of the caller's list, first dropped."""
    return D.one_hot(lk.eda.select("id", "room_type"), "room_type", ROOM_LEVELS).drop("room_type")


@register("scl31_dummies_long", O.with_ctes(
    "SELECT id, room_type AS level FROM eda WHERE room_type > (SELECT min(room_type) FROM eda)"))
def scl31_dummies_long(lk):
    """SCL31 for any number of levels: the (id, level) of every dummy that is
    one; the first level has none."""
    first = lk.eda.agg(F.min("room_type").alias("_first"))
    return A.attach_row(lk.eda.select("id", F.col("room_type").alias("level")), first).where("level > _first").drop("_first")


_NIGHTS_BINS, _NIGHTS_LABELS = [0, 1, 2, 7, 30, 9999], ["1 night", "2 nights", "3–7 nights", "8–30 nights", "30+ nights"]


@register("agg8_price_by_minimum_nights", O.rounded(
    f"SELECT bucket, quantile_cont(price_capped, 0.5) AS median, count(*) AS count FROM (SELECT price_capped, "
    f"{_bucket_case('minimum_nights', _NIGHTS_BINS, _NIGHTS_LABELS)} AS bucket FROM eda) b "
    "WHERE bucket IS NOT NULL AND price_capped IS NOT NULL GROUP BY bucket", ["median"]))
def agg8_price_by_minimum_nights(lk):
    """AGG8 / JOB6: median price per minimum-night bucket."""
    lab, _ = D.right_closed_bucket("minimum_nights", _NIGHTS_BINS, _NIGHTS_LABELS)
    return A.group_stats(lk.eda.withColumn("bucket", lab), "price_capped", ["bucket"]).select("bucket", "median", "count")
