"""Derived columns, date parts, buckets and labels (SCL19-SCL31)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .cleaning import _c, floor_lower, replace_value

# Segment bins and labels used by the analyses.
HOST_LISTING_BINS = [0, 1, 2, 5, 10, 20, 50, 500]
HOST_LISTING_LABELS = ["1 (solo)", "2", "3–5", "6–10", "11–20", "21–50", "51+"]
TENURE_BINS = [0, 2, 5, 100]
TENURE_LABELS = ["New (< 2 yrs)", "Mid (2–5 yrs)", "Veteran (5+ yrs)"]
MIN_NIGHT_BINS = [0, 1, 2, 7, 30, 9999]
MIN_NIGHT_LABELS = ["1 night", "2 nights", "3–7 nights", "8–30 nights", "30+ nights"]
DEMAND_TIER_BINS = [-1, 0, 5, 15, 30, 9999]
DEMAND_TIER_LABELS = ["Inactive (0)", "Low (1–5)", "Moderate (6–15)", "High (16–30)", "Very High (30+)"]
HOST_TYPE_LABELS = ["Casual (1 listing)", "Semi-Pro (2–5)", "Commercial (6+)"]
EFFECT_D_CUTS = [0.2, 0.5, 0.8]
EFFECT_ETA_CUTS = [0.01, 0.06, 0.14]
EFFECT_WORDS = ["Negligible", "Small", "Medium", "Large"]


def tenure_years(since, as_of: str, divisor: float = 365.25) -> Column:
    """SCL19: whole days from ``since`` to ``as_of`` over ``divisor``."""
    return F.datediff(F.to_date(F.lit(as_of)), _c(since)) / F.lit(divisor)


def reviews_per_year(n_reviews, tenure, floor: float = 0.1) -> Column:
    """SCL20: reviews / max(tenure, 0.1)."""
    return _c(n_reviews) / floor_lower(tenure, floor)


def price_per_bedroom(price, bedrooms) -> Column:
    """SCL21: price / bedrooms with 0 bedrooms counted as 1."""
    return _c(price) / replace_value(bedrooms, 0, 1.0)


def day_of_week_sun0(d) -> Column:
    """SCL23: Sunday = 0 .. Saturday = 6 (Spark's dayofweek is 1-based)."""
    return (F.dayofweek(_c(d)) - 1).cast("int")


def is_weekend(d) -> Column:
    """SCL23: Saturday or Sunday."""
    return day_of_week_sun0(d).isin(0, 6)


def month_short_name(m) -> Column:
    """SCL24: 1 -> 'Jan'."""
    return F.date_format(F.make_date(F.lit(2000), _c(m).cast("int"), F.lit(1)), "MMM")


def right_closed_bucket(c, bins, labels) -> tuple[Column, Column]:
    """SCL26: (label, order) of right-closed buckets (lo, hi]; outside -> null."""
    c = _c(c)
    label = order = None
    for i, (lo, hi) in enumerate(zip(bins[:-1], bins[1:])):
        cond = (c > lo) & (c <= hi)
        label = F.when(cond, F.lit(labels[i])) if label is None else label.when(cond, F.lit(labels[i]))
        order = F.when(cond, F.lit(i)) if order is None else order.when(cond, F.lit(i))
    return label, order


def host_type(n_listings) -> Column:
    """SCL27: 1 -> casual, <= 5 -> semi-pro, else (null included) commercial."""
    n = _c(n_listings)
    casual, semi, commercial = HOST_TYPE_LABELS
    return F.when(n == 1, casual).when(n <= 5, semi).otherwise(commercial)


def two_way_label(c, threshold, above: str, below: str) -> Column:
    """SCL28: label by ``c > threshold`` (null -> below, like numpy.where)."""
    return F.when(_c(c) > threshold, F.lit(above)).otherwise(F.lit(below))


def bool_label(c, true_label: str, false_label: str) -> Column:
    """SCL29: bool -> label, null kept."""
    c = _c(c)
    return F.when(c, F.lit(true_label)).when(~c, F.lit(false_label))


def effect_size_words(value, cuts=EFFECT_D_CUTS, use_abs: bool = True) -> Column:
    """SCL30: wording for Cohen's d (|d|) or eta squared."""
    v = F.abs(_c(value)) if use_abs else _c(value)
    w = EFFECT_WORDS
    return (F.when(v < cuts[0], w[0]).when(v < cuts[1], w[1])
            .when(v < cuts[2], w[2]).otherwise(w[3]))


def one_hot(df, col: str, levels: list[str], prefix: str | None = None, drop_first: bool = True):
    """SCL31: integer dummy columns per sorted level, the first dropped.

    ``levels`` are the distinct values (a small, checked list from the
    caller); they are sorted here as pandas does."""
    levels = sorted(levels)
    if drop_first:
        levels = levels[1:]
    p = prefix or col
    return df.select("*", *[(F.col(col) == lv).cast("int").alias(f"{p}_{lv}") for lv in levels])
