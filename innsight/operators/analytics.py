"""Market analytics over Gold: distributions, segments, time series, host
concentration and geography (AGG7-AGG27, WIN2-WIN6, SRT3-SRT5, GEO3-GEO8,
JOI9, FLT5-FLT10, JOB6-JOB13).

Rules followed throughout:
* grouped medians/quantiles use the skew-safe exact operator (``ranking``);
* windows without a partition key only run over small *aggregated* tables
  (months, weeks, segments, distinct listing counts), never over raw rows;
* scalars a later step needs (ranges, quartiles) are one-row aggregates
  joined on a constant key (a one-row broadcast has a proven size).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import derived as D
from ..functions import geo as GEO
from .ranking import exact_quantiles, grouped_median, running_sums


def _one(df: DataFrame) -> DataFrame:
    return df.withColumn("_one", F.lit(1))


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a one-row frame to every row (equi-join on a
    constant; the one-row side is broadcast -- its size is fixed)."""
    return _one(df).join(F.broadcast(_one(one_row)), "_one").drop("_one")


# ---------------------------------------------------------------- shares
def value_shares(df: DataFrame, col: str, name: str = "listing_count", pct: str = "share_pct") -> DataFrame:
    """AGG10 / WIN6: count and share of each non-null value."""
    c = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))
    tot = c.agg(F.sum(name).alias("_tot"))
    return attach_row(c, tot).select(col, name, (F.col(name) * 100.0 / F.col("_tot")).alias(pct))


def share_meeting(df: DataFrame, col: str, threshold: float, out: str = "share_pct") -> DataFrame:
    """AGG13: % of non-null values >= threshold, and % null."""
    c = F.col(col)
    return df.agg((F.avg(F.when(c.isNotNull(), (c >= threshold).cast("double"))) * 100).alias(out),
                  (F.avg(c.isNull().cast("double")) * 100).alias("null_pct"))


def segment_counts(df: DataFrame, label_col: str, labels: list[str], name: str = "listing_count") -> DataFrame:
    """AGG16: counts and shares in a fixed label order; missing label -> 0.
    The label spine is a literal list of the (few) segment names."""
    spark = df.sparkSession
    spine = spark.createDataFrame([(lab, i) for i, lab in enumerate(labels)], f"{label_col} string, segment_order int")
    c = df.where(F.col(label_col).isNotNull()).groupBy(label_col).agg(F.count(F.lit(1)).alias(name))
    j = spine.join(c, label_col, "left").withColumn(name, F.coalesce(F.col(name), F.lit(0)).cast("long"))
    tot = c.agg(F.sum(name).alias("_tot"))
    return attach_row(j, tot).select(label_col, "segment_order", name,
                                     F.coalesce(F.col(name) * 100.0 / F.col("_tot"), F.lit(0.0)).alias("share_pct"))


def top_k_counts(df: DataFrame, col: str, k: int, name: str = "listing_count") -> DataFrame:
    """SRT4: k most frequent values (value as tie-break)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias(name))
            .orderBy(F.col(name).desc(), F.col(col).asc()).limit(k))


# ---------------------------------------------------------------- group stats
def group_stats(df: DataFrame, value: str, by: list[str], prefix: str = "") -> DataFrame:
    """AGG8: median (exact), mean and count per group (null keys dropped, as
    pandas groupby does)."""
    src = df.where(F.col(value).isNotNull())
    for b in by:
        src = src.where(F.col(b).isNotNull())
    base = src.groupBy(*by).agg(F.avg(value).alias(f"{prefix}mean"), F.count(value).alias(f"{prefix}count"))
    med = grouped_median(src, value, by, name=f"{prefix}median")
    return base.join(med, by, "left")


def box_stats(df: DataFrame, value: str, by: list[str]) -> DataFrame:
    """AGG18: Q1, median, Q3, whiskers (last points within 1.5 IQR) and
    outlier count per group."""
    src = df.where(F.col(value).isNotNull())
    for b in by:
        src = src.where(F.col(b).isNotNull())
    q = exact_quantiles(src, value, [0.25, 0.5, 0.75], by, names=["q1", "median", "q3"])
    q = (q.withColumn("_lo", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")))
          .withColumn("_hi", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))))
    v = F.col(value)
    inside = (v >= F.col("_lo")) & (v <= F.col("_hi"))
    # equal values of a group are one row before its quartiles are joined
    j = src.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_w")).join(q, by)
    agg = j.groupBy(*by).agg(F.sum("_w").alias("n"), F.min(F.when(inside, v)).alias("whisker_low"),
                             F.max(F.when(inside, v)).alias("whisker_high"),
                             F.sum(F.when(inside, 0).otherwise(F.col("_w"))).alias("outliers"))
    return q.drop("_lo", "_hi").join(agg, by)


def order_by_median(df: DataFrame, value: str, by: str, descending: bool = True) -> DataFrame:
    """AGG19: groups with their position when ordered by median (name as
    tie-break); the window runs over the small per-group result."""
    med = grouped_median(df.where(F.col(by).isNotNull()), value, [by])
    o = F.col("median").desc_nulls_last() if descending else F.col("median").asc_nulls_last()
    return med.withColumn("position", F.row_number().over(Window.orderBy(o, F.col(by))))


def head_tail(df: DataFrame, col: str, key: str, k: int = 10) -> DataFrame:
    """SRT3: top k and bottom k rows by ``col`` with a label."""
    top = df.orderBy(F.col(col).desc_nulls_last(), F.col(key)).limit(k).withColumn("end", F.lit("top"))
    bottom = df.orderBy(F.col(col).asc_nulls_last(), F.col(key)).limit(k).withColumn("end", F.lit("bottom"))
    return top.unionByName(bottom)


def histogram(df: DataFrame, col: str, bins: int, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """AGG17: equal-width bins over [lo, hi] (default: data range), last bin
    closed on the right; every bin present (count 0 when empty)."""
    v = F.col(col)
    src = df.where(v.isNotNull())
    rng = src.agg(F.min(v).alias("_lo"), F.max(v).alias("_hi"))
    if lo is not None:
        rng = rng.withColumn("_lo", F.lit(float(lo)))
    if hi is not None:
        rng = rng.withColumn("_hi", F.lit(float(hi)))
    rng = rng.withColumn("_w", (F.col("_hi") - F.col("_lo")) / bins)
    j = attach_row(src, rng).where((v >= F.col("_lo")) & (v <= F.col("_hi")))
    b = F.least(F.floor(F.when(F.col("_w") > 0, (v - F.col("_lo")) / F.col("_w")).otherwise(F.lit(0))),
                F.lit(bins - 1)).cast("int")
    counts = j.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    spine = rng.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "_lo", "_w")
    return (spine.join(counts, "bin", "left")
            .select("bin", (F.col("_lo") + F.col("bin") * F.col("_w")).alias("bin_start"),
                    (F.col("_lo") + (F.col("bin") + 1) * F.col("_w")).alias("bin_end"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("long").alias("count")))


def ecdf(df: DataFrame, col: str) -> DataFrame:
    """WIN5: empirical CDF at each distinct value (running count / n), via
    the bucketed running sums (no one-partition window over raw rows)."""
    src = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    cum = running_sums(src, col, ["n"])
    tot = src.agg(F.sum("n").alias("_tot"))
    return attach_row(cum, tot).select(col, "n", (F.col("cum_n") / F.col("_tot")).alias("ecdf"))


# ---------------------------------------------------------------- time
def monthly_counts(df: DataFrame, date_col: str, out: str = "count") -> DataFrame:
    """AGG20: count per month labelled by month end, every month between the
    first and last present (empty -> 0)."""
    d = F.col(date_col)
    src = df.where(d.isNotNull())
    c = src.groupBy(F.last_day(d).alias("month_end")).agg(F.count(F.lit(1)).alias(out))
    rng = src.agg(F.min(F.trunc(d, "month")).alias("_a"), F.max(F.trunc(d, "month")).alias("_b"))
    spine = rng.select(F.explode(F.sequence("_a", "_b", F.expr("interval 1 month"))).alias("_m")).select(
        F.last_day("_m").alias("month_end"))
    return spine.join(c, "month_end", "left").select("month_end", F.coalesce(F.col(out), F.lit(0)).cast("long").alias(out))


def centered_moving_average(df: DataFrame, order_col: str, value: str, window: int = 6,
                            out: str = "moving_avg") -> DataFrame:
    """WIN2: centred rolling mean, full windows only (pandas center=True puts
    an even window at [i - w/2, i + w/2 - 1]).  Runs on an aggregated series."""
    before = window // 2
    after = window - before - 1
    w = Window.orderBy(order_col).rowsBetween(-before, after)
    return df.withColumn(out, F.when(F.count(value).over(w) == window, F.avg(value).over(w)))


def period_comparison(monthly: DataFrame, value: str, before_end: str = "2020-03-01", during_end: str = "2021-06-01",
                      label_col: str = "month_end") -> DataFrame:
    """AGG25: mean level before / during / after a disruption window (month-end
    labels: before < before_end, during <= during_end); the drop during it and
    the level recovered to, as % of the level before (null if that is 0)."""
    m = F.col(label_col)
    b = F.to_date(F.lit(before_end))
    e = F.to_date(F.lit(during_end))
    r = monthly.agg(F.avg(F.when(m < b, F.col(value))).alias("mean_before"),
                    F.avg(F.when((m >= b) & (m <= e), F.col(value))).alias("mean_during"),
                    F.avg(F.when(m > e, F.col(value))).alias("mean_after"))
    level = lambda c: F.try_divide(F.col(c), F.col("mean_before")) * 100.0
    return r.withColumn("drop_pct", 100.0 - level("mean_during")).withColumn("recovery_pct", level("mean_after"))


def month_of_year_profile(df: DataFrame, date_col: str, since_year: int = 2022) -> DataFrame:
    """AGG22: count per calendar month from ``since_year`` on, with peak,
    trough (the earlier month of equals) and swing %."""
    c = (df.where(F.year(date_col) >= since_year).groupBy(F.month(date_col).alias("month"))
         .agg(F.count(F.lit(1)).alias("count")))
    ext = c.agg(F.max_by("month", F.struct("count", -F.col("month"))).alias("peak_month"), F.max("count").alias("peak_count"),
                F.min_by("month", F.struct("count", "month")).alias("trough_month"), F.min("count").alias("trough_count"))
    ext = ext.withColumn("swing_pct", (F.col("peak_count") - F.col("trough_count")) * 100.0 / F.col("trough_count"))
    return attach_row(c.withColumn("month_name", D.month_short_name("month")), ext)


def weekly_mean(df: DataFrame, date_col: str, value: F.Column, out: str = "weekly_mean") -> DataFrame:
    """AGG21: mean per week ending Sunday (pandas 'W'), empty weeks kept as
    null between the first and last week."""
    d = F.col(date_col)
    src = df.where(d.isNotNull()).select(F.date_add(F.date_trunc("week", d).cast("date"), 6).alias("week_end"),
                                         value.alias("_v"))
    m = src.groupBy("week_end").agg(F.avg("_v").alias(out))
    rng = src.agg(F.min("week_end").alias("_a"), F.max("week_end").alias("_b"))
    spine = rng.select(F.explode(F.sequence("_a", "_b", F.expr("interval 7 days"))).alias("week_end"))
    return spine.join(m, "week_end", "left")


# ---------------------------------------------------------------- hosts
def listings_per_host(df: DataFrame, host: str = "host_id") -> DataFrame:
    return df.where(F.col(host).isNotNull()).groupBy(host).agg(F.count(F.lit(1)).alias("listing_count"))


def host_segments(df: DataFrame) -> DataFrame:
    """AGG15: hosts by listings-per-host bucket: hosts, listings, % of each."""
    per = listings_per_host(df)
    lab, order = D.right_closed_bucket("listing_count", D.HOST_LISTING_BINS, D.HOST_LISTING_LABELS)
    seg = (per.select(lab.alias("segment"), order.alias("segment_order"), "listing_count")
           .groupBy("segment", "segment_order")
           .agg(F.count(F.lit(1)).alias("hosts"), F.sum("listing_count").alias("listings")))
    tot = per.agg(F.count(F.lit(1)).alias("_h"), F.sum("listing_count").alias("_l"))
    return attach_row(seg, tot).select("segment", "segment_order", "hosts", "listings",
                                       (F.col("hosts") * 100.0 / F.col("_h")).alias("pct_hosts"),
                                       (F.col("listings") * 100.0 / F.col("_l")).alias("pct_listings"))


def lorenz_gini(df: DataFrame) -> DataFrame:
    """WIN3 + WIN4: Gini by the trapezoid rule over linspace(0, 1, n) (the
    curve starts at the first host, not at 0) and the listing share of the
    top 20 % / 10 % of hosts at positions int(0.8 n), int(0.9 n).

    Works on the histogram k -> m_k (hosts with k listings): running sums over
    distinct k, closed forms inside each tie run."""
    per = listings_per_host(df)
    hist = per.groupBy(F.col("listing_count").alias("k")).agg(F.count(F.lit(1)).alias("m"))
    hist = hist.withColumn("km", F.col("k") * F.col("m"))
    cum = running_sums(hist, "k", ["m", "km"])  # inclusive running hosts and listings
    tot = hist.agg(F.sum("m").alias("n"), F.sum("km").alias("T"), F.min("k").alias("k_min"))
    t = attach_row(cum, tot).withColumn("h0", F.col("cum_m") - F.col("m")).withColumn(
        "s0", F.col("cum_km") - F.col("km"))
    # sum over the run of cumulative listings: m*s0 + k*m(m+1)/2, in doubles (the products leave the range of a long)
    m = F.col("m").cast("double")
    run_sum = m * F.col("s0") + F.col("k") * m * (m + 1) / 2.0
    idx80 = F.floor(F.col("n") * 0.8).cast("long") + 1  # 1-based position of int(0.8 n)
    idx90 = F.floor(F.col("n") * 0.9).cast("long") + 1
    at = lambda i: F.when((i > F.col("h0")) & (i <= F.col("cum_m")), F.col("s0") + (i - F.col("h0")) * F.col("k"))
    g = t.agg(F.first("n").alias("n"), F.first("T").alias("T"), F.first("k_min").alias("k_min"),
              F.sum(run_sum).alias("sum_cum"), F.max(at(idx80)).alias("cum80"), F.max(at(idx90)).alias("cum90"))
    sum_l = F.col("sum_cum") / F.col("T")
    trap = (sum_l - (F.col("k_min") / F.col("T") + 1.0) / 2.0) / (F.col("n") - 1)
    return g.select(F.col("n").alias("hosts"), F.col("T").alias("listings"),
                    F.when(F.col("n") > 1, 1 - 2 * trap).alias("gini"),
                    ((1 - F.col("cum80") / F.col("T")) * 100).alias("pct_listings_top20"),
                    ((1 - F.col("cum90") / F.col("T")) * 100).alias("pct_listings_top10"))


def host_type_shares(df: DataFrame, col: str = "calculated_host_listings_count") -> DataFrame:
    """SCL27 + AGG16: listings per host type in the fixed order."""
    return segment_counts(df.withColumn("host_type", D.host_type(col)), "host_type", D.HOST_TYPE_LABELS)


# ---------------------------------------------------------------- geography
def hexbin_median(df: DataFrame, x: str, y: str, value: str, gridsize: int = 60, mincnt: int = 3) -> DataFrame:
    """GEO3: hexagon cells over the data extent; median value and count per
    cell with at least ``mincnt`` points."""
    src = df.where(F.col(x).isNotNull() & F.col(y).isNotNull() & F.col(value).isNotNull())
    ext = src.agg(F.min(x).alias("_x0"), F.max(x).alias("_x1"), F.min(y).alias("_y0"), F.max(y).alias("_y1"))
    j = attach_row(src, ext)
    cell = GEO.hex_cell(F.col(x), F.col(y), F.col("_x0"), F.col("_x1"), F.col("_y0"), F.col("_y1"), gridsize)
    c = j.withColumn("cell", cell)
    n = c.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    med = grouped_median(c, value, ["cell"], name="median_value")
    return n.join(med, "cell").where(F.col("n") >= mincnt)


def grid_counts(df: DataFrame, lat: str, lon: str, size_deg: float, by: list[str] | None = None) -> DataFrame:
    """GEO4 / GEO6: point density on a square grid (optionally per group)."""
    by = by or []
    cy, cx = GEO.square_cell(lat, lon, size_deg)
    return (df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
            .groupBy(*by, cy.alias("cell_lat"), cx.alias("cell_lon")).agg(F.count(F.lit(1)).alias("n")))


def grid_mean(df: DataFrame, lat: str, lon: str, value: str, size_deg: float) -> DataFrame:
    """GEO5: mean value per grid cell, summed in whole hundredths so that it
    does not hang on the order of the rows."""
    cy, cx = GEO.square_cell(lat, lon, size_deg)
    return (df.where(F.col(value).isNotNull()).groupBy(cy.alias("cell_lat"), cx.alias("cell_lon"))
            .agg((F.sum(F.round(F.col(value) * 100).cast("long")) / (F.count(F.lit(1)) * 100)).alias("mean_value"), F.count(F.lit(1)).alias("n")))


def distance_price_trend(df: DataFrame, lat: str, lon: str, price: str) -> DataFrame:
    """GEO8 / STA19: correlation of distance to centre with price and the
    least-squares line (slope, intercept)."""
    d = GEO.flat_distance_km(lat, lon)
    src = df.select(d.alias("dist"), F.col(price).alias("p")).where(F.col("dist").isNotNull() & F.col("p").isNotNull())
    return src.agg(F.corr("dist", "p").alias("r"), F.regr_slope("p", "dist").alias("slope"),
                   F.regr_intercept("p", "dist").alias("intercept"), F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- misc
def outer_align(a: DataFrame, b: DataFrame, key: str, a_col: str, b_col: str) -> DataFrame:
    """JOI9: full outer join of two share tables, missing -> 0."""
    return (a.select(key, F.col(a_col).alias("a")).join(b.select(key, F.col(b_col).alias("b")), key, "full_outer")
            .select(key, F.coalesce("a", F.lit(0.0)).alias(a_col), F.coalesce("b", F.lit(0.0)).alias(b_col)))


def complete_cases(df: DataFrame, cols: list[str]) -> DataFrame:
    """FLT5."""
    return df.dropna(subset=cols)


def in_key_set(df: DataFrame, keys: DataFrame, col: str) -> DataFrame:
    """FLT6: membership in a computed key set (left_semi; AQE broadcasts a
    small key set)."""
    return df.join(keys.select(col).distinct(), col, "left_semi")
