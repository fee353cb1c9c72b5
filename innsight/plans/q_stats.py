"""Registered queries: statistics (STA1-STA22).

Hypotheses on the fixture (roles as in ``sources/fixtures``):
H1 price, room type '1-URGENT' vs '2-HIGH' (the reference: entire home vs
private room); H2 rating, superhost vs not (whole Gold); H3 price, more than
10 reviews vs 10 or fewer; H4 price across neighbourhoods with n >= 20.
Statistic, df and effect columns have DuckDB oracles; p-values, critical
values and model fits are checked by unit tests (DuckDB has no t/F tails).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleaning as C
from ..functions import derived as D
from ..operators import pairwise, smoothing
from ..operators import stats as S
from . import oracle as O
from .registry import register

H1 = ("price_capped", "room_type", "1-URGENT", "2-HIGH")
# The features of the correlations and the regression, the room levels.
CORR_FEATURES = ["price_capped", "accommodates", "bedrooms", "bathrooms_final", "minimum_nights", "availability_365",
                 "number_of_reviews", "review_scores_rating", "amenities_count", "host_tenure_years",
                 "calculated_host_listings_count"]
OLS_X = ["accommodates", "bedrooms", "bathrooms_final", "review_scores_rating", "amenities_count"]
ROOM_LEVELS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def _h1(lk):
    return S.welch_test(lk.eda, "price_capped", F.col("room_type"), "1-URGENT", "2-HIGH")


def _h2(lk):
    g = lk.gold.where(F.col("host_is_superhost").isNotNull() & F.col("review_scores_rating").isNotNull())
    return S.welch_test(g, "review_scores_rating", F.col("host_is_superhost").cast("string"), "true", "false")


def _h3_group():
    return D.two_way_label("number_of_reviews", 10, "More than 10 reviews", "10 or fewer reviews")


def _h3(lk):
    return S.welch_test(lk.eda, "price_capped", _h3_group(), "More than 10 reviews", "10 or fewer reviews")


_H3_SQL = "CASE WHEN number_of_reviews > 10 THEN 'More than 10 reviews' ELSE '10 or fewer reviews' END"
_H2_SRC = "(SELECT * FROM gold WHERE host_is_superhost IS NOT NULL AND review_scores_rating IS NOT NULL) h2"


def _moments_sql(src, value, gexpr, a, b):
    return (f"SELECT count(*) FILTER (WHERE g = {a}) AS n1, avg(v) FILTER (WHERE g = {a}) AS mean1, "
            f"var_samp(v) FILTER (WHERE g = {a}) AS var1, count(*) FILTER (WHERE g = {b}) AS n2, "
            f"avg(v) FILTER (WHERE g = {b}) AS mean2, var_samp(v) FILTER (WHERE g = {b}) AS var2 "
            f"FROM (SELECT {gexpr} AS g, CAST({value} AS DOUBLE) AS v FROM {src}) x "
            f"WHERE v IS NOT NULL AND g IN ({a}, {b})")


def _welch_sql(src, value, gexpr, a, b):
    return (f"SELECT *, (mean1 - mean2) / sqrt(var1 / n1 + var2 / n2) AS t_stat, "
            f"pow(var1 / n1 + var2 / n2, 2) / (pow(var1 / n1, 2) / (n1 - 1) + pow(var2 / n2, 2) / (n2 - 1)) AS welch_df, "
            f"(mean1 - mean2) / sqrt((var1 + var2) / 2) AS cohens_d FROM ({_moments_sql(src, value, gexpr, a, b)}) m")


_WELCH_DOUBLES = ["mean1", "var1", "mean2", "var2", "t_stat", "welch_df", "cohens_d"]
_H1_SQL = _welch_sql("eda", "price_capped", "room_type", "'1-URGENT'", "'2-HIGH'")
_H2_SQL = _welch_sql(_H2_SRC, "review_scores_rating", "CAST(host_is_superhost AS VARCHAR)", "'true'", "'false'")
_H3_SQL_FULL = _welch_sql("eda", "price_capped", _H3_SQL, "'More than 10 reviews'", "'10 or fewer reviews'")


@register("sta1_welch_h1", O.rounded(_H1_SQL, _WELCH_DOUBLES))
def sta1_welch_h1(lk):
    """STA1 + STA5 (H1): Welch t, df and Cohen's d."""
    return _h1(lk).drop("p_value")


@register("sta1_welch_h2", O.rounded(_H2_SQL, _WELCH_DOUBLES))
def sta1_welch_h2(lk):
    """STA1 + STA5 (H2): superhost vs not, review score."""
    return _h2(lk).drop("p_value")


@register("sta1_welch_h3", O.rounded(_H3_SQL_FULL, _WELCH_DOUBLES))
def sta1_welch_h3(lk):
    """STA1 + STA5 (H3, SCL28 grouping)."""
    return _h3(lk).drop("p_value")


def _mw_sql(src, value, gexpr, a, b):
    x = f"(SELECT {gexpr} AS g, CAST({value} AS DOUBLE) AS v FROM {src}) x0 WHERE v IS NOT NULL AND g IN ({a}, {b})"
    return f"""
SELECT CAST(n1 AS BIGINT) AS n1, CAST(n2 AS BIGINT) AS n2, u_stat,
       (greatest(u_stat, n1 * n2 - u_stat) - n1 * n2 / 2.0 - 0.5)
         / sqrt(n1 * n2 / 12.0 * ((n1 + n2 + 1) - ties / ((n1 + n2) * (n1 + n2 - 1)))) AS z
FROM (SELECT n1, n2, r1 - n1 * (n1 + 1) / 2.0 AS u_stat, ties FROM (
        SELECT count(*) FILTER (WHERE g = {a}) AS n1, count(*) FILTER (WHERE g = {b}) AS n2,
               sum(rk) FILTER (WHERE g = {a}) AS r1,
               (SELECT sum(pow(CAST(t AS DOUBLE), 3) - t) FROM (SELECT count(*) AS t FROM {x} GROUP BY v) tt) AS ties
        FROM (SELECT g, v, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS rk
              FROM {x}) r) s) u"""


@register("sta4_mann_whitney_h1", O.rounded(_mw_sql("eda", "price_capped", "room_type", "'1-URGENT'", "'2-HIGH'"),
                                            ["u_stat", "z"]))
def sta4_mann_whitney_h1(lk):
    """STA4 + WIN7 (H1): U of the first group and z."""
    return S.mann_whitney(lk.eda, "price_capped", F.col("room_type"), "1-URGENT", "2-HIGH").drop("p_value")


@register("sta4_mann_whitney_h2", O.rounded(_mw_sql(_H2_SRC, "review_scores_rating",
                                                    "CAST(host_is_superhost AS VARCHAR)", "'true'", "'false'"),
                                            ["u_stat", "z"]))
def sta4_mann_whitney_h2(lk):
    """STA4 (H2)."""
    g = lk.gold.where(F.col("host_is_superhost").isNotNull() & F.col("review_scores_rating").isNotNull())
    return S.mann_whitney(g, "review_scores_rating", F.col("host_is_superhost").cast("string"), "true",
                          "false").drop("p_value")


def _anova_sql(src):
    """ANOVA over a subquery with columns g, v."""
    return f"""
SELECT ssb, ssw, k, df_between, df_within, (ssb / df_between) / (ssw / df_within) AS f_stat,
       ssb / (ssb + ssw) AS eta_squared
FROM (SELECT sum(n * pow(mean - grand, 2)) AS ssb, sum((n - 1) * coalesce(var, 0.0)) AS ssw, count(*) AS k,
             CAST(count(*) - 1 AS BIGINT) AS df_between, CAST(sum(n) - count(*) AS BIGINT) AS df_within
      FROM (SELECT n, mean, var, sum(n * mean) OVER () / sum(n) OVER () AS grand
            FROM (SELECT g, count(*) AS n, avg(v) AS mean, var_samp(v) AS var FROM {src} GROUP BY g) gm) j) s"""


_H4_SRC = ("(SELECT neighbourhood_cleansed AS g, price_capped AS v FROM eda WHERE price_capped IS NOT NULL "
           "AND neighbourhood_cleansed IN (SELECT neighbourhood_cleansed FROM eda WHERE price_capped IS NOT NULL "
           "AND neighbourhood_cleansed IS NOT NULL GROUP BY 1 HAVING count(*) >= 20)) h4")


@register("sta6_anova_h4", O.rounded(
    f"SELECT k, df_between, df_within, f_stat, eta_squared FROM ({_anova_sql(_H4_SRC)}) a", ["f_stat", "eta_squared"]))
def sta6_anova_h4(lk):
    """STA6 + STA7 (H4): one-way ANOVA over neighbourhoods with n >= 20
    (scale-free columns; the sums of squares are in the report)."""
    return S.anova(lk.eda, "price_capped", "neighbourhood_cleansed", min_n=20).drop("p_value", "ssb", "ssw")


_LEVENE_SRC = (f"(SELECT h4.g, abs(h4.v - m.med) AS v FROM {_H4_SRC} JOIN (SELECT g, quantile_cont(v, 0.5) AS med "
               f"FROM {_H4_SRC.replace(') h4', ') h4b')} GROUP BY g) m ON m.g = h4.g) lev")


@register("sta2_levene_h4", O.rounded(
    f"SELECT f_stat AS levene_stat, df_between, df_within FROM ({_anova_sql(_LEVENE_SRC)}) a", ["levene_stat"]))
def sta2_levene_h4(lk):
    """STA2 (H4): Levene's test with median centre, k groups."""
    return S.levene(lk.eda, "price_capped", "neighbourhood_cleansed", min_n=20).drop("levene_p")


@register("sta2_levene_h1", O.rounded(
    "SELECT f_stat AS levene_stat, df_between, df_within FROM (" + _anova_sql(
        "(SELECT x.g, abs(x.v - m.med) AS v FROM (SELECT room_type AS g, price_capped AS v FROM eda "
        "WHERE price_capped IS NOT NULL AND room_type IN ('1-URGENT', '2-HIGH')) x JOIN (SELECT room_type AS g, "
        "quantile_cont(price_capped, 0.5) AS med FROM eda WHERE price_capped IS NOT NULL AND room_type IN "
        "('1-URGENT', '2-HIGH') GROUP BY 1) m ON m.g = x.g) lev") + ") a", ["levene_stat"]))
def sta2_levene_h1(lk):
    """STA2 (H1): two-group Levene."""
    src = lk.eda.where(F.col("room_type").isin("1-URGENT", "2-HIGH"))
    return S.levene(src, "price_capped", "room_type").drop("levene_p")


def _levene_sql(src, value, gexpr):
    """Two-way Levene: ANOVA of the distances from the group medians."""
    x = f"(SELECT {gexpr} AS g, CAST({value} AS DOUBLE) AS v FROM {src}) x0 WHERE v IS NOT NULL AND g IS NOT NULL"
    lev = (f"(SELECT x.g, abs(x.v - m.med) AS v FROM (SELECT * FROM {x}) x "
           f"JOIN (SELECT g, quantile_cont(v, 0.5) AS med FROM {x} GROUP BY g) m ON m.g = x.g) lev")
    return O.rounded(f"SELECT f_stat AS levene_stat, df_between, df_within FROM ({_anova_sql(lev)}) a", ["levene_stat"])


def _normality_sql(src, value, gexpr, name):
    x = f"(SELECT {gexpr} AS g, CAST({value} AS DOUBLE) AS v FROM {src}) x0 WHERE v IS NOT NULL AND g IS NOT NULL"
    return O.rounded(f"""
SELECT g AS {name}, n, skewness, excess_kurtosis, n / 6.0 * (pow(skewness, 2) + pow(excess_kurtosis, 2) / 4.0) AS jarque_bera,
       exp(-(n / 6.0 * (pow(skewness, 2) + pow(excess_kurtosis, 2) / 4.0)) / 2) AS jb_p_value
FROM (SELECT g, n, m3 / pow(m2, 1.5) AS skewness, m4 / pow(m2, 2) - 3 AS excess_kurtosis
      FROM (SELECT g, count(*) AS n, avg(pow(v - m, 2)) AS m2, avg(pow(v - m, 3)) AS m3, avg(pow(v - m, 4)) AS m4
            FROM (SELECT g, v, avg(v) OVER (PARTITION BY g) AS m FROM {x}) y GROUP BY g) a) b""",
                     ["skewness", "excess_kurtosis", "jarque_bera", "jb_p_value"])


def _h2_frame(lk):
    return lk.gold.where(F.col("host_is_superhost").isNotNull() & F.col("review_scores_rating").isNotNull()).select(
        F.col("host_is_superhost").cast("string").alias("superhost"), F.col("review_scores_rating").cast("double").alias("review_scores_rating"))


def _h3_frame(lk):
    return lk.eda.select(_h3_group().alias("review_group"), F.col("price_capped").cast("double").alias("price_capped"))


@register("sta2_levene_h2", _levene_sql(_H2_SRC, "review_scores_rating", "CAST(host_is_superhost AS VARCHAR)"))
def sta2_levene_h2(lk):
    """STA2 (H2): review score by superhost."""
    return S.levene(_h2_frame(lk), "review_scores_rating", "superhost").drop("levene_p")


@register("sta2_levene_h3", _levene_sql("eda", "price_capped", _H3_SQL))
def sta2_levene_h3(lk):
    """STA2 (H3): price by the number of reviews."""
    return S.levene(_h3_frame(lk), "price_capped", "review_group").drop("levene_p")


@register("sta3_normality_h2", _normality_sql(_H2_SRC, "review_scores_rating", "CAST(host_is_superhost AS VARCHAR)", "superhost"))
def sta3_normality_h2(lk):
    """STA3 (re-aimed, H2): review score by superhost."""
    return S.normality_moments(_h2_frame(lk), "review_scores_rating", "superhost")


@register("sta3_normality_h3", _normality_sql("eda", "price_capped", _H3_SQL, "review_group"))
def sta3_normality_h3(lk):
    """STA3 (re-aimed, H3): price by the number of reviews."""
    return S.normality_moments(_h3_frame(lk), "price_capped", "review_group")


@register("sta4_mann_whitney_h3", O.rounded(_mw_sql("eda", "price_capped", _H3_SQL, "'More than 10 reviews'", "'10 or fewer reviews'"),
                                            ["u_stat", "z"]))
def sta4_mann_whitney_h3(lk):
    """STA4 (H3)."""
    return S.mann_whitney(_h3_frame(lk), "price_capped", F.col("review_group"), "More than 10 reviews", "10 or fewer reviews").drop("p_value")


@register("sta3_normality_by_room_type", O.rounded("""
SELECT g AS room_type, n, skewness, excess_kurtosis, n / 6.0 * (pow(skewness, 2) + pow(excess_kurtosis, 2) / 4.0)
       AS jarque_bera, exp(-(n / 6.0 * (pow(skewness, 2) + pow(excess_kurtosis, 2) / 4.0)) / 2) AS jb_p_value
FROM (SELECT g, n, m3 / pow(m2, 1.5) AS skewness, m4 / pow(m2, 2) - 3 AS excess_kurtosis
      FROM (SELECT x.g, count(*) AS n, avg(pow(v - m, 2)) AS m2, avg(pow(v - m, 3)) AS m3, avg(pow(v - m, 4)) AS m4
            FROM (SELECT room_type AS g, price_capped AS v FROM eda WHERE price_capped IS NOT NULL AND room_type IS NOT NULL) x
            JOIN (SELECT room_type AS g, avg(price_capped) AS m FROM eda WHERE price_capped IS NOT NULL GROUP BY 1) mm
              ON mm.g = x.g GROUP BY x.g) a) b""", ["skewness", "excess_kurtosis", "jarque_bera", "jb_p_value"]))
def sta3_normality_by_room_type(lk):
    """STA3 (re-aimed): whole-group skewness, kurtosis, Jarque-Bera."""
    return S.normality_moments(lk.eda, "price_capped", "room_type")


@register("sta9_ci_inputs", O.rounded(
    "SELECT room_type, count(*) AS n, avg(price_capped) AS mean, sqrt(var_samp(price_capped) / count(*)) AS se "
    "FROM eda WHERE price_capped IS NOT NULL AND room_type IS NOT NULL GROUP BY 1", ["mean", "se"]))
def sta9_ci_inputs(lk):
    """STA9 inputs: n, mean and standard error per room type."""
    return S.t_intervals(lk.eda, "price_capped", "room_type").select("room_type", "n", "mean", "se")


@register("sta9_t_intervals")
def sta9_t_intervals(lk):
    """STA9: 95 % t interval of the mean price per room type."""
    return S.t_intervals(lk.eda, "price_capped", "room_type")


@register("sta9_top_neighbourhood_intervals")
def sta9_top_neighbourhood_intervals(lk):
    """STA9: intervals for the 10 neighbourhoods with the most listings."""
    from ..operators.analytics import in_key_set, top_k_counts
    e = in_key_set(lk.eda, top_k_counts(lk.eda, "neighbourhood_cleansed", 10), "neighbourhood_cleansed")
    return S.t_intervals(e, "price_capped", "neighbourhood_cleansed")


_EFFECT_SQL = f"""
SELECT hypothesis, effect_size, value,
       CASE WHEN effect_size = 'Eta-squared' THEN
              CASE WHEN value < 0.01 THEN 'Negligible' WHEN value < 0.06 THEN 'Small' WHEN value < 0.14 THEN 'Medium' ELSE 'Large' END
            ELSE CASE WHEN abs(value) < 0.2 THEN 'Negligible' WHEN abs(value) < 0.5 THEN 'Small'
                      WHEN abs(value) < 0.8 THEN 'Medium' ELSE 'Large' END END AS interpretation
FROM (SELECT 'H1' AS hypothesis, 'Cohen''s d' AS effect_size, cohens_d AS value FROM ({_H1_SQL}) a
      UNION ALL SELECT 'H2', 'Cohen''s d', cohens_d FROM ({_H2_SQL}) b
      UNION ALL SELECT 'H3', 'Cohen''s d', cohens_d FROM ({_H3_SQL_FULL}) c
      UNION ALL SELECT 'H4', 'Eta-squared', eta_squared FROM ({_anova_sql(_H4_SRC)}) d) u"""


@register("sta10_effect_sizes", O.rounded(_EFFECT_SQL, ["value"]))
def sta10_effect_sizes(lk):
    """STA10 + SCL30: effect sizes of H1-H4 with wording."""
    return S.effect_size_rows([("H1", _h1(lk)), ("H2", _h2(lk)), ("H3", _h3(lk))],
                              ("H4", S.anova(lk.eda, "price_capped", "neighbourhood_cleansed", min_n=20)))


@register("sta11_pearson", O.rounded(
    "SELECT corr(least(number_of_reviews, 500), price_capped) AS r_reviews_price, "
    "corr(review_scores_rating, price_capped) AS r_rating_price, "
    "corr(number_of_reviews, review_scores_rating) AS r_reviews_rating, count(*) AS n FROM eda "
    "WHERE review_scores_rating IS NOT NULL AND price_capped IS NOT NULL AND number_of_reviews IS NOT NULL",
    ["r_reviews_price", "r_rating_price", "r_reviews_rating"]))
def sta11_pearson(lk):
    """STA11: Pearson r over complete cases; the review count is clipped
    against price, not against the rating."""
    e = _complete(lk)
    return e.agg(F.corr(_clipped(), "price_capped").alias("r_reviews_price"),
                 F.corr("review_scores_rating", "price_capped").alias("r_rating_price"),
                 F.corr("number_of_reviews", "review_scores_rating").alias("r_reviews_rating"),
                 F.count(F.lit(1)).alias("n"))


def _clipped(cap: int = 500):
    """The review count, clipped."""
    return F.least(F.col("number_of_reviews"), F.lit(cap))


def _complete(lk):
    return lk.eda.dropna(subset=["review_scores_rating", "price_capped", "number_of_reviews"])


_PAIRS = [(a, b) for i, a in enumerate(CORR_FEATURES) for b in CORR_FEATURES[i + 1:]]
_CORR_SQL = "\nUNION ALL\n".join(
    [f"SELECT '{a}' AS col_a, '{b}' AS col_b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS r FROM eda" for a, b in _PAIRS] +
    [f"SELECT '{b}', '{a}', corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) FROM eda" for a, b in _PAIRS] +
    [f"SELECT '{c}', '{c}', 1.0" for c in CORR_FEATURES])


@register("sta12_correlation_matrix", O.rounded(_CORR_SQL, ["r"]))
def sta12_correlation_matrix(lk):
    """STA12: pairwise-complete correlation matrix, long form."""
    return S.correlation_pairs(lk.eda, C.existing_columns(lk.eda, CORR_FEATURES))


_DRIVER_COLS = [c for c in CORR_FEATURES if c != "price_capped"]


@register("sta13_price_drivers", O.rounded(
    "SELECT feature, r, row_number() OVER (ORDER BY abs(r) DESC NULLS LAST, feature) AS rank_abs FROM (" +
    "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, corr(CAST({c} AS DOUBLE), price_capped) AS r FROM eda"
                         for c in _DRIVER_COLS) + ") d", ["r"]))
def sta13_price_drivers(lk):
    """STA13 + SRT5: correlation with price, ordered by |r|."""
    return S.drivers(lk.eda, "price_capped", _DRIVER_COLS).withColumn("rank_abs", F.col("rank_abs").cast("long"))


_SUB = ["review_scores_accuracy", "review_scores_cleanliness", "review_scores_checkin",
        "review_scores_communication", "review_scores_location", "review_scores_value"]


_SUB_COMPLETE = " AND ".join(f"{c} IS NOT NULL" for c in _SUB)


@register("job9_subscore_matrix", O.rounded("\nUNION ALL\n".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, " + ("1.0" if a == b else f"corr({min(a, b)}, {max(a, b)})") + f" AS r FROM gold WHERE {_SUB_COMPLETE}"
    + (" HAVING count(*) > 0" if a == b else "") for a in _SUB for b in _SUB), ["r"]))
def job9_subscore_matrix(lk):
    """JOB9 (STA12): correlation matrix of the sub-scores over rows that have
    all six, long form."""
    return S.correlation_pairs(lk.gold.dropna(subset=_SUB), _SUB)


@register("job9_subscore_drivers", O.rounded(
    "SELECT feature, r, row_number() OVER (ORDER BY abs(r) DESC NULLS LAST, feature) AS rank_abs FROM (" +
    "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, corr({c}, review_scores_rating) AS r FROM "
                         f"(SELECT * FROM gold WHERE {_SUB_COMPLETE}) s" for c in _SUB) + ") d", ["r"]))
def job9_subscore_drivers(lk):
    """JOB9 (FLT5, STA13): sub-score correlation with the overall rating."""
    e = lk.gold.dropna(subset=_SUB)
    return S.drivers(e, "review_scores_rating", _SUB).withColumn("rank_abs", F.col("rank_abs").cast("long"))


@register("job9_subscore_means", O.rounded(
    "\nUNION ALL\n".join(f"SELECT '{c}' AS score, avg({c}) AS mean FROM gold WHERE {_SUB_COMPLETE}" for c in _SUB), ["mean"]))
def job9_subscore_means(lk):
    """JOB9 (AGG9): mean of each sub-score over rows that have all six."""
    row = lk.gold.dropna(subset=_SUB).agg(*[F.avg(c).alias(c) for c in _SUB])
    arr = F.array(*[F.struct(F.lit(c).alias("score"), F.col(c).alias("mean")) for c in _SUB])
    return row.select(F.explode(arr).alias("_s")).select("_s.score", "_s.mean")


@register("sta19_reviews_price_trend", O.rounded(
    "SELECT regr_slope(price_capped, least(number_of_reviews, 500)) AS slope, regr_intercept(price_capped, least(number_of_reviews, 500)) "
    "AS intercept FROM eda WHERE review_scores_rating IS NOT NULL", ["slope", "intercept"]))
def sta19_reviews_price_trend(lk):
    """STA19: straight-line trend of price on the clipped review count over
    complete cases (polyfit degree 1)."""
    return _complete(lk).agg(F.regr_slope("price_capped", _clipped()).alias("slope"),
                             F.regr_intercept("price_capped", _clipped()).alias("intercept"))


def _reg_frame(lk):
    e = lk.eda.dropna(subset=["price_capped"] + OLS_X + ["room_type"])
    return D.one_hot(e, "room_type", ROOM_LEVELS)


def _reg_terms():
    return OLS_X + [f"room_type_{lv}" for lv in ROOM_LEVELS[1:]]


@register("sta14_ols_coefficients")
def sta14_ols_coefficients(lk):
    """STA14: OLS coefficients, std errors, t, p, 95 % interval."""
    return S.ols_coefficients(_reg_frame(lk), "price_capped", _reg_terms())


@register("sta14_ols_fit")
def sta14_ols_fit(lk):
    """STA14: R2, adjusted R2, F and p, log-likelihood, AIC, BIC,
    Durbin-Watson (id order), Jarque-Bera, condition number."""
    return S.ols_fit(_reg_frame(lk), "price_capped", _reg_terms())


def _reg_sql() -> str:
    """CTEs: ``f`` (id, y, x1..xp), ``m`` (n and means), ``w`` (the matrix of
    centred products after Gauss-Jordan steps on the predictors: their
    inverse, the slopes in the last column, SSE in the corner), ``b``
    (coefficient by position) and ``e`` (residuals)."""
    cols = [f"CAST({c} AS DOUBLE)" for c in OLS_X] + [f"CAST(room_type = '{lv}' AS INT)::DOUBLE" for lv in ROOM_LEVELS[1:]]
    p, names = len(cols), [f"x{i + 1}" for i in range(len(cols))] + ["y"]
    there = " AND ".join(f"{c} IS NOT NULL" for c in ["price_capped", "room_type", *OLS_X])
    q = p + 1
    sums = ", ".join(f"sum(({a} - m[{i + 1}]) * ({b} - m[{j + 1}]))" for i, a in enumerate(names) for j, b in enumerate(names))
    at = lambda i, j: f"a[({i} - 1) * {q} + {j}]"
    fitted = " + ".join(["b[1]"] + [f"b[{i + 2}] * x{i + 1}" for i in range(p)])
    return f"""WITH RECURSIVE f AS (SELECT id, {", ".join(f"{c} AS {n}" for c, n in zip(cols, names))}, CAST(price_capped AS DOUBLE) AS y FROM eda WHERE {there}),
m AS (SELECT count(*)::DOUBLE AS n, [{", ".join(f"avg({n})" for n in names)}] AS m FROM f),
w AS (SELECT 1 AS k, [{sums}] AS a FROM f, m
  UNION ALL SELECT k + 1, list_transform(range({q * q}), lambda t: CASE
    WHEN t // {q} + 1 = k AND t % {q} + 1 = k THEN 1 / {at("k", "k")}
    WHEN t // {q} + 1 = k THEN a[t + 1] / {at("k", "k")}
    WHEN t % {q} + 1 = k THEN -a[t + 1] / {at("k", "k")}
    ELSE a[t + 1] - {at("(t // %d + 1)" % q, "k")} * {at("k", "(t %% %d + 1)" % q)} / {at("k", "k")} END) FROM w WHERE k <= {p}),
inv AS (SELECT a, n, m, {at(q, q)} / (n - {q}) AS sigma2, list_transform(range(1, {q}), lambda i: {at("i", q)}) AS slopes FROM w, m WHERE k = {q}),
b AS (SELECT a, n, m, sigma2, list_prepend(m[{q}] - list_sum(list_transform(range(1, {q}), lambda i: m[i] * slopes[i])), slopes) AS b,
  list_prepend(1 / n + list_sum(list_transform(range({p * p}), lambda t: m[t // {p} + 1] * {at("(t // %d + 1)" % p, "(t %% %d + 1)" % p)} * m[t % {p} + 1])),
    list_transform(range(1, {q}), lambda i: {at("i", "i")})) AS unscaled FROM inv),
e AS (SELECT id, y, y - ({fitted}) AS e FROM f, b)
"""


_EST_SQL = "SELECT * FROM (" + _reg_sql() + f"""SELECT t AS term, coef, std_err, coef / std_err AS t FROM (
  SELECT unnest(['const', {", ".join(f"'{t}'" for t in _reg_terms())}]) AS t, unnest(b) AS coef, unnest(list_transform(unscaled, lambda u: sqrt(u * sigma2))) AS std_err FROM b)) z"""


@register("sta14_ols_estimates", O.rounded(_EST_SQL, ["coef", "std_err", "t"]))
def sta14_ols_estimates(lk):
    """STA14: coefficients, standard errors and t (what SQL can state)."""
    return S.ols_coefficients(_reg_frame(lk), "price_capped", _reg_terms()).select("term", "coef", "std_err", "t")


_FIGURES = ["n", "df_model", "df_resid", "r_squared", "adj_r_squared", "f_stat", "log_likelihood", "aic", "bic", "durbin_watson", "jarque_bera", "skew", "kurtosis"]
_FIGURES_SQL = "SELECT * FROM (" + _reg_sql() + f""", r AS (SELECT *, e - lag(e) OVER (ORDER BY id) AS d, avg(y) OVER () AS ybar FROM e),
g AS (SELECT count(*)::DOUBLE AS n, {len(_reg_terms())}.0 AS p, sum(e * e) AS sse, sum((y - ybar) * (y - ybar)) AS sst, sum(d * d) AS dd, avg(e * e) AS m2, avg(e * e * e) AS m3, avg(e * e * e * e) AS m4 FROM r),
h AS (SELECT *, -n / 2 * (ln(2 * pi()) + ln(sse / n) + 1) AS llf, m3 / m2 ** 1.5 AS sk, m4 / (m2 * m2) AS ku, 1 - sse / sst AS r2 FROM g)
SELECT unnest([{", ".join(f"'{f}'" for f in _FIGURES)}]) AS metric,
  unnest([n, p, n - p - 1, r2, 1 - (n - 1) / (n - p - 1) * (1 - r2), (sst - sse) / p / (sse / (n - p - 1)), llf, -2 * llf + 2 * (p + 1), -2 * llf + (p + 1) * ln(n), dd / sse,
    n / 6 * (sk * sk + (ku - 3) ** 2 / 4), sk, ku]) AS value FROM h) z"""


@register("sta14_ols_fit_figures", O.rounded(_FIGURES_SQL, ["value"]))
def sta14_ols_fit_figures(lk):
    """STA14: the fit statistics that SQL can state."""
    return S.ols_fit(_reg_frame(lk), "price_capped", _reg_terms()).where(F.col("metric").isin(_FIGURES))


@register("sta15_fitted_residuals")
def sta15_fitted_residuals(lk):
    """STA15: fitted values and residuals of the OLS model."""
    coefs = S.ols_coefficients(_reg_frame(lk), "price_capped", _reg_terms())
    return S.fitted_residuals(_reg_frame(lk), "price_capped", coefs)


@register("sta16_qq_points")
def sta16_qq_points(lk):
    """STA16: normal Q-Q points of the residuals."""
    coefs = S.ols_coefficients(_reg_frame(lk), "price_capped", _reg_terms())
    return S.qq_points(S.fitted_residuals(_reg_frame(lk), "price_capped", coefs))


@register("sta16_sample_quantiles", O.rounded(
    "SELECT * FROM (" + _reg_sql() + """SELECT unnest(list_transform(range(1, 100), lambda i: i / 100)) AS p,
  unnest(quantile_cont(e, list_transform(range(1, 100), lambda i: i / 100))) AS sample_quantile FROM e) z""", ["p", "sample_quantile"]))
def sta16_sample_quantiles(lk):
    """STA16: the residuals' side of the Q-Q points."""
    return sta16_qq_points(lk).select("p", "sample_quantile")


def _vif_sql() -> str:
    """G_ii (G^-1)_ii by Gauss-Jordan steps on the uncentred products."""
    cols = [f"CAST({c} AS DOUBLE)" for c in OLS_X] + [f"CAST(room_type = '{lv}' AS INT)::DOUBLE" for lv in ROOM_LEVELS[1:]]
    p = len(cols)
    there = " AND ".join(f"{c} IS NOT NULL" for c in ["price_capped", "room_type", *OLS_X])
    at = lambda i, j: f"a[({i} - 1) * {p} + {j}]"
    return f"""SELECT * FROM (WITH RECURSIVE g AS (SELECT [{", ".join(f"sum({a} * {b})" for a in cols for b in cols)}] AS a FROM eda WHERE {there}),
w AS (SELECT 1 AS k, a FROM g UNION ALL SELECT k + 1, list_transform(range({p * p}), lambda t: CASE
    WHEN t // {p} + 1 = k AND t % {p} + 1 = k THEN 1 / {at("k", "k")}
    WHEN t // {p} + 1 = k THEN a[t + 1] / {at("k", "k")}
    WHEN t % {p} + 1 = k THEN -a[t + 1] / {at("k", "k")}
    ELSE a[t + 1] - {at("(t // %d + 1)" % p, "k")} * {at("k", "(t %% %d + 1)" % p)} / {at("k", "k")} END) FROM w WHERE k <= {p})
SELECT unnest([{", ".join(f"'{t}'" for t in _reg_terms())}]) AS predictor, unnest(list_transform(range(1, {p + 1}), lambda i: g.a[(i - 1) * {p} + i] * w.a[(i - 1) * {p} + i])) AS vif
FROM g, w WHERE k = {p + 1}) z"""


@register("sta17_vif", O.rounded(_vif_sql(), ["vif"]))
def sta17_vif(lk):
    """STA17: VIF per predictor, uncentred (no constant), as the reference."""
    return S.vif(_reg_frame(lk), _reg_terms())


def _local_fit_sql(x: str, y: str, src: str = "eda") -> str:
    """Local lines with tricube weights over two thirds of the rows, by all pairs of distinct values."""
    return (f"WITH v AS (SELECT CAST({x} AS DOUBLE) AS x, count(*) AS n, sum({y}) AS sy FROM {src} WHERE {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY 1),\n"
            "d AS (SELECT a.x AS x0, b.x - a.x AS u, b.n AS n, b.sy AS sy, sum(b.n) OVER (PARTITION BY a.x ORDER BY abs(b.x - a.x)) AS held,\n"
            "  (SELECT sum(n) FROM v) AS total FROM v a CROSS JOIN v b),\n"
            "r AS (SELECT x0, min(abs(u)) FILTER (WHERE held >= 2e0 / 3e0 * total) AS h FROM d GROUP BY x0),\n"
            "w AS (SELECT d.x0, d.n, d.sy, CASE WHEN h > 0 THEN u / h ELSE 0 END AS u,\n"
            "  CASE WHEN h > 0 THEN pow(greatest(1 - pow(abs(u) / (h * 1.0000001), 3), 0), 3) WHEN u = 0 THEN 1 ELSE 0 END AS w FROM d JOIN r ON r.x0 = d.x0),\n"
            "s AS (SELECT x0, sum(w * n) AS sw, sum(w * n * u) AS su, sum(w * n * u * u) AS suu, sum(w * sy) AS sy, sum(w * sy * u) AS suy FROM w GROUP BY x0)\n"
            "SELECT v.x, CASE WHEN sw * suu - su * su > 1e-12 * sw * suu THEN (s.sy * suu - su * suy) / (sw * suu - su * su) ELSE s.sy / sw END AS smoothed, v.n\n"
            "FROM s JOIN v ON v.x = s.x0")


@register("sta18_binned_lowess", O.rounded(_local_fit_sql("accommodates", "price_capped"), ["x", "smoothed"]))
def sta18_binned_lowess(lk):
    """STA18 (re-aimed): local line of price on accommodates."""
    return smoothing.local_fit(lk.eda, "accommodates", "price_capped")


@register("sta18_lowess_of_score", O.rounded(_local_fit_sql("review_scores_rating", "price_capped"), ["x", "smoothed"]))
def sta18_lowess_of_score(lk):
    """STA18 (re-aimed): local line of price on the review score."""
    return smoothing.local_fit(lk.eda, "review_scores_rating", "price_capped")


@register("sta20_kde_by_host_type")
def sta20_kde_by_host_type(lk):
    """STA20: KDE of price per host type (Scott bandwidth)."""
    e = lk.eda.withColumn("host_type", D.host_type("calculated_host_listings_count"))
    return S.kde_by_group(e, "price_capped", "host_type")


@register("sta21_seeded_sample", O.rounded(
    "SELECT id, room_type, price_capped FROM eda QUALIFY row_number() OVER (PARTITION BY room_type ORDER BY md5(id || ':42'), id) <= 500",
    ["price_capped"]))
def sta21_seeded_sample(lk):
    """STA21: at most 500 rows per room type by a seeded hash order."""
    return S.seeded_sample(lk.eda.select("id", "room_type", "price_capped"), "room_type", 500)


@register("sta8_tukey_hsd")
def sta8_tukey_hsd(lk):
    """STA8: Tukey HSD over neighbourhoods with n >= 20."""
    return S.tukey_hsd(lk.eda, "price_capped", "neighbourhood_cleansed", min_n=20).drop("std_error")


@register("sta8_mean_differences", O.rounded(
    "WITH m AS (SELECT neighbourhood_cleansed AS g, count(*) AS n, avg(price_capped) AS mean, var_samp(price_capped) AS var FROM eda\n"
    "  WHERE price_capped IS NOT NULL AND neighbourhood_cleansed IS NOT NULL GROUP BY 1 HAVING count(*) >= 20),\n"
    "p AS (SELECT sum((n - 1) * coalesce(var, 0)) / (sum(n) - count(*)) AS msw FROM m)\n"
    "SELECT a.g AS group1, b.g AS group2, b.mean - a.mean AS meandiff, sqrt(msw / 2 * (1e0 / a.n + 1e0 / b.n)) AS std_error\n"
    "FROM m a JOIN m b ON a.g < b.g CROSS JOIN p", ["meandiff", "std_error"]))
def sta8_mean_differences(lk):
    """STA8: the differences of means and their standard errors, which Tukey HSD tests."""
    return S.tukey_hsd(lk.eda, "price_capped", "neighbourhood_cleansed", min_n=20).select("group1", "group2", "meandiff", "std_error")


@register("sta8_tukey_summary")
def sta8_tukey_summary(lk):
    """STA8: pairs, rejected pairs and the 10 largest rejected differences,
    without a row for every pair."""
    return pairwise.tukey_report(lk.eda, "price_capped", "neighbourhood_cleansed", min_n=20)


@register("sta22_hypothesis_report")
def sta22_hypothesis_report(lk):
    """STA22: one row per test with statistic, p, effect and verdict,
    with the checks before H1-H3 (normality of each group, equal variances)
    and the 'not testable' row (weekend price) by the calendar's prices
    (availability is asked instead, STA23)."""
    rows = []
    for name, w in (("H1 Welch t", _h1(lk)), ("H2 Welch t", _h2(lk)), ("H3 Welch t", _h3(lk))):
        rows.append(w.select(F.lit(name).alias("test"), F.col("t_stat").alias("statistic"), "p_value",
                             F.col("cohens_d").alias("effect")))
    none = F.lit(None).cast("double").alias("effect")
    h1 = lk.eda.where(F.col("room_type").isin("1-URGENT", "2-HIGH"))
    h2, h3 = _h2_frame(lk), _h3_frame(lk)
    pairs = (("H1", h1, "price_capped", "room_type", "1-URGENT", "2-HIGH"),
             ("H2", h2, "review_scores_rating", "superhost", "true", "false"),
             ("H3", h3, "price_capped", "review_group", "More than 10 reviews", "10 or fewer reviews"))
    for name, df, value, group, first, second in pairs:
        nm = S.normality_moments(df, value, group)
        rows.append(nm.select(F.concat(F.lit(f"{name} normality: "), group).alias("test"), F.col("jarque_bera").alias("statistic"),
                              F.col("jb_p_value").alias("p_value"), none))
        lv = S.levene(df, value, group)
        rows.append(lv.select(F.lit(f"{name} Levene").alias("test"), F.col("levene_stat").alias("statistic"), F.col("levene_p").alias("p_value"), none))
        mw = S.mann_whitney(df, value, F.col(group), first, second)
        rows.append(mw.select(F.lit(f"{name} Mann-Whitney U").alias("test"), F.col("u_stat").alias("statistic"), "p_value", none))
    an = S.anova(lk.eda, "price_capped", "neighbourhood_cleansed", min_n=20)
    rows.append(an.select(F.lit("H4 ANOVA F").alias("test"), F.col("f_stat").alias("statistic"), "p_value",
                          F.col("eta_squared").alias("effect")))
    lv = S.levene(lk.eda, "price_capped", "neighbourhood_cleansed", min_n=20)
    rows.append(lv.select(F.lit("H4 Levene").alias("test"), F.col("levene_stat").alias("statistic"), F.col("levene_p").alias("p_value"), none))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    out = out.withColumn("verdict", F.when(F.col("p_value") < S.ALPHA, "Reject H0").otherwise("Fail to reject H0"))
    priced = F.count_if(F.trim("price") != "")
    nt = lk.calendar_raw.agg(priced.alias("_n")).select(
        F.lit("H5 weekend vs weekday price").alias("test"), F.lit(None).cast("double").alias("statistic"),
        F.lit(None).cast("double").alias("p_value"), F.lit(None).cast("double").alias("effect"),
        F.when(F.col("_n") == 0, "Not testable: calendar has no price")
         .otherwise(F.concat(F.lit("Not tested: calendar days with a price: "), F.col("_n").cast("string"))).alias("verdict"))
    return out.unionByName(nt)
