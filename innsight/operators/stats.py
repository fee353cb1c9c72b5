"""Hypothesis tests, effect sizes, intervals and regression from distributed
sufficient statistics (STA1-STA22).

Spark reduces the data to a few rows (counts, sums, moments, products);
p-values and critical values are then computed on those rows with
``functions.dists`` -- as pandas UDFs over the small tables, or on the driver
for one-row results.  No step collects raw rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dists
from ..functions.derived import EFFECT_D_CUTS, EFFECT_ETA_CUTS, effect_size_words
from .analytics import attach_row
from ..session import materialize, ship_package
from .ranking import _small, bucketize, exact_quantiles, running_sums

ALPHA = 0.05  # fixed value: significance level


# ------------------------------------------------------------ pandas UDFs
@F.pandas_udf(T.DoubleType())
def t_pvalue_udf(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series([dists.t_sf2(a, b) if pd.notna(a) and pd.notna(b) else np.nan for a, b in zip(t, df)])


@F.pandas_udf(T.DoubleType())
def f_pvalue_udf(f: pd.Series, d1: pd.Series, d2: pd.Series) -> pd.Series:
    return pd.Series([dists.f_sf(a, b, c) if pd.notna(a) else np.nan for a, b, c in zip(f, d1, d2)])


@F.pandas_udf(T.DoubleType())
def norm_two_sided_udf(z: pd.Series) -> pd.Series:
    return pd.Series([min(1.0, math.erfc(abs(v) / math.sqrt(2))) if pd.notna(v) else np.nan for v in z])


@F.pandas_udf(T.DoubleType())
def t_crit_udf(df: pd.Series) -> pd.Series:
    cache: dict = {}
    out = []
    for v in df:
        if pd.isna(v) or v <= 0:
            out.append(np.nan)
            continue
        if v not in cache:
            cache[v] = dists.t_ppf(1 - ALPHA / 2, float(v))
        out.append(cache[v])
    return pd.Series(out)


def tukey_pvalue(q: F.Column, k: int, df: float) -> F.Column:
    """Adjusted p of studentized ranges; the range's table is laid out once, on
    the driver, and goes along (160 KB)."""
    table = dists.range_table(k)

    @F.pandas_udf(T.DoubleType())
    def tail(q: pd.Series) -> pd.Series:
        return pd.Series(dists.tukey_sf_many(q.to_numpy(float), k, df, table), index=q.index)

    return tail(q)


# ------------------------------------------------------------ two groups
def two_group_moments(df: DataFrame, value: str, group: F.Column, first, second) -> DataFrame:
    """One row: n, mean, var (sample) of ``value`` for the two labels."""
    g = df.select(group.alias("_g"), F.col(value).cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & F.col("_g").isin(first, second))
    a, b = F.col("_g") == first, F.col("_g") == second
    return g.agg(F.count(F.when(a, 1)).alias("n1"), F.avg(F.when(a, F.col("_v"))).alias("mean1"),
                 F.var_samp(F.when(a, F.col("_v"))).alias("var1"),
                 F.count(F.when(b, 1)).alias("n2"), F.avg(F.when(b, F.col("_v"))).alias("mean2"),
                 F.var_samp(F.when(b, F.col("_v"))).alias("var2"))


def welch_columns(m: DataFrame) -> DataFrame:
    """STA1 + STA5: Welch t, Welch-Satterthwaite df and Cohen's d; null where
    a group has fewer than two rows or both are constant."""
    se1, se2 = F.try_divide("var1", "n1"), F.try_divide("var2", "n2")
    diff = F.col("mean1") - F.col("mean2")
    spread = F.try_divide(F.pow(se1, 2), F.col("n1") - 1) + F.try_divide(F.pow(se2, 2), F.col("n2") - 1)
    return (m.withColumn("t_stat", F.try_divide(diff, F.sqrt(se1 + se2)))
             .withColumn("welch_df", F.try_divide(F.pow(se1 + se2, 2), spread))
             .withColumn("cohens_d", F.try_divide(diff, F.sqrt((F.col("var1") + F.col("var2")) / 2))))


def welch_test(df: DataFrame, value: str, group: F.Column, first, second) -> DataFrame:
    """STA1: statistic, df, p (two-sided), plus Cohen's d."""
    w = welch_columns(two_group_moments(df, value, group, first, second))
    return w.withColumn("p_value", t_pvalue_udf("t_stat", "welch_df"))


def mann_whitney(df: DataFrame, value: str, group: F.Column, first, second) -> DataFrame:
    """STA4 + WIN7: U of the first group, tie-corrected normal approximation
    with continuity correction (two-sided).  Ranks come from running counts
    over distinct values (ties share the mean rank).  NaN is no value; z and p
    are null where a group is empty or all values are equal."""
    g = df.select(group.alias("_g"), F.col(value).cast("double").alias("_v")).where(
        F.col("_v").isNotNull() & ~F.isnan("_v") & F.col("_g").isin(first, second))
    per = g.groupBy("_v").agg(F.count(F.when(F.col("_g") == first, 1)).alias("na"),
                              F.count(F.when(F.col("_g") == second, 1)).alias("nb"))
    per = per.withColumn("t", F.col("na") + F.col("nb"))
    cum = running_sums(per, "_v", ["t"])
    avg_rank = F.col("cum_t") - F.col("t") + (F.col("t") + 1) / 2.0
    # products of two counts leave the range of a long
    s = cum.agg(F.sum(F.col("na") * avg_rank).alias("r1"), F.sum("na").cast("double").alias("n1"), F.sum("nb").cast("double").alias("n2"),
                F.sum(F.pow(F.col("t").cast("double"), 3) - F.col("t")).alias("ties"))
    n = F.col("n1") + F.col("n2")
    u1 = F.col("r1") - F.col("n1") * (F.col("n1") + 1) / 2.0
    out = (s.withColumn("u_stat", u1)
            .withColumn("_u", F.greatest(F.col("u_stat"), F.col("n1") * F.col("n2") - F.col("u_stat")))
            .withColumn("_sigma", F.sqrt(F.col("n1") * F.col("n2") / 12.0 *
                                         ((n + 1) - F.try_divide(F.col("ties"), n * (n - 1)))))
            .withColumn("z", F.try_divide(F.col("_u") - F.col("n1") * F.col("n2") / 2.0 - 0.5, F.col("_sigma"))))
    return out.select(F.col("n1").cast("long"), F.col("n2").cast("long"), "u_stat", "z",
                      norm_two_sided_udf("z").alias("p_value"))


# ------------------------------------------------------------ k groups
def group_moments(df: DataFrame, value: str, group: str, min_n: int = 0) -> DataFrame:
    g = df.where(F.col(value).isNotNull() & F.col(group).isNotNull()).groupBy(group).agg(
        F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.var_samp(value).alias("var"))
    return g.where(F.col("n") >= min_n) if min_n else g


def anova(df: DataFrame, value: str, group: str, min_n: int = 0) -> DataFrame:
    """STA6 + STA7: one-way ANOVA from group (n, mean, var): F, df, p, eta^2;
    null with fewer than two groups or no spread within them."""
    return anova_of(group_moments(df, value, group, min_n))


def anova_of(gm: DataFrame) -> DataFrame:
    """ANOVA from a table of group summaries (n, mean, var)."""
    tot = gm.agg(F.sum("n").alias("n_total"), F.try_divide(F.sum(F.col("n") * F.col("mean")), F.sum("n")).alias("grand"),
                 F.count(F.lit(1)).alias("k"))
    j = attach_row(gm, tot)
    s = j.agg(F.sum(F.col("n") * F.pow(F.col("mean") - F.col("grand"), 2)).alias("ssb"),
              F.sum((F.col("n") - 1) * F.coalesce(F.col("var"), F.lit(0.0))).alias("ssw"),
              F.first("k").alias("k"), F.first("n_total").alias("n_total"))
    return (s.withColumn("df_between", (F.col("k") - 1).cast("long"))
             .withColumn("df_within", (F.col("n_total") - F.col("k")).cast("long"))
             .withColumn("f_stat", F.try_divide(F.try_divide("ssb", "df_between"), F.try_divide("ssw", "df_within")))
             .withColumn("eta_squared", F.try_divide(F.col("ssb"), F.col("ssb") + F.col("ssw")))
             .withColumn("p_value", f_pvalue_udf("f_stat", "df_between", "df_within"))
             .drop("n_total"))


def levene(df: DataFrame, value: str, group: str, min_n: int = 0) -> DataFrame:
    """STA2: Levene (centre = median): ANOVA on |x - group median|.  Equal
    values of a group are one row before the medians are joined."""
    src = df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
    held = src.groupBy(group, value).agg(F.count(F.lit(1)).alias("_w"))
    if min_n:
        keep = held.groupBy(group).agg(F.sum("_w").alias("_n")).where(F.col("_n") >= min_n).select(group)
        src, held = src.join(keep, group, "left_semi"), held.join(keep, group, "left_semi")
    med = exact_quantiles(src, value, [0.5], [group], names=["_med"])
    dev = held.join(med, group).withColumn("_d", F.abs(F.col(value) - F.col("_med")))
    n, s1, s2 = F.sum("_w"), F.sum(F.col("_w") * F.col("_d")), F.sum(F.col("_w") * F.col("_d") * F.col("_d"))
    gm = dev.groupBy(group).agg(n.alias("n"), (s1 / n).alias("mean"), F.try_divide(F.greatest(s2 - s1 * s1 / n, F.lit(0.0)), n - 1).alias("var"))
    return anova_of(gm).select(F.col("f_stat").alias("levene_stat"), "df_between", "df_within",
                               F.col("p_value").alias("levene_p"))


def normality_moments(df: DataFrame, value: str, group: str | None = None) -> DataFrame:
    """STA3 (re-aimed): skewness, excess kurtosis and Jarque-Bera over the
    whole group (population moments), p = exp(-JB / 2)."""
    by = [group] if group else []
    src = df.where(F.col(value).isNotNull())
    if group:
        src = src.where(F.col(group).isNotNull())
    mean = src.groupBy(*by).agg(F.avg(value).alias("_m"), F.count(F.lit(1)).alias("n"))
    held = src.groupBy(*by, value).agg(F.count(F.lit(1)).alias("_w"))  # equal values are one row before the join
    j = held.join(mean, by) if by else attach_row(held, mean)
    d = F.col(value) - F.col("_m")
    moment = lambda k: F.try_divide(F.sum(F.col("_w") * F.pow(d, k)), F.sum("_w")).alias(f"m{k}")
    agg = j.groupBy(*by).agg(F.first("n").alias("n"), moment(2), moment(3), moment(4))
    out = (agg.withColumn("skewness", F.try_divide(F.col("m3"), F.pow(F.col("m2"), 1.5)))
              .withColumn("excess_kurtosis", F.try_divide(F.col("m4"), F.pow(F.col("m2"), 2)) - 3)
              .withColumn("jarque_bera", F.col("n") / 6.0 * (F.pow(F.col("skewness"), 2) +
                                                            F.pow(F.col("excess_kurtosis"), 2) / 4.0))
              .withColumn("jb_p_value", F.exp(-F.col("jarque_bera") / 2)))
    return out.drop("m2", "m3", "m4")


def tukey_hsd(df: DataFrame, value: str, group: str, min_n: int = 0, alpha: float = ALPHA) -> DataFrame:
    """STA8: Tukey-Kramer HSD over all pairs of the k group summaries (i < j):
    mean difference (second - first), adjusted p, interval, reject.  The pair
    table has k(k-1)/2 rows built from the k-row group table."""
    gm = group_moments(df, value, group, min_n)
    st = gm.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n_total"),
                F.sum((F.col("n") - 1) * F.coalesce(F.col("var"), F.lit(0.0))).alias("ssw"))
    row = st.first()
    k, N, ssw = int(row["k"]), int(row["n_total"] or 0), float(row["ssw"] or 0.0)
    dfw = N - k
    msw = ssw / dfw if dfw > 0 else float("nan")
    qcrit = dists.qtukey(1 - alpha, k, dfw) if k >= 2 and dfw > 0 else float("nan")
    # the k-row table of group summaries with itself (k(k-1)/2 rows, inherent to
    # the test), the pairs spread over tasks
    gm = materialize(gm)
    a = gm.select(F.col(group).alias("group1"), F.col("n").alias("n1"),
                  F.col("mean").alias("mean1"))
    b = gm.select(F.col(group).alias("group2"), F.col("n").alias("n2"),
                  F.col("mean").alias("mean2"))
    pairs = a.repartition("group1").crossJoin(b).where(F.col("group1") < F.col("group2"))
    diff, se = F.col("meandiff"), F.col("std_error")
    q = F.when(se > 0, F.abs(diff) / se).when(diff != 0, math.inf).otherwise(0.0)
    out = (pairs.withColumn("meandiff", F.col("mean2") - F.col("mean1"))
           .withColumn("std_error", F.sqrt(F.lit(msw) / 2 * (1 / F.col("n1") + 1 / F.col("n2"))))
           .withColumn("p_adj", tukey_pvalue(q, k, float(dfw)) if k >= 2 and dfw > 0 else F.lit(None).cast("double"))
           .withColumn("lower", diff - F.lit(qcrit) * se)
           .withColumn("upper", diff + F.lit(qcrit) * se)
           .withColumn("reject", F.col("p_adj") < alpha))
    return out.select("group1", "group2", "meandiff", "std_error", "p_adj", "lower", "upper", "reject")


def t_intervals(df: DataFrame, value: str, group: str) -> DataFrame:
    """STA9: t interval of the mean per group: m +- t(0.975, n-1) s / sqrt(n)."""
    g = group_moments(df, value, group).withColumn("se", F.sqrt(F.col("var") / F.col("n")))
    g = g.withColumn("t_crit", t_crit_udf((F.col("n") - 1).cast("double")))
    return (g.withColumn("ci_low", F.col("mean") - F.col("t_crit") * F.col("se"))
             .withColumn("ci_high", F.col("mean") + F.col("t_crit") * F.col("se")).drop("var"))


# ------------------------------------------------------------ correlation
def _doubles(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])


def _matrix(batch) -> np.ndarray:
    """An Arrow batch as rows of doubles (null: NaN)."""
    return np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns])


def _summed(df: DataFrame, parts: int, products) -> list[np.ndarray]:
    """The sums over all rows of ``products`` (a batch's matrix to ``parts``
    square matrices): block products per Arrow batch, one row a task, summed
    by place.  What reaches the driver is as large as the matrices."""
    p = len(df.columns)
    ship_package(df.sparkSession)

    def run(batches):
        total = np.zeros((parts, p, p))
        for b in batches:
            if b.num_rows:
                total += np.stack(products(_matrix(b)))
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["s"])

    rows = (df.mapInArrow(run, "s array<double>").select(F.posexplode("s").alias("i", "v"))
            .groupBy("i").agg(F.sum("v").alias("v")).collect())
    out = np.zeros(parts * p * p)
    for r in rows:
        out[r["i"]] = r["v"]
    return list(out.reshape(parts, p, p))


def correlation_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """STA12: pairwise-complete Pearson r for every pair in long form (col_a,
    col_b, r); the diagonal is 1, a pair without spread null.  One pass for
    the means, one for the sums of products about them."""
    x = _doubles(df, cols)
    means = np.array([v or 0.0 for v in x.agg(*[F.avg(F.nanvl(c, F.lit(None).cast("double"))) for c in x.columns]).first()])

    def products(m):
        there = np.isfinite(m).astype(float)
        z = np.where(there > 0, m - means, 0.0)
        return [there.T @ there, z.T @ there, (z * z).T @ there, z.T @ z]

    n, s, ss, sxy = _summed(x, 4, products)
    spread = n * ss - s * s  # of the first column, over the rows that have both
    some = spread > 1e-12 * n * ss
    with np.errstate(invalid="ignore", divide="ignore"):
        r = np.where(some & some.T, (n * sxy - s * s.T) / np.sqrt(spread * spread.T), np.nan)
    rows = [(a, b, 1.0 if i == j else None if np.isnan(r[i, j]) else float(np.clip(r[i, j], -1.0, 1.0))) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    return df.sparkSession.createDataFrame(rows, "col_a string, col_b string, r double")


def drivers(df: DataFrame, target: str, cols: list[str]) -> DataFrame:
    """STA13 + SRT5: r of each column with the target, ordered by |r|."""
    row = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(f"c{i}")
                   for i, c in enumerate(cols)])
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"c{i}").alias("r")) for i, c in enumerate(cols)])
    out = row.select(F.explode(arr).alias("_s")).select("_s.feature", "_s.r")
    return out.withColumn("rank_abs", F.row_number().over(Window.orderBy(F.abs("r").desc_nulls_last(), "feature")))


# ------------------------------------------------------------ regression
def centred_products(df: DataFrame, cols: list[str]) -> tuple[int, np.ndarray, np.ndarray]:
    """n, the means, and the sums of products about the means of ``cols``
    (rows complete in them): two passes, nothing cancels."""
    x = _doubles(df, cols)
    row = x.agg(F.count(F.lit(1)), *[F.avg(c) for c in x.columns]).first()
    means = np.array([v or 0.0 for v in row[1:]])
    return int(row[0]), means, _summed(x, 1, lambda m: [(m - means).T @ (m - means)])[0]


def _inverse(s: np.ndarray) -> np.ndarray:
    """Pseudo-inverse of a matrix of products, its columns brought to one scale."""
    d = np.sqrt(np.where(np.diag(s) > 0, np.diag(s), 1.0))
    return np.linalg.pinv(s / np.outer(d, d), hermitian=True) / np.outer(d, d)


def _solved(df: DataFrame, y: str, xs: list[str]) -> dict:
    """The model's terms from the centred products of the complete rows; no
    more than their number where it leaves no degree of freedom."""
    n, means, s = centred_products(df.dropna(subset=[y, *xs]), [*xs, y])
    if n <= len(xs) + 1:
        return {"n": n}
    sxx, sxy, mx, my = s[:-1, :-1], s[:-1, -1], means[:-1], means[-1]
    inv = _inverse(sxx)
    slopes = inv @ sxy
    return {"n": n, "beta": np.append(my - mx @ slopes, slopes), "sse": max(float(s[-1, -1] - slopes @ sxy), 0.0), "sst": float(s[-1, -1]),
            "unscaled": np.append(1 / n + mx @ inv @ mx, np.diag(inv)), "sxx": sxx, "mx": mx}


def _coefficients(df: DataFrame, xs: list[str], m: dict) -> DataFrame:
    schema = "term string, coef double, std_err double, t double, p_value double, ci_low double, ci_high double"
    if "beta" not in m:
        return df.sparkSession.createDataFrame([(term, *[None] * 6) for term in ["const", *xs]], schema)
    dfr = m["n"] - len(xs) - 1
    se = np.sqrt(np.maximum(m["unscaled"] * m["sse"] / dfr, 0.0))
    tcrit = dists.t_ppf(1 - ALPHA / 2, dfr)
    rows = []
    for term, b, e in zip(["const", *xs], m["beta"].tolist(), se.tolist()):
        t = b / e if e > 0 else float("nan")
        rows.append((term, b, e, t, dists.t_sf2(t, dfr), b - tcrit * e, b + tcrit * e))
    return df.sparkSession.createDataFrame(rows, schema)


def _residuals(df: DataFrame, y: str, xs: list[str], beta: np.ndarray, *keep: str) -> DataFrame:
    known = lambda b: F.lit(None if math.isnan(b) else b).cast("double")
    fitted = known(float(beta[0]))
    for b, x in zip(beta[1:].tolist(), xs):
        fitted = fitted + known(b) * F.col(x).cast("double")
    actual = F.col(y).cast("double")
    return df.dropna(subset=[y, *xs]).select(*keep, actual.alias("actual"), fitted.alias("fitted"), (actual - fitted).alias("residual"))


FIT_METRICS = ["n", "df_model", "df_resid", "r_squared", "adj_r_squared", "f_stat", "f_p_value", "log_likelihood", "aic", "bic",
               "durbin_watson", "jarque_bera", "jb_p_value", "skew", "kurtosis", "condition_number"]


def _fit(df: DataFrame, y: str, xs: list[str], m: dict, order_col: str) -> DataFrame:
    schema = "metric string, value double"
    if "beta" not in m:
        return df.sparkSession.createDataFrame([(k, float(m["n"]) if k == "n" else None) for k in FIT_METRICS], schema)
    res = _residuals(df, y, xs, m["beta"], order_col)
    n, p = m["n"], len(xs) + 1
    # with a constant the residuals' mean is zero up to rounding
    e = F.col("residual")
    mom = res.agg(F.sum(e * e).alias("sse"), F.skewness(e).alias("skew"), F.kurtosis(e).alias("kurt")).first()
    sse, skew, kurt = float(mom["sse"]), float(mom["skew"] or 0.0), float(mom["kurt"] or 0.0) + 3
    dfr, dfm, sst = n - p, p - 1, m["sst"]
    ratio = lambda a, b: a / b if b else float("nan")
    r2 = 1 - ratio(sse, sst)
    fstat = ratio((sst - sse) / dfm if dfm else float("nan"), sse / dfr)
    llf = -n / 2.0 * (math.log(2 * math.pi) + math.log(sse / n) + 1) if sse > 0 else float("inf")
    jb = n / 6.0 * (skew ** 2 + (kurt - 3) ** 2 / 4.0)
    full = np.block([[np.array([[float(n)]]), n * m["mx"][None, :]], [n * m["mx"][:, None], m["sxx"] + n * np.outer(m["mx"], m["mx"])]])
    eig = np.linalg.eigvalsh(full)
    values = [n, dfm, dfr, r2, 1 - (n - 1) / dfr * (1 - r2), fstat, dists.f_sf(fstat, dfm, dfr), llf, -2 * llf + 2 * p, -2 * llf + p * math.log(n),
              ratio(durbin_watson_numerator(res, order_col, "residual"), sse), jb, math.exp(-jb / 2), skew, kurt,
              math.sqrt(max(eig) / min(eig)) if min(eig) > 0 else float("inf")]
    return df.sparkSession.createDataFrame([(k, float(v)) for k, v in zip(FIT_METRICS, values, strict=True)], schema)


def ols_coefficients(df: DataFrame, y: str, xs: list[str]) -> DataFrame:
    """STA14: OLS with a constant: coefficients, standard errors, t, p and
    95 % interval, from the centred products (two passes); null where the
    complete rows are no more than the terms."""
    return _coefficients(df, xs, _solved(df, y, xs))


def ols_fit(df: DataFrame, y: str, xs: list[str], order_col: str = "id") -> DataFrame:
    """STA14: fit statistics; one more pass for the residuals' moments and
    one for Durbin-Watson in ``order_col`` order."""
    return _fit(df, y, xs, _solved(df, y, xs), order_col)


def ols(df: DataFrame, y: str, xs: list[str], order_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """STA14: (coefficients, fit statistics) of one model."""
    m = _solved(df, y, xs)
    return _coefficients(df, xs, m), _fit(df, y, xs, m, order_col)


def durbin_watson_numerator(res: DataFrame, order_col: str, e: str) -> float:
    """Sum of squared successive residual differences in ``order_col`` order,
    without a one-partition window: lag inside value-range buckets, then the
    bucket boundaries from a table of <= B bucket rows."""
    b = bucketize(res, order_col)
    w = Window.partitionBy("_bkt").orderBy(order_col)
    inner = b.withColumn("_d", F.col(e) - F.lag(e).over(w)).groupBy("_bkt").agg(
        F.sum(F.pow("_d", 2)).alias("ssd"), F.min_by(e, order_col).alias("first_e"),
        F.max_by(e, order_col).alias("last_e"))
    wb = Window.orderBy("_bkt")
    edges = inner.withColumn("_prev", F.lag("last_e").over(wb)).agg(
        F.sum(F.coalesce("ssd", F.lit(0.0))).alias("a"),
        F.sum(F.coalesce(F.pow(F.col("first_e") - F.col("_prev"), 2), F.lit(0.0))).alias("b")).first()
    return float(edges["a"] + edges["b"])


def vif(df: DataFrame, xs: list[str]) -> DataFrame:
    """STA17: VIF without a constant (uncentred): G_ii (G^-1)_ii."""
    n, means, s = centred_products(df.dropna(subset=xs), xs)
    G = s + n * np.outer(means, means)
    Ginv = _inverse(G)
    rows = [(x, float(G[i, i] * Ginv[i, i])) for i, x in enumerate(xs)]
    return df.sparkSession.createDataFrame(rows, "predictor string, vif double")


def fitted_residuals(df: DataFrame, y: str, coefs: DataFrame, id_col: str = "id") -> DataFrame:
    """STA15: fitted values and residuals from a coefficient table."""
    cs = {r["term"]: r["coef"] for r in coefs.collect()}  # one row per term (p rows)
    xs = [t for t in cs if t != "const"]
    return _residuals(df, y, xs, np.array([cs.get("const", 0.0), *[cs[t] for t in xs]], float), id_col)


def qq_points(resid: DataFrame, col: str = "residual", points: int = 99) -> DataFrame:
    """STA16: sample quantiles of the residuals at probabilities i/(points+1)
    beside the standard normal quantiles."""
    probs = [(i + 1) / (points + 1) for i in range(points)]
    q = exact_quantiles(resid, col, probs, wide=False)
    theo = resid.sparkSession.createDataFrame([(p, dists.norm_ppf(p)) for p in probs], "p double, normal_quantile double")
    return q.join(F.broadcast(theo), "p").select("p", "normal_quantile", F.col("q").alias("sample_quantile"))


def kde_by_group(df: DataFrame, value: str, group: str, grid: int = 1000, fine: int = 50, reach: float = 8.0) -> DataFrame:
    """STA20: Gaussian KDE per group with Scott's bandwidth (s n^-1/5) on a
    grid of ``grid`` points over the range widened by half its width each
    side.  Values are averaged within bins of bandwidth / ``fine``; a value
    lies at most h = bandwidth / fine from its bin's mean, which changes the
    density by at most (h / bandwidth)^2 / 2 of the kernel's peak (2e-4 of
    it).  A bin adds to the grid points within ``reach`` bandwidths, beyond
    which the kernel is below exp(-reach^2 / 2) of its peak (1.3e-14), and the
    sums are a shuffle over (group, grid point): at most fine * reach * grid
    plus one row a bin, and no task holds a group.  A group of equal values has the bandwidth
    n^-1/5 and all its grid points there."""
    src = df.select(F.col(group).cast("string").alias("g"), F.col(value).cast("double").alias("v")).dropna()
    st = src.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("v").alias("s"),
                              F.min("v").alias("lo"), F.max("v").alias("hi"))
    spread = F.when(F.col("s") > 0, F.col("s")).otherwise(1.0)
    span = F.col("hi") - F.col("lo")
    st = materialize(st.select("g", "n", (spread * F.pow(F.col("n").cast("double"), -0.2)).alias("bw"), "lo", span.alias("span"),
                               (F.col("lo") - span / 2).alias("x0"), (span * 2 / max(grid - 1, 1)).alias("step")))
    binned = (_with_group_figures(src, st).groupBy("g", F.floor((F.col("v") - F.col("lo")) / F.col("bw") * fine).alias("bin"))
              .agg(F.count(F.lit(1)).alias("c"), F.avg("v").alias("vc")))
    at = lambda d: F.try_divide(F.col("vc") + d * F.col("bw") - F.col("x0"), F.col("step"))
    first = F.coalesce(F.greatest(F.ceil(at(-reach)), F.lit(0)), F.lit(0)).cast("int")
    last = F.coalesce(F.least(F.floor(at(reach)), F.lit(grid - 1)), F.lit(grid - 1)).cast("int")
    near = _with_group_figures(binned, st).where(first <= last).withColumn("point", F.explode(F.sequence(first, last)))
    z = (F.col("x0") + F.col("point") * F.col("step") - F.col("vc")) / F.col("bw")
    sums = near.groupBy("g", "point").agg(F.sum(F.exp(-0.5 * z * z) * F.col("c")).alias("k"))
    points = st.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    density = F.coalesce("k", F.lit(0.0)) / (F.col("n") * F.col("bw") * math.sqrt(2 * math.pi))
    return points.join(sums, ["g", "point"], "left").select(
        F.col("g").alias(group), (F.col("x0") + F.col("point") * F.col("step")).alias("x"), density.alias("density"))


def _with_group_figures(df: DataFrame, figures: DataFrame) -> DataFrame:
    """``df`` with the figures of its group ``g``: broadcast if they are a
    checked few, else the rows of a group are spread over 16 salted copies of
    its one row."""
    small, rows = _small(figures)
    if rows is not None:
        return df.join(small, "g")
    copies = figures.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(15))))
    salt = F.pmod(F.xxhash64(*[c for c in df.columns if c != "g"]), F.lit(16)).cast("int")
    return df.withColumn("_salt", salt).join(copies, ["g", "_salt"]).drop("_salt")


def seeded_sample(df: DataFrame, group: str, n: int, seed: int = 42, id_col: str = "id") -> DataFrame:
    """STA21: at most ``n`` rows per group, the first by the MD5 of
    (id, seed), then id: repeatable, and SQL elsewhere can state it.  The rows
    are cut to ``n`` within parts of a group first, so no task sorts a whole
    group; only those survivors meet."""
    h = df.withColumn("_h", F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.lit(str(seed))).cast("binary")))
    h = h.withColumn("_part", F.substring("_h", 31, 2))
    for by in ([group, "_part"], [group]):
        w = Window.partitionBy(*by).orderBy("_h", id_col)
        h = h.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n)
    return h.drop("_h", "_part", "_r")


def effect_size_rows(d_rows: list[tuple[str, DataFrame]], eta: tuple[str, DataFrame]) -> DataFrame:
    """STA10: effect-size summary with wording (SCL30)."""
    parts = [df.select(F.lit(name).alias("hypothesis"), F.lit("Cohen's d").alias("effect_size"),
                       F.col("cohens_d").alias("value")) for name, df in d_rows]
    parts.append(eta[1].select(F.lit(eta[0]).alias("hypothesis"), F.lit("Eta-squared").alias("effect_size"),
                               F.col("eta_squared").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    words = F.when(F.col("effect_size") == "Eta-squared", effect_size_words("value", EFFECT_ETA_CUTS, use_abs=False)) \
        .otherwise(effect_size_words("value", EFFECT_D_CUTS))
    return out.withColumn("interpretation", words)
