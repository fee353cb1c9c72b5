"""Statistics: tails against table values; tests and regression against
brute force on small fixtures (numpy only)."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from innsight.functions import dists
from innsight.operators import stats as S


def test_tails_known_values():
    assert abs(dists.f_sf(3.708, 3, 10) - 0.05) < 1e-3
    assert abs(dists.t_sf2(2.228, 10) - 0.05) < 1e-3
    assert abs(dists.t_ppf(0.975, 10) - 2.228139) < 1e-5
    assert abs(dists.norm_ppf(0.975) - 1.959964) < 1e-6
    assert abs(dists.tukey_sf(3.877, 3, 10) - 0.05) < 1e-3
    assert abs(dists.tukey_sf(4.232, 5, 20) - 0.05) < 1e-3


def _two_groups(spark, seed=1):
    rng = np.random.default_rng(seed)
    a = np.round(rng.normal(10, 2, 300), 1)
    b = np.round(rng.normal(11, 3, 200), 1)
    pdf = pd.DataFrame({"g": ["a"] * 300 + ["b"] * 200, "v": np.r_[a, b]})
    return spark.createDataFrame(pdf), a, b


def test_welch_and_mann_whitney_brute_force(spark):
    df, a, b = _two_groups(spark)
    w = S.welch_test(df, "v", F.col("g"), "a", "b").first()
    va, vb = a.var(ddof=1) / len(a), b.var(ddof=1) / len(b)
    assert abs(w.t_stat - (a.mean() - b.mean()) / math.sqrt(va + vb)) < 1e-9
    # U by pairwise comparison (ties count 1/2)
    u = sum((x > y) + 0.5 * (x == y) for x in a for y in b)
    m = S.mann_whitney(df, "v", F.col("g"), "a", "b").first()
    assert abs(m.u_stat - u) < 1e-9
    assert 0 <= m.p_value <= 1


def test_anova_matches_formula(spark):
    df, a, b = _two_groups(spark, 2)
    r = S.anova(df, "v", "g").first()
    allv = np.r_[a, b]
    ssb = len(a) * (a.mean() - allv.mean()) ** 2 + len(b) * (b.mean() - allv.mean()) ** 2
    ssw = ((a - a.mean()) ** 2).sum() + ((b - b.mean()) ** 2).sum()
    assert abs(r.f_stat - (ssb / 1) / (ssw / (len(allv) - 2))) < 1e-8
    # two groups: F equals the pooled t squared
    sp = ssw / (len(allv) - 2)
    t = (a.mean() - b.mean()) / math.sqrt(sp * (1 / len(a) + 1 / len(b)))
    assert abs(r.f_stat - t * t) < 1e-8
    assert abs(r.p_value - dists.t_sf2(t, len(allv) - 2)) < 1e-8


def test_ols_and_vif_match_numpy(spark):
    rng = np.random.default_rng(4)
    n = 400
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    y = 2 + 3 * x1 - x2 + rng.normal(size=n)
    pdf = pd.DataFrame({"id": np.arange(n), "x1": x1, "x2": x2, "y": y})
    df = spark.createDataFrame(pdf)
    coefs, fit = S.ols(df, "y", ["x1", "x2"])
    X = np.c_[np.ones(n), x1, x2]
    beta, *_ = np.linalg.lstsq(X, y, rcond=None)
    got = coefs.toPandas().set_index("term")["coef"]
    assert np.allclose(got[["const", "x1", "x2"]].values, beta, atol=1e-9)
    f = dict(fit.toPandas().values)
    e = y - X @ beta
    assert abs(f["durbin_watson"] - (np.diff(e) ** 2).sum() / (e ** 2).sum()) < 1e-9
    assert abs(f["r_squared"] - (1 - (e ** 2).sum() / ((y - y.mean()) ** 2).sum())) < 1e-9
    v = S.vif(df, ["x1", "x2"]).toPandas().set_index("predictor")["vif"]
    G = X[:, 1:].T @ X[:, 1:]
    assert np.allclose(v.values, np.diag(G) * np.diag(np.linalg.inv(G)), rtol=1e-9)


def test_seeded_sample_bounds(spark):
    df = spark.createDataFrame([(i, "hot" if i % 3 else "cold") for i in range(3000)], "id long, g string")
    s = S.seeded_sample(df, "g", 100)
    counts = dict(s.groupBy("g").count().collect())
    assert counts == {"hot": 100, "cold": 100}
    assert sorted(r.id for r in s.collect()) == sorted(r.id for r in S.seeded_sample(df, "g", 100).collect())


def test_t_intervals_of_each_group(spark):
    rng = np.random.default_rng(12)
    v = np.round(rng.normal(100, 15, 10), 2)
    got = S.t_intervals(spark.createDataFrame([("a", float(x)) for x in v] + [("b", 5.0), (None, 1.0), ("a", None)], "g string, v double"), "v", "g")
    got = {r["g"]: r for r in got.collect()}
    half = 2.2621571628 * v.std(ddof=1) / math.sqrt(10)
    assert set(got) == {"a", "b"} and got["a"]["n"] == 10
    assert abs(got["a"]["ci_low"] - (v.mean() - half)) < 1e-6 and abs(got["a"]["ci_high"] - (v.mean() + half)) < 1e-6
    assert got["b"]["n"] == 1 and got["b"]["ci_low"] is None and got["b"]["ci_high"] is None


def test_fitted_values_and_residuals(spark):
    rng = np.random.default_rng(13)
    x1, x2 = rng.normal(size=200), rng.normal(size=200)
    y = 1 + 2 * x1 - 3 * x2 + rng.normal(size=200)
    df = spark.createDataFrame(pd.DataFrame({"id": np.arange(200), "x1": x1, "x2": x2, "y": y})).withColumn("x1", F.when(F.col("id") != 7, F.col("x1")))
    got = S.fitted_residuals(df, "y", S.ols_coefficients(df, "y", ["x1", "x2"])).toPandas().sort_values("id")
    use = np.arange(200) != 7
    X = np.c_[np.ones(199), x1[use], x2[use]]
    want = X @ np.linalg.lstsq(X, y[use], rcond=None)[0]
    assert got["id"].tolist() == np.arange(200)[use].tolist()
    assert np.allclose(got["fitted"], want) and np.allclose(got["residual"], y[use] - want)


def test_regression_of_too_few_rows_is_null(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, 3.0), (2, 2.0, 1.0, 5.0), (3, 4.0, 4.0, 4.0)], "id long, x1 double, x2 double, y double")
    coefs, fit = S.ols(df, "y", ["x1", "x2"])
    assert [r["term"] for r in coefs.collect()] == ["const", "x1", "x2"] and all(r["coef"] is None and r["p_value"] is None for r in coefs.collect())
    values = {r["metric"]: r["value"] for r in fit.collect()}
    assert values.pop("n") == 3 and len(values) == 15 and set(values.values()) == {None}
    assert {r["residual"] for r in S.fitted_residuals(df, "y", coefs).collect()} == {None}
