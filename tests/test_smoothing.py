"""Local lines against brute force over all rows."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd

from innsight.operators import smoothing


def brute(x, y, at, frac=2 / 3):
    out = []
    for x0 in at:
        d = np.abs(x - x0)
        h = np.sort(d)[math.ceil(frac * len(d) - 1e-9) - 1] * 1.0000001
        if h == 0:
            out.append(y[d == 0].mean())
            continue
        w, u = np.clip(1 - (d / h) ** 3, 0, None) ** 3, (x - x0) / h
        A = np.column_stack([np.ones(len(x)), u]) * np.sqrt(w)[:, None]
        out.append(np.linalg.lstsq(A, y * np.sqrt(w), rcond=None)[0][0])
    return np.array(out)


def fitted(spark, x, y, **kw):
    got = smoothing.local_fit(spark.createDataFrame(pd.DataFrame({"a": x, "b": y})), "a", "b", **kw).toPandas().sort_values("x")
    values, counts = np.unique(x, return_counts=True)
    assert got["x"].tolist() == values.tolist() and got["n"].tolist() == counts.tolist()
    return got


def test_few_values_with_an_outlier(spark):
    rng = np.random.default_rng(8)
    x = np.r_[rng.integers(1, 17, 600).astype(float), 10000.0]
    y = np.r_[np.sin(x[:-1] / 3) * 50 + rng.normal(0, 1, 600), 70.0]
    got = fitted(spark, x, y)
    assert np.allclose(got["smoothed"][:-1], brute(x, y, got["x"].to_numpy()[:-1]), atol=1e-8)


def test_many_values_are_exact_at_any_bucket_count(spark):
    rng = np.random.default_rng(9)
    x = np.r_[rng.lognormal(0, 1, 3000), np.full(1200, 0.5), np.full(300, 0.7), 1e6]
    y = np.sin(np.log(x)) * 50 + rng.normal(0, 5, len(x))
    for frac, buckets in ((2 / 3, None), (0.2, 9), (0.05, 200)):
        got = fitted(spark, x, y, frac=frac, buckets=buckets)
        at = got["x"].to_numpy()
        inner = at < 100
        assert np.allclose(got["smoothed"].to_numpy()[inner], brute(x, y, at[inner], frac), atol=1e-6)


def test_a_hundred_thousand_values(spark):
    rng = np.random.default_rng(10)
    x = rng.normal(0, 1, 100_000)
    y = np.cos(2 * x) + rng.normal(0, 0.3, len(x))
    got = fitted(spark, x, y)
    pick = np.sort(rng.choice(len(got), 60, replace=False))
    assert len(got) == len(x)
    assert np.allclose(got["smoothed"].to_numpy()[pick], brute(x, y, got["x"].to_numpy()[pick]), atol=1e-8)


def test_edge_cases(spark):
    kinds = "a double, b double, x string, n int"
    fit = lambda rows: sorted(map(tuple, smoothing.local_fit(spark.createDataFrame(rows, kinds), "a", "b").collect()))
    assert fit([]) == [] and fit([(None, 1.0, "", 1), (1.0, None, "", 1), (math.nan, 1.0, "", 1), (math.inf, 1.0, "", 1)]) == []
    assert fit([(2.0, 5.0, "p", 1)]) == [(2.0, 5.0, 1)]
    assert fit([(2.0, 5.0, "p", 1), (2.0, 7.0, "p", 1), (3.0, None, None, None)]) == [(2.0, 6.0, 2)]
    hot = fit([(1.0, float(i), "q", 1) for i in range(90)] + [(float(i), 0.0, None, 2) for i in range(2, 12)])
    assert hot[0] == (1.0, 44.5, 90) and len(hot) == 11 and all(math.isfinite(r[1]) for r in hot)
