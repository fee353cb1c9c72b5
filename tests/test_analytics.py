"""Differential tests of the analytics operators against pandas/numpy."""

import datetime as dt

import numpy as np
import pandas as pd

from innsight.operators import analytics as A


def test_moving_average_window_6(spark):
    df = spark.createDataFrame([(i, float(i)) for i in range(1, 11)], "m int, v double")
    out = [r.moving_avg for r in A.centered_moving_average(df, "m", "v").orderBy("m").collect()]
    exp = pd.Series(range(1, 11), dtype=float).rolling(6, center=True).mean().tolist()
    assert [None if np.isnan(x) else x for x in exp] == out


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(0.0,), (2.0,), (10.0,)], "v double")
    out = [r["count"] for r in A.histogram(df, "v", 5, 0.0, 10.0).orderBy("bin").collect()]
    assert out == [1, 1, 0, 0, 1]


def test_weekly_label_sunday(spark):
    df = spark.createDataFrame([(dt.date(2025, 9, 28), 1.0), (dt.date(2025, 9, 29), 3.0)], "d date, v double")
    out = {r.week_end: r.weekly_mean for r in A.weekly_mean(df, "d", df.v).collect()}
    assert out == {dt.date(2025, 9, 28): 1.0, dt.date(2025, 10, 5): 3.0}


def test_gini_matches_numpy(spark):
    rng = np.random.default_rng(3)
    counts = rng.integers(1, 30, 400)
    counts[:50] = 1
    rows = [(int(h), i) for h, c in enumerate(counts) for i in range(int(c))]
    df = spark.createDataFrame(rows, "host_id long, id long")
    got = A.lorenz_gini(df).first()
    s = np.sort(counts)
    cum = np.cumsum(s) / s.sum()
    gini = 1 - 2 * np.trapezoid(cum, np.linspace(0, 1, len(s)))
    assert abs(got.gini - gini) < 1e-12
    assert abs(got.pct_listings_top20 - (1 - cum[int(0.8 * len(s))]) * 100) < 1e-9
    assert abs(got.pct_listings_top10 - (1 - cum[int(0.9 * len(s))]) * 100) < 1e-9


def test_box_stats_match_pandas(spark):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b"], 500), "v": rng.lognormal(3, 1, 500)})
    got = A.box_stats(spark.createDataFrame(pdf), "v", ["g"]).toPandas().set_index("g")
    for g, s in pdf.groupby("g")["v"]:
        q1, q3 = s.quantile(0.25), s.quantile(0.75)
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert abs(got.loc[g, "median"] - s.median()) < 1e-9
        assert abs(got.loc[g, "whisker_high"] - s[s <= hi].max()) < 1e-9
        assert got.loc[g, "outliers"] == int(((s < lo) | (s > hi)).sum())
