"""Rejected pairs of Tukey HSD, counted without the pairs, against the pair list."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest

from innsight.functions import dists
from innsight.operators import pairwise
from innsight.operators import stats as S


def report(df, **kw):
    return [tuple(r) for r in pairwise.tukey_report(df, "v", "g", **kw).collect()]


def from_pairs(df, top=10):
    rows = S.tukey_hsd(df, "v", "g").collect()
    hit = sorted((r for r in rows if r["reject"]), key=lambda r: (-abs(r["meandiff"]), r["group1"], r["group2"]))
    return [(r["group1"], r["group2"], r["meandiff"], r["p_adj"], len(rows), len(hit)) for r in hit[:top]] or [(None, None, None, None, len(rows), 0)]


def same(got, want):
    assert len(got) == len(want)
    for a, b in zip(got, want):
        assert a[:2] == b[:2] and a[4:] == b[4:] and a[2] == b[2] and (a[3] == b[3] or abs(a[3] - b[3]) < 1e-9)


def frame(spark, groups):
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    return spark.createDataFrame(rows, "g string, v double")


def test_counts_and_largest_equal_the_pair_list(spark):
    rng = np.random.default_rng(3)
    sizes = rng.integers(3, 120, 40)
    mixed = {f"g{i:02d}": np.round(rng.normal(rng.normal(0, 1.5), 2, n), 3) for i, n in enumerate(sizes)}
    # differences that only large groups show, far means in tiny groups, equal groups
    mixed |= {"far1": [40.0, -20.0], "far2": [-9.0, 9.0, 9.0], "x1": [1.0, 2.0] * 50, "x2": [1.0, 2.0] * 50, "x3": [1.0, 2.0] * 50}
    df = frame(spark, mixed)
    got = report(df)
    assert 0 < got[0][5] < got[0][4] == 45 * 44 // 2
    same(got, from_pairs(df))
    same(report(df, top=3), from_pairs(df, 3))


def test_edge_cases(spark):
    for groups, pairs in (({}, 0), ({"a": [1, 2]}, 0), ({"a": [1], "b": [2]}, 1), ({c: [1, 2, 3] for c in "abc"}, 3)):
        assert report(frame(spark, groups)) == [(None, None, None, None, pairs, 0)]
    flat = frame(spark, {"a": [1, 1], "b": [1, 1, 1], "c": [4, 4], "d": [4] * 9})
    assert report(flat) == [("a", "c", 3.0, 0.0, 6, 4), ("a", "d", 3.0, 0.0, 6, 4), ("b", "c", 3.0, 0.0, 6, 4), ("b", "d", 3.0, 0.0, 6, 4)]
    same(report(flat), from_pairs(flat))
    nulls = frame(spark, {"a": [1, 2], "b": [50, 51]}).union(spark.createDataFrame([(None, 7.0), ("a", None)], "g string, v double"))
    same(report(nulls), from_pairs(nulls))


def test_thousands_of_groups(spark):
    rng = np.random.default_rng(5)
    k = 3000
    sizes = rng.integers(2, 9, k)
    g = np.repeat(np.arange(k), sizes)
    v = np.repeat(rng.normal(0, 4, k), sizes) + rng.normal(0, 1, len(g))
    got = report(spark.createDataFrame(pd.DataFrame({"g": g, "v": v})))
    t = pd.DataFrame({"g": g, "v": v}).groupby("g")["v"].agg(["size", "mean", "var"])
    n, m = t["size"].to_numpy(), t["mean"].to_numpy()
    dfw = len(g) - k
    c = dists.qtukey(0.95, k, dfw) * math.sqrt(((n - 1) * t["var"]).sum() / dfw / 2)
    d = np.abs(m[:, None] - m)
    hit = np.triu(d > c * np.sqrt(1 / n[:, None] + 1 / n), 1)
    assert got[0][4:] == (k * (k - 1) // 2, int(hit.sum())) and 0 < hit.sum()
    assert [abs(r[2]) for r in got] == pytest.approx(sorted(d[hit])[::-1][:10])
