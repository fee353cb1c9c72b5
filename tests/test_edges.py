"""Empty, null, constant, single-row and NaN input; values at extreme
parameters; pairs at the poles and across +-180 degrees."""

import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from innsight.functions import cleaning as C
from innsight.functions import dists
from innsight.operators import analytics as A
from innsight.operators import duplicates as DUP
from innsight.operators import quality as Q
from innsight.operators import ranking as R
from innsight.operators import stats as S
from innsight.streaming import incremental as INC
from innsight.streaming import reviews_stream as RS


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, None), (2, None)], [(1, 5.0)], [(1, 5.0), (2, 5.0)], [(1, float("nan"))]])
def test_quantiles_of_little(spark, rows):
    df = spark.createDataFrame(rows, "id long, v double")
    got = R.exact_quantiles(df, "v", [0.25, 0.5]).collect()
    real = [v for _, v in rows if v is not None and not math.isnan(v)]
    assert [tuple(r) for r in got] == ([(real[0], real[0])] if real else [])
    assert A.ecdf(df.where("v is not null and not isnan(v)"), "v").count() == len(set(real))


def groups(spark, rows):
    return spark.createDataFrame(rows, "g string, v double")


CASES = {
    "empty": [], "one row": [("a", 1.0)], "constant": [("a", 1.0)] * 3 + [("b", 1.0)] * 3, "one group": [("a", 1.0), ("a", 2.0)],
    "single in b": [("a", 1.0), ("a", 2.0), ("b", 5.0)], "nulls": [("a", None), (None, 1.0)],
}


@pytest.mark.parametrize("case", CASES)
def test_statistics_of_little(spark, case):
    df = groups(spark, CASES[case])
    w = S.welch_test(df, "v", F.col("g"), "a", "b").first()
    assert w["p_value"] is None or math.isnan(w["p_value"])
    u = S.mann_whitney(df, "v", F.col("g"), "a", "b").first()
    assert case == "single in b" or u["p_value"] is None or math.isnan(u["p_value"])
    a = S.anova(df, "v", "g").first()
    assert a["f_stat"] is None if case != "single in b" else a["f_stat"] > 0
    assert S.normality_moments(df, "v", "g").count() == len({g for g, v in CASES[case] if g and v is not None})


def test_mann_whitney_ignores_nan(spark):
    rows = [("a", float(i)) for i in range(20)] + [("b", i + 5.0) for i in range(20)]
    want = S.mann_whitney(groups(spark, rows), "v", F.col("g"), "a", "b").first()
    assert S.mann_whitney(groups(spark, rows + [("a", float("nan"))]), "v", F.col("g"), "a", "b").first() == want


def test_hexagons_on_one_line(spark):
    df = spark.createDataFrame([(18.0, -33.0 - i / 10, float(i)) for i in range(6)] * 3, "x double, y double, v double")
    assert A.hexbin_median(df, "x", "y", "v").count() >= 1
    assert A.hexbin_median(df.limit(0), "x", "y", "v").count() == 0


def test_period_without_before(spark):
    df = spark.createDataFrame([(1,)], "count long").select("count", F.to_date(F.lit("2022-01-31")).alias("month_end"))
    r = A.period_comparison(df, "count").first()
    assert r["mean_after"] == 1 and r["drop_pct"] is None and r["recovery_pct"] is None


def test_empty_batch_fails_the_gate(spark):
    got = Q.quality_gate(spark.createDataFrame([], "id long, price_clean double")).collect()
    assert got and not any(r["passed"] for r in got)


def test_studentized_range():
    for p, k, df, want in ((0.95, 20, 1, 59.56), (0.95, 3, 10, 3.877), (0.95, 10, 20, 5.008), (0.99, 2, 5, 5.702), (0.95, 4, 1e9, 3.633)):
        assert abs(dists.qtukey(p, k, df) - want) < 6e-4 * want
    assert abs(dists.ptukey(4, 10, 99_999) - dists.ptukey(4, 10, 100_001)) < 1e-8
    assert dists.tukey_sf_many([0.0, 1e9], 3, 10).tolist() == pytest.approx([1.0, 0.0], abs=1e-30)


def test_student_tail_at_any_df():
    assert abs(dists.t_sf2(1, 1) - 0.5) < 1e-14 and abs(dists.t_sf2(2, 2) - (1 - 2 / math.sqrt(6))) < 1e-14
    normal = math.erfc(2 / math.sqrt(2))
    density = math.exp(-2) / math.sqrt(2 * math.pi)
    for df in (1e9, 1e10, 1e11):  # the first term beyond the normal: phi(t) (t^3 + t) / (2 df)
        assert abs(dists.t_sf2(2, df) - (normal + density * 10 / (2 * df))) < 1e-13
    for df in (1, 3, 7.5, 40, 1e4):
        for t in (0.1, 1, 4):
            u = np.linspace(0, t, 200_001)
            inside = np.trapezoid((1 + u * u / df) ** (-(df + 1) / 2), u) * math.exp(math.lgamma((df + 1) / 2) - math.lgamma(df / 2)) / math.sqrt(df * math.pi)
            assert abs(dists.t_sf2(t, df) - (1 - 2 * inside)) < 1e-9
    assert abs(dists.t_ppf(0.9999999, 1) - math.tan(math.pi * (0.9999999 - 0.5))) < 1


def test_f_tail_closed_forms():
    for f in (1e-6, 0.3, 1.0, 2.5, 40.0):
        for d2 in (1, 2, 9, 1000, 1e9):  # two degrees above
            want = math.exp(-d2 / 2 * math.log1p(2 * f / d2))
            assert abs(dists.f_sf(f, 2, d2) - want) < 1e-11 + 1e-9 * want
        for d1 in (1, 5, 1e6):  # two below
            assert abs(dists.f_sf(f, d1, 2) - (1 - math.exp(-d1 / 2 * math.log1p(2 / (d1 * f))))) < 1e-10
        for df in (1, 30, 1e9):  # one above: a squared t
            assert abs(dists.f_sf(f, 1, df) - dists.t_sf2(math.sqrt(f), df)) < 1e-12
    assert math.isnan(dists.t_sf2(1.0, 0.5)) and dists.f_sf(0, 3, 4) == 1.0


def test_correlations_with_gaps_and_without_spread(spark):
    rng = np.random.default_rng(3)
    a = rng.normal(1e6, 1, 500)
    b = np.where(rng.random(500) < 0.3, np.nan, 2 * a + rng.normal(size=500))
    pdf = pd.DataFrame({"a": a, "b": b, "same": 0.1, "none": np.nan})
    df = spark.createDataFrame([[None if x != x else float(x) for x in r] for r in pdf.values.tolist()], "a double, b double, same double, none double")
    got = {(r.col_a, r.col_b): r.r for r in S.correlation_pairs(df, list(pdf)).collect()}
    assert len(got) == 16 and abs(got["a", "b"] - pdf["a"].corr(pdf["b"])) < 1e-9 and got["a", "b"] == got["b", "a"]
    assert got["a", "same"] is None and got["same", "b"] is None and got["none", "a"] is None and got["same", "same"] == 1.0
    empty = S.correlation_pairs(df.limit(0), ["a", "b"]).collect()
    assert [r.r for r in empty if r.col_a != r.col_b] == [None, None]


def test_regression_far_from_zero(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(1e7, 1, 300)
    y = 5e7 + 3 * (x - 1e7) + rng.normal(size=300)
    df = spark.createDataFrame(pd.DataFrame({"id": range(300), "x": x, "z": 0.0, "y": y}))
    coefs = {r.term: r for r in S.ols_coefficients(df, "y", ["x", "z"]).collect()}
    slope, _ = np.polyfit(x - 1e7, y - 5e7, 1)
    assert abs(coefs["x"].coef - slope) < 1e-7 and coefs["z"].coef == 0.0
    fit = dict(S.ols_fit(df, "y", ["x", "z"]).collect())
    assert abs(fit["r_squared"] - np.corrcoef(x - 1e7, y - 5e7)[0, 1] ** 2) < 1e-6


def test_levene_by_brute_force(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"g": ["a"] * 90 + ["b"] * 40 + ["c"] * 3, "v": np.round(np.r_[rng.normal(5, 1, 90), rng.normal(7, 3, 40), [1, 2, 9]], 1)})
    got = S.levene(spark.createDataFrame(pdf), "v", "g", min_n=20).first()
    d = [np.abs(p["v"] - p["v"].median()).to_numpy() for g, p in pdf.groupby("g") if len(p) >= 20]
    z, k, n = np.concatenate(d), len(d), sum(map(len, d))
    f = sum(len(x) * (x.mean() - z.mean()) ** 2 for x in d) / (k - 1) / (sum(((x - x.mean()) ** 2).sum() for x in d) / (n - k))
    assert abs(got.levene_stat - f) < 1e-9 and (got.df_between, got.df_within) == (k - 1, n - k)


def test_pairs_everywhere(spark):
    pts = [(1, 1, 0.0, 179.9999), (2, 1, 0.0, -179.9999), (3, 1, 89.9999, 10.0), (4, 1, 89.9999, -170.0), (5, 2, 10.0, 10.0), (6, 3, 10.0, 10.0), (7, 4, None, 1.0)]
    pts += [(100 + i, 9, -33.9 + (i % 7) * 1e-4, 18.4 + (i // 7) * 1e-4) for i in range(60)] + [(200 + i, 9, -33.9, 18.4) for i in range(20)]

    def km(a, b):
        (p, l), (q, m) = ([math.radians(x) for x in r[2:]] for r in (a, b))
        return 2 * 6371 * math.asin(math.sqrt(math.sin((q - p) / 2) ** 2 + math.cos(p) * math.cos(q) * math.sin((m - l) / 2) ** 2))

    want = {(a[1], a[0], b[0]) for a, b in itertools.combinations(pts, 2) if a[1] == b[1] and None not in a + b and km(a, b) < 0.05}
    got = [(r["host_id"], r["id_a"], r["id_b"]) for r in DUP.duplicate_pairs(spark.createDataFrame(pts, "id long, host_id long, latitude double, longitude double")).collect()]
    assert len(got) == len(set(got)) and set(got) == want and {(1, 1, 2), (1, 3, 4)} <= want


def test_upsert_keeps_the_newest(spark):
    cur = spark.createDataFrame([(1, "a", "2024-01-01"), (2, "b", "2024-01-01")], "id long, v string, last_scraped string")
    batch = spark.createDataFrame([(2, "old", "2024-01-02"), (2, "new", "2024-01-03"), (3, "c", None)], cur.schema)
    assert sorted(map(tuple, INC.upsert(cur, batch, newest="last_scraped").collect())) == [(1, "a", "2024-01-01"), (2, "new", "2024-01-03"), (3, "c", None)]


def test_titles_and_literals(spark):
    df = spark.createDataFrame([("d'almeida st-james ", "['None of these', None, 'x']"), ("ÉGLISE de l'o", "[None]"), (None, None)], "t string, l string")
    got = df.select(C.title_trim("t"), C.literal_string_list("l")).collect()
    assert [tuple(r) for r in got] == [("D'Almeida St-James", ["None of these", None, "x"]), ("Église De L'O", [None]), (None, [])]


def test_csv_goes_by_header(spark, tmp_path):
    from pyspark.sql import types as T

    from innsight.sources import files as FS
    (tmp_path / "a.csv").write_text('b,extra,a\n2,x,1\n"3",y,no\n')
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("a", "b", "c")])
    assert sorted(map(tuple, FS.read_csv(spark, str(tmp_path / "a.csv"), schema).collect()), key=repr) == [(1, 2, None), (None, 3, None)]
    bad = FS.read_csv(spark, str(tmp_path / "a.csv"), schema, corrupt="_bad")
    assert [r["_bad"] for r in bad.collect()] == [None, None]


def test_landing_isolates_and_skips(spark, tmp_path):
    from pyspark.sql import types as T

    from innsight.sources import files as FS
    df = spark.createDataFrame([(1, "x"), (2, "y")], "id long, v string")
    FS.write_csv(df, str(tmp_path / "good"), compression="gzip")
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part.csv.gz").write_bytes(b"not gzip at all")
    config = [("Good", str(tmp_path / "good")), ("Missing", str(tmp_path / "none")), ("Broken", str(tmp_path / "broken"))]
    schema = T.StructType(df.schema.fields)
    out, failed = FS.land_sources(spark, config, schema, str(tmp_path / "landed"))
    assert out.count() == 2 and [c for c, _ in failed] == ["Missing", "Broken"]
    FS.write_csv(df.limit(0), str(tmp_path / "good"), compression="gzip")
    again, _ = FS.land_sources(spark, config, schema, str(tmp_path / "landed"))
    assert again.count() == 2  # landed before, not read again


def test_existing_columns(spark):
    assert C.existing_columns(spark.range(1).withColumn("x", F.lit(1)), ["x", "nope", "id"]) == ["x", "id"]


def test_density_error_is_within_its_bound(spark):
    rng = np.random.default_rng(0)
    v = rng.lognormal(size=400)
    got = S.kde_by_group(spark.createDataFrame([("a", float(x)) for x in v] + [("b", 3.0)], "g string, v double"), "v", "g").toPandas()
    a = got[got.g == "a"]
    bw = v.std(ddof=1) * 400 ** -0.2
    want = np.exp(-0.5 * ((a.x.to_numpy()[:, None] - v[None, :]) / bw) ** 2).sum(1) / (400 * bw * math.sqrt(2 * math.pi))
    assert np.abs(a.density.to_numpy() - want).max() <= 2e-4 / (bw * math.sqrt(2 * math.pi))
    assert (got.g == "b").sum() == 1000


def test_stream_keeps_earlier_weeks(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / x) for x in ("in", "out", "ckpt"))
    rows = lambda days: spark.createDataFrame([(1, i, d) for i, d in enumerate(days)], "listing_id long, id long, d string").select("listing_id", "id", F.to_date("d").alias("date"))
    schema = rows(["2024-01-01"]).schema
    want = {}
    for days in (["2024-01-01", "2024-01-03"], ["2024-02-05"], ["2024-02-07", "2024-02-26"]):
        rows(days).write.mode("append").parquet(src)
        RS.weekly_counts_stream(spark, src, schema, out, ckpt)
        table = spark.read.parquet(f"{out}/v{RS.newest_version(spark, out)}")
        got = {str(r["week_start"]): r["reviews"] for r in table.collect()}
        assert set(want) <= set(got)
        want = got
    assert want == {"2024-01-01": 2, "2024-02-05": 2, "2024-02-26": 1}


def test_layers_are_pruned(spark):
    from innsight.plans.lake import lake
    plan = lake(spark, "/root/testdata/sf0.001").gold.select("room_type").where("is_price_outlier")._jdf.queryExecution().executedPlan().toString()
    assert "parquet" in plan.lower() and "PushedFilters: [IsNotNull(is_price_outlier)" in plan and "ReadSchema: struct<room_type:string,is_price_outlier:boolean>" in plan
