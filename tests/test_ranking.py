import numpy as np
import pandas as pd
import pytest

from innsight.operators.ranking import attach_average_rank, exact_quantiles, running_sums


@pytest.mark.parametrize("buckets", [1, 3, 16])
def test_exact_quantiles_match_pandas(spark, buckets):
    rng = np.random.default_rng(7)
    g = rng.integers(0, 4, 2000)
    g[:900] = 0  # one hot group
    v = np.round(rng.lognormal(7, 1, 2000), 2)
    v[::37] = np.nan
    pdf = pd.DataFrame({"g": g, "v": v})
    df = spark.createDataFrame(pdf)
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = exact_quantiles(df, "v", probs, ["g"], buckets=buckets).toPandas().set_index("g").sort_index()
    for i, p in enumerate(probs):
        exp = pdf.groupby("g")["v"].quantile(p)
        np.testing.assert_allclose(got.iloc[:, i].values, exp.values, rtol=1e-12)
    glob = exact_quantiles(df, "v", [0.99], buckets=buckets).first()[0]
    assert glob == pytest.approx(pdf["v"].quantile(0.99), rel=1e-12)


def test_running_sums_and_ranks(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 3.0), (1, 5.0), (1, 1.0), (2, 2.0)], "g int, v double")
    r = attach_average_rank(df, "v", ["g"], descending=True, buckets=2).orderBy("g", "v").toPandas()
    assert r["avg_rank"].tolist() == [4.0, 3.0, 1.5, 1.5, 1.0]
    df2 = spark.createDataFrame([(float(i), 1) for i in range(100)], "v double, n int")
    rs = running_sums(df2, "v", ["n"], buckets=7).orderBy("v").toPandas()
    assert rs["cum_n"].tolist() == list(range(1, 101))
