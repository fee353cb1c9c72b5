"""Type inference, value profiles, key presence and the local density, held
against the reader's own inference, brute force and their plans."""

import collections
import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from innsight.operators import quality as Q
from innsight.operators import stats as S
from innsight.sources import files as FS


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


COLUMNS = {
    "whole": ["1", "-7", "+3", None], "wide": ["1", "3000000000", None, "2"], "real": ["1", "2.5", "1e3", ".5"],
    "late_bad": ["1", "2", "3", "x"], "day": ["2024-01-02", None, "2024-02-29", "1999-12-31"],
    "moment": ["2024-01-02", "2024-01-02 10:20:30", None, None], "flag": ["true", "False", "TRUE", None],
    "nothing": [None] * 4, "no_day": ["2024-02-30", "2024-01-01", None, None], "mixed": ["2024-01-01", "abc", None, "5"],
    "flag_or_number": ["true", "1", None, None], "blank": ["4", "", None, "5"], "odd name": ["a", "b", None, "c"], "dotted.name": ["1.0", "2", "NaN", None],
}


def test_inferred_types_equal_the_readers(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = list(zip(*COLUMNS.values()))
    df = spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in COLUMNS))
    FS.write_csv(df.coalesce(1), path)
    own = spark.read.option("header", True).option("inferSchema", True).option("escape", '"').csv(path)
    want = {f.name: f.dataType.simpleString() for f in own.schema.fields} | {"blank": "int"}
    text = FS.read_text_csv(spark, path)
    for parts in (text, text.repartition(4)):
        got = {r["column_name"]: r["data_type"] for r in FS.inferred_types(parts).collect()}
        assert got == want
    assert want["late_bad"] == "string" and want["nothing"] == "string" and want["moment"] == "timestamp" and want["no_day"] == "string"
    typed = FS.read_inferred_csv(spark, path)
    assert dict(typed.dtypes) == want and [r["wide"] for r in typed.collect()] == [1, 3000000000, None, 2]
    assert {r["data_type"] for r in FS.inferred_types(text.limit(0)).collect()} == {"string"}


def test_inference_is_one_scan(spark, tmp_path):
    path = str(tmp_path / "csv")
    FS.write_csv(spark.range(100).selectExpr("id", "id % 3 AS b"), path)
    plan = _plan(FS.inferred_types(FS.read_text_csv(spark, path)))
    assert plan.count("FileScan csv") == 1 and plan.count("Exchange") == 1


def test_inference_meets_values_with_one_expression(spark):
    def tests(columns):
        df = spark.range(3).selectExpr(*[f"string(id) AS c{i}" for i in range(columns)])
        return FS.inferred_types(df)._jdf.queryExecution().optimizedPlan().toString().count("RLIKE")

    assert tests(1) == tests(5) > 0


def test_inferred_types_of_odd_values(spark):
    want = {"+5": "int", "-0": "int", "7\n": "int", "3000000000": "bigint", "99999999999999999999": "double", ".5": "double", "1.": "double", "-1e5": "double", "1.0e-5": "double",
            "NaN": "double", "Infinity": "double", "-Infinity": "double", "nan": "string", "+Infinity": "string", "2025-09-28": "date", "2025-09-28\n": "date", "2025-13-01": "string",
            "2025-09-28 10:30": "timestamp", "2025-09-28T10:30:00Z": "timestamp", "2025-09-28 x": "string", "2025-09": "string", "TRUE": "boolean", "t": "string",
            " 5": "string", "$5": "string", "-": "string", ":": "string", "\u0665": "string", "": "string", None: "string"}
    df = spark.createDataFrame([tuple(want), (None,) * len(want)], ", ".join(f"c{i} string" for i in range(len(want))))
    got = FS.inferred_types(df).orderBy("position").collect()
    assert [r["data_type"] for r in got] == list(want.values()) and [r["column_name"] for r in got] == df.columns
    mixed = spark.createDataFrame([("1", "1", "2025-09-28", "1", "true"), ("3000000000", "1.5", "2025-09-28 10:30", "2025-09-28", "1")], "a string, b string, c string, d string, e string")
    assert [r["data_type"] for r in FS.inferred_types(mixed).orderBy("position").collect()] == ["bigint", "double", "timestamp", "string", "string"]


def test_value_profile_of_few_values(spark):
    n = 4000
    rows = [("hot" if i % 3 == 0 else f"v{i % 14}", f"v{i % 14}", f"v{i % 15}", f"v{i % 70}", str(i), None, "x" if i == 7 else None, "one" if i % 500 else str(i))
            for i in range(n)]
    names = ["fifteen_hot", "fourteen", "fifteen", "seventy", "many", "none", "single", "skewed"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names)).repartition(5)
    want = {}
    for j, c in enumerate(names):
        counts = collections.Counter(r[j] for r in rows if r[j] is not None)
        if 1 <= len(counts) <= 14:
            want |= {(c, v): k for v, k in counts.items()}
    out = Q.low_cardinality_values(df)
    assert {(r["column_name"], r["value"]): r["value_count"] for r in out.collect()} == want
    assert {c for c, _ in want} == {"fourteen", "single", "skewed"}
    plan = _plan(Q.low_cardinality_values(df))
    assert plan.count("Exchange") == 2 and "Expand" not in plan  # the repartition above and one row a task
    assert Q.low_cardinality_values(df.limit(0)).count() == 0 and Q.low_cardinality_values(spark.range(3)).count() == 0


def test_profile_drops_a_column_of_one_hot_and_many_rare_values(spark):
    df = spark.range(200_000).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("a"))
    assert Q.low_cardinality_values(df).count() == 0


def test_integrity_by_key_presence(spark):
    keys = lambda ks, name: spark.createDataFrame([(k,) for k in ks], f"{name} long")
    dims, reviews, calendar = [1, 2, 3, 3, None, 9], [1, 1, 3, 4, None, None] + [2] * 500, [1, 5, 5, None]
    got = {r["check_name"]: r["row_count"] for r in Q.referential_integrity(keys(dims, "id"), keys(reviews, "listing_id"), keys(calendar, "listing_id")).collect()}
    known = {k for k in dims if k is not None}
    assert got == {
        "reviews_orphan_rows": sum(k not in known for k in reviews), "calendar_orphan_rows": sum(k not in known for k in calendar),
        "listings_without_reviews": sum(k is None or k not in reviews for k in dims), "listings_without_calendar": sum(k is None or k not in calendar for k in dims),
        "listings_with_reviews": sum(k is not None and k in reviews for k in dims)}
    empty = keys([], "listing_id")
    assert {r["row_count"] for r in Q.referential_integrity(keys([], "id"), empty, empty).collect()} == {0}


def test_integrity_scans_each_layer_once(spark):
    from innsight.plans.lake import lake
    lk = lake(spark, "/root/testdata/sf0.001")
    plan = _plan(Q.referential_integrity(lk.listings, lk.reviews, lk.calendar))
    assert plan.split("Initial Plan")[0].count("FileScan") == 3


def test_density_with_an_outlier_and_groups_beyond_the_broadcast(spark, monkeypatch):
    rng = np.random.default_rng(4)
    v = np.r_[rng.normal(50, 5, 3000), 5000.0]
    df = spark.createDataFrame(pd.DataFrame({"g": ["a"] * 3001 + ["b"] * 2, "v": np.r_[v, 1.0, 1.0]}))
    bw = v.std(ddof=1) * 3001 ** -0.2
    peak = 1 / (bw * math.sqrt(2 * math.pi))
    for broadcast in (True, False):
        if not broadcast:
            monkeypatch.setattr(S, "_small", lambda d: (d, None))
        got = S.kde_by_group(df, "v", "g").toPandas().sort_values(["g", "x"])
        a = got[got.g == "a"]
        want = np.exp(-0.5 * ((a.x.to_numpy()[:, None] - v[None, :]) / bw) ** 2).sum(1) / (3001 * bw * math.sqrt(2 * math.pi))
        assert len(a) == 1000 and np.abs(a.density.to_numpy() - want).max() <= 2e-4 * peak
        assert np.allclose(got[got.g == "b"].density, 1 / (2 ** -0.2 * math.sqrt(2 * math.pi))) and (got.g == "b").sum() == 1000
    assert S.kde_by_group(df.limit(0), "v", "g").count() == 0
