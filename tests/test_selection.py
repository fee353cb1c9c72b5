"""Quantiles by sketch and selection: narrowing, misses, and what is
shuffled; duplicates without pair rows; bucketed layers."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from innsight.operators import duplicates as DUP
from innsight.operators import gold as G
from innsight.operators import ranking as R
from innsight.operators import silver as SV
from innsight.plans.lake import lake
from innsight.session import bucketed

SF001 = "/root/testdata/sf0.001"

PROBS = [0.0, 0.01, 0.25, 0.5, 0.99, 1.0]


@pytest.fixture(scope="module")
def values(spark):
    rng = random.Random(8)
    rows = [("hot", rng.lognormvariate(0, 2)) for _ in range(30_000)] + [("tied", float(rng.randrange(5))) for _ in range(9_000)]
    rows += [("few", float(i)) for i in range(7)] + [("none", None), (None, 1.0), ("few", float("nan"))]
    return spark.createDataFrame(rows, "g string, v double").repartition(8).cache()


def quantiles(values):
    by = {}
    for g, v in values.collect():
        if g is not None and v is not None and v == v:
            by.setdefault(g, []).append(v)
    return {g: [float(np.quantile(v, p)) for p in PROBS] for g, v in by.items()}


@pytest.mark.parametrize("how", ["plain", "narrowed", "missed", "tables"])
def test_quantiles_are_exact(values, monkeypatch, how):
    if how == "narrowed":
        monkeypatch.setattr(R, "SORTED", 500)
    if how == "missed":  # brackets far off the ranks
        monkeypatch.setattr(R, "MARGIN", -0.05)
    if how == "tables":
        monkeypatch.setattr(R, "SMALL", 1)
    got = {r[0]: list(r)[1:] for r in R.exact_quantiles(values, "v", PROBS, ["g"]).collect()}
    want = quantiles(values)
    assert got.keys() == want.keys()
    for g in want:
        assert got[g] == pytest.approx(want[g], rel=1e-12)


def test_the_second_scan_shuffles_only_brackets(spark, values):
    src = values.where("g is not null and v is not null and not isnan(v)").select(F.col("g").alias("_k0"), F.col("v").alias("_v"))
    t, rows = R._small(R._targets(src.groupBy("_k0").agg(*R._sketched(F.col("_v"))), [0.5], ["_k0"]))
    counts = R.selection_counts(src, t, ["_k0"])
    hot = [r for r in rows if r["_k0"] == "hot"][0]
    inside = src.where((F.col("_k0") == "hot") & F.col("_v").between(hot["_lo"], hot["_hi"])).count()
    assert 0 < inside <= R.WIDTH * 30_000 + 2
    assert counts.where("_k0 = 'hot' and _x is not null").count() <= inside
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_column_quantiles_of_several_columns(spark):
    df = spark.createDataFrame([(i, float(i % 7) if i % 3 else None, None) for i in range(1000)], "a long, b double, c double")
    got = {r["column_name"]: r for r in R.column_quantiles(df, ["a", "b", "c"], [0.25, 0.5], ["lo", "mid"], lambda c: [F.count(c).alias("n")]).collect()}
    b = [i % 7 for i in range(1000) if i % 3]
    assert got["a"]["mid"] == 499.5 and got["b"]["lo"] == np.quantile(b, 0.25) and got["b"]["mid"] == np.quantile(b, 0.5)
    assert got["c"]["mid"] is None and [got[c]["n"] for c in "abc"] == [1000, len(b), 0]


def test_duplicates_equal_the_pair_list(spark):
    rng = random.Random(5)
    rows = [(i, i % 4, -33.9 + rng.random() * 0.02, 18.4 + rng.random() * 0.02) for i in range(400)]
    rows += [(1000 + i, 9, 89.9999 + 0.00001 * (i % 3), rng.uniform(-180, 180)) for i in range(40)]  # the pole
    rows += [(2000 + i, 9, 0.0, 180.0 if i % 2 else -179.9999) for i in range(10)] + [(3000, 9, None, 1.0), (3001, None, 1.0, 1.0), (3002, 9, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "id long, host_id long, latitude double, longitude double")
    pairs = DUP.duplicate_pairs(df).collect()
    d = DUP.Duplicates(df)
    ids = {p["id_a"] for p in pairs} | {p["id_b"] for p in pairs}
    assert {r["id"] for r in d.flagged().collect()} == ids and 0 < len(ids) < 440
    per = {}
    for p in pairs:
        per[p["host_id"]] = per.get(p["host_id"], 0) + 1
    assert dict(d.per_host().collect()) == per
    assert tuple(d.summary().first()) == (len(pairs), len(ids), len(per))
    assert {r["id"] for r in d.flag(df).where("is_possible_duplicate").collect()} == ids
    assert tuple(DUP.Duplicates(df.limit(0)).summary().first()) == (0, 0, 0)


def test_many_listings_in_one_spot_make_no_pair_rows(spark):
    n = 100_000
    df = spark.range(n).select("id", F.lit(1).cast("long").alias("host_id"), (F.lit(-33.9) + F.rand(1) * 1e-5).alias("latitude"), (F.lit(18.4) + F.rand(2) * 1e-5).alias("longitude"))
    d = DUP.Duplicates(df)
    assert tuple(d.summary().first()) == (n * (n - 1) // 2, n, 1)
    assert d.pairs.count() == 0 and d.cubes.count() <= 8


def _listings(spark, n):
    return spark.range(n).selectExpr("id", "id % 50 AS host_id", "-33.9 + rand(3) * 0.05 AS latitude", "18.4 + rand(4) * 0.05 AS longitude")


def test_pairs_broadcast_no_listings(spark, tmp_path):
    _listings(spark, 2000).write.parquet(f"{tmp_path}/listings")
    df = spark.read.parquet(f"{tmp_path}/listings")
    plans = [DUP.duplicate_pairs(df), DUP.Duplicates(df).pairs]
    assert all("Broadcast" not in p._jdf.queryExecution().executedPlan().toString() for p in plans)


def test_listings_go_to_few_blocks(spark):
    df = _listings(spark, 20_000)
    near = DUP.duplicate_pairs(df)._jdf.queryExecution().optimizedPlan().toString()
    d = DUP.Duplicates(df)
    sent = DUP._reached(d.cubes, DUP._side(0.05), DUP._chord(0.05) * 1.001).count()
    assert "Generate" in near and d.cubes.count() <= sent < 3 * d.cubes.count()  # 14 to a cube before


def test_rare_categories_shuffle_no_row(spark):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 10 = 0 THEN null WHEN id < 8 THEN 'rare' WHEN id < 17 THEN 'under one percent' WHEN id < 28 THEN 'one percent' ELSE 'most' END AS c")
    out = SV.collapse_rare(df, "c", "g")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan.split("BroadcastExchange")[0] and "BroadcastHashJoin" in plan
    assert {(r["c"], r["g"]) for r in out.collect()} == {(None, None), ("rare", "Other"), ("under one percent", "Other"), ("one percent", "one percent"), ("most", "most")}


def test_the_gold_join_needs_no_exchange_of_its_inputs(spark):
    lk = lake(spark, SF001)
    tables = lk.listings, lk.review_summary, lk.calendar_summary, lk.neighbourhoods
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = G.build_master(*tables[:3], lk.neighbourhoods.hint("broadcast"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange hashpartitioning" not in plan and plan.count("Bucketed: true") == 3


def test_a_hot_key_is_not_bucketed(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    t = bucketed(df, "k")
    assert t.count() == 40_000
    assert "Bucketed: true" not in t.groupBy("k").count()._jdf.queryExecution().executedPlan().toString()
