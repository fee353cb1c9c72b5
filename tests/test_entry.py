"""Driver contract and oracle agreement on the smallest tables (sf0.001)."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from innsight.sources.fixtures import TABLES

SF = "/root/testdata/sf0.001"
SAMPLE = ["job1_silver_listings", "job4_gold_master", "q1_top_neighbourhoods", "q4_weekend_availability",
          "joi5_duplicate_pairs", "dq3_low_cardinality", "agg18_box_by_room_type", "win3_win4_lorenz_gini",
          "geo3_hexbin_median_price", "sta4_mann_whitney_h1", "sta6_anova_h4", "str4_change_capture",
          "str6_weekly_review_stream"]


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if hasattr(v, "date") and hasattr(v, "hour"):
        return v.date().isoformat()
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(x.item() if hasattr(x, "item") else x) for x in r)
                         for r in pdf[cols].astype(object).where(pdf[cols].notna(), None).itertuples(index=False)),
                        key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert 0 < len(rows) <= 10
    assert df.columns == ["neighbourhood_cleansed", "median_price", "listing_count"]


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_oracle(spark, con, name):
    s = E.queries()[name](spark, SF).toPandas()
    d = con.execute(E.oracle_sql()[name]).df()
    sc, sr = _rows(s)
    dc, dr = _rows(d)
    assert sc == dc
    assert sr == dr
