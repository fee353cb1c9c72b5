"""Hand-written edge cases (FIXTURES.md section 5) for the column functions."""

import datetime as dt

from pyspark.sql import functions as F

from innsight.functions import cleaning as C
from innsight.functions import derived as D


def _one(spark, rows, schema, col):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_money(spark):
    out = _one(spark, [("$2,315.00",), ("nan",), ("",), ("x",), (None,)], "p string", C.money_to_double("p"))
    assert out == [2315.0, None, None, None, None]


def test_first_number(spark):
    rows = [(None, 2.0), ("Half-bath", 1.0), ("1.5 baths", None)]
    assert _one(spark, rows, "t string, b double", C.first_number_or("t", "b")) == [2.0, None, 1.5]


def test_lists(spark):
    rows = [(None,), ("[bad",), ("['email', 'phone']",), ("['a', None]",)]
    out = _one(spark, rows, "v string", C.literal_string_list("v"))
    assert out == [[], [], ["email", "phone"], ["a", None]]
    assert _one(spark, [('["Wifi", "Pool"]',), (None,)], "v string", C.list_length(C.json_string_list("v"))) == [2, 0]


def test_round_half_even_and_caps(spark):
    assert _one(spark, [(0.125,)], "v double", C.round_half_even("v", 2)) == [0.12]
    assert _one(spark, [(5.0,), (None,)], "v double", C.cap_upper("v", 3.0)) == [3.0, None]
    assert _one(spark, [(0.01,), (None,)], "v double", C.floor_lower("v", 0.1)) == [0.1, None]


def test_buckets_right_closed(spark):
    lab, order = D.right_closed_bucket("v", [0, 1, 2, 5, 10, 500], ["a", "b", "c", "d", "e"])
    out = _one(spark, [(0,), (1,), (2,), (5,), (501,)], "v int", lab)
    assert out == [None, "a", "b", "c", None]


def test_min_gt_max_keeps_null(spark):
    df = spark.createDataFrame([(5.0, None), (2.0, 1.0)], "mn double, mx double")
    kept = df.where(~C.flag_gt("mn", F.col("mx"))).collect()
    assert [(r.mn, r.mx) for r in kept] == [(5.0, None)]


def test_day_of_week_and_weekend(spark):
    rows = [(dt.date(2025, 9, 27),), (dt.date(2025, 9, 28),), (dt.date(2025, 9, 29),)]
    assert _one(spark, rows, "d date", D.day_of_week_sun0("d")) == [6, 0, 1]
    assert _one(spark, rows, "d date", D.is_weekend("d")) == [True, True, False]


def test_host_type_and_effect_words(spark):
    assert _one(spark, [(1,), (5,), (6,), (None,)], "n int", D.host_type("n")) == [
        "Casual (1 listing)", "Semi-Pro (2–5)", "Commercial (6+)", "Commercial (6+)"]
    assert _one(spark, [(0.1,), (-0.3,), (0.6,), (0.9,)], "d double", D.effect_size_words("d")) == [
        "Negligible", "Small", "Medium", "Large"]
