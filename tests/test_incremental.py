"""Incremental loading, sinks and the schema check."""

import datetime as dt

from innsight.operators import warehouse as W
from innsight.streaming import incremental as INC


def test_upsert_keeps_rows_and_replaces_keys(spark):
    cur = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id long, v string")
    batch = spark.createDataFrame([(2, "B"), (4, "D")], "id long, v string")
    out = dict(INC.upsert(cur, batch).collect())
    assert out == {1: "a", 2: "B", 3: "c", 4: "D"}


def test_change_capture_labels(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id long, v string")
    new = spark.createDataFrame([(2, "b"), (3, "x"), (4, "d")], "id long, v string")
    out = dict(INC.change_capture(old, new).collect())
    assert out == {1: "delete", 2: "unchanged", 3: "update", 4: "insert"}


def test_high_water_mark(spark):
    df = spark.createDataFrame([(1, "2025-09-20"), (2, "2025-09-27")], "id long, d string")
    mark = INC.high_water_mark(df.where("d <= '2025-09-24'"), "d")
    assert [r.id for r in INC.newer_than(df, "d", mark).collect()] == [2]
    assert INC.newer_than(df, "d", None).count() == 2


def test_dim_date_and_schema_check(spark):
    cal = spark.createDataFrame([(dt.date(2025, 9, 27), True), (dt.date(2025, 9, 29), None)],
                                "date date, available_bool boolean")
    d = W.dim_date(cal)
    rows = {r.date: (r.day_of_week, r.is_weekend) for r in d.collect()}
    assert rows == {dt.date(2025, 9, 27): (6, True), dt.date(2025, 9, 29): (1, False)}
    assert all(r.ok for r in W.schema_check(d).collect())


def test_partitioned_append_twice(spark, tmp_path):
    df = spark.createDataFrame([(1, 2025, 9), (2, 2025, 10)], "id long, year int, month int")
    path = str(tmp_path / "facts")
    INC.append_partitioned(df, path, ["year", "month"])
    INC.append_partitioned(df, path, ["year", "month"])
    back = spark.read.parquet(path)
    assert back.count() == 4 and set(back.columns) == {"id", "year", "month"}
