"""Committed loads and their streams: killed and repeated loads, out-of-order
and replayed batches, late rows."""

import datetime as dt

import pytest

from innsight.streaming import incremental as INC
from innsight.streaming import loads as L


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, day date, v string")


def day(i):
    return dt.date(2025, 1, 1) + dt.timedelta(days=i)


def test_a_load_that_dies_before_its_commit_neither_loses_nor_doubles(spark, tmp_path, monkeypatch):
    t = L.CommittedTable(spark, str(tmp_path / "facts"))
    a, b = frame(spark, [(1, day(1), "a"), (2, day(2), "b")]), frame(spark, [(3, day(3), "c")])
    assert t.mark() is None and t.read(a.schema).count() == 0 and t.newer(a, "day").count() == 2
    assert t.append(a, "l1", ["v"], "day")
    with monkeypatch.context() as m:
        m.setattr(t, "_commit", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            t.append(b, "l2", ["v"], "day")
    assert t.read(a.schema).count() == 2 and t.mark() == "2025-01-03"
    assert t.append(b, "l2", ["v"], "day") and not t.append(b, "l2", ["v"], "day") and not t.append(a, "l1", ["v"], "day")
    assert sorted(r.id for r in t.read(a.schema).collect()) == [1, 2, 3]
    assert t.mark() == "2025-01-04" and t.newer(frame(spark, [(4, day(3), "d"), (5, day(4), "e")]), "day").first().id == 5


def test_two_writers_of_one_version(spark, tmp_path):
    t = L.CommittedTable(spark, str(tmp_path / "facts"))
    before = t.manifest()
    t.append(frame(spark, [(1, day(1), "a")]), "l1")
    with pytest.raises(RuntimeError):
        t._commit(before, "l2", {}, None)


@pytest.mark.parametrize("buckets", [1, 5])
def test_streamed_upsert_equals_the_batch_upsert(spark, tmp_path, buckets):
    batches = [[(1, day(5), "new"), (2, day(1), "x"), (2, day(2), "y")], [(1, day(3), "old"), (3, day(1), None), (None, day(1), "n")], [(2, day(9), "z"), (4, None, "w"), (1, day(5), "tie")]]
    src, out, ckpt = (str(tmp_path / n) for n in ("src", "out", "ckpt"))
    t = L.CommittedTable(spark, out)
    schema = frame(spark, []).schema
    for i, rows in enumerate(batches):
        frame(spark, rows).coalesce(1).write.mode("append").parquet(src)
        progress = L.upsert_stream(spark.readStream.schema(schema).parquet(src), t, ckpt, "id", "day", buckets)
        assert sum(p["numInputRows"] for p in progress) == len(rows)
        assert not t.upsert(frame(spark, rows), f"batch-{i}", "id", "day", buckets)  # replayed
    everything = frame(spark, [r for b in batches for r in b])
    want = INC.upsert(frame(spark, []), everything, "id", "day")
    plain = lambda df: sorted(map(tuple, df.select("id", "day", "v").collect()), key=repr)
    assert plain(t.read(schema)) == plain(want)
    assert len(list((tmp_path / "out" / "data").iterdir())) <= 3  # superseded folders are gone


def test_rows_in_are_rows_counted_and_rows_set_aside(spark, tmp_path):
    batches = [[(i, day(i), "a") for i in range(30)], [(100, day(2), "late"), (101, day(29), "in time"), (102, None, "no date"), (103, day(60), "far")], [(104, day(29), "late now"), (105, day(58), "in time")]]
    src, ckpt = str(tmp_path / "src"), str(tmp_path / "ckpt")
    counts, late = L.CommittedTable(spark, str(tmp_path / "c")), L.CommittedTable(spark, str(tmp_path / "l"))
    schema = frame(spark, []).schema
    for i, rows in enumerate(batches):
        frame(spark, rows).coalesce(1).write.mode("append").parquet(src)
        progress = L.counts_with_late_rows(spark.readStream.schema(schema).parquet(src), "day", L.monday_week, 7, counts, late, ckpt)
        counted = sum(r["rows"] for r in counts.read(L.COUNTS).where(f"batch = {i}").collect())
        aside = late.read("id long, day date, v string, batch long").where(f"batch = {i}").count()
        assert sum(p["numInputRows"] for p in progress) == len(rows) == counted + aside
    assert sorted(r.v for r in late.read("id long, day date, v string, batch long").collect()) == ["late", "late now", "no date"]
