"""The pipeline run: one write a layer, counts that the layers bear out."""

from __future__ import annotations

from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from innsight.plans.lake import Lake
from innsight.plans.medallion import run_pipeline
from innsight.session import LONGEST_COMPILED, materialize

SF001 = "/root/testdata/sf0.001"


def test_a_run_counts_what_it_wrote_and_can_be_repeated(spark, tmp_path):
    root = str(tmp_path / "run")
    raw = Lake(spark, SF001)
    for i in (1, 2):
        log = {r["stage"]: r for r in run_pipeline(spark, SF001, root).collect()}
        read = lambda name: spark.read.parquet(f"{root}/{name}")
        assert [r["status"] for r in log.values()] == ["success"] * 3
        assert log["silver"]["rows_in"] == raw.listings_raw.count() + raw.calendar_raw.count() + raw.reviews_raw.count()
        silver = read("silver/listings").count() + read("silver/calendar").count() + read("silver/reviews").where(~F.col("is_low_quality")).count()
        assert log["silver"]["rows_out"] == silver
        assert log["gold"]["rows_in"] == read("silver/listings").count() and log["gold"]["rows_out"] == read("gold/listing_master").count()
        assert read("gold/neighbourhood_aggregates").count() == read("gold/listing_master").select("neighbourhood_cleansed").distinct().count()
        assert read("pipeline_runs").count() == 3 * i


def test_layers_are_read_where_they_were_written(spark, tmp_path):
    lk = Lake(spark, SF001, str(tmp_path / "lake"))
    files = {p.split("/lake/")[1].rsplit("/", 1)[0] for df in (lk.listings, lk.calendar, lk.reviews, lk.neighbourhoods, lk.gold) for p in df.inputFiles()}
    assert files == {"silver/listings", "silver/calendar", "silver/reviews", "gold/neighbourhood_aggregates", "gold/listing_master"}


def test_a_failed_stage_ends_the_run(spark, tmp_path):
    (tmp_path / "run").mkdir()
    (tmp_path / "run" / "gold").write_text("a file where a folder should be")
    log = [(r["stage"], r["status"].split(":")[0]) for r in run_pipeline(spark, SF001, str(tmp_path / "run")).collect()]
    assert log == [("silver", "success"), ("gold", "failed")]


def test_layers_are_written_by_methods_that_the_jvm_compiles(spark, monkeypatch):
    limit, seen = "spark.sql.codegen.hugeMethodLimit", []
    assert spark.conf.get(limit, None) is None
    for name in ("parquet", "saveAsTable"):
        def write(self, *a, own=getattr(DataFrameWriter, name), **k):
            seen.append(spark.conf.get(limit, None))
            return own(self, *a, **k)
        monkeypatch.setattr(DataFrameWriter, name, write)
    lk = Lake(spark, SF001)
    assert lk.gold.count() == lk.listings.count()
    assert len(seen) > 5 and {int(x) for x in seen} == {LONGEST_COMPILED}
    assert spark.conf.get(limit, None) is None
    spark.conf.set(limit, "20000")
    try:
        materialize(spark.range(3))
        assert seen[-1] == spark.conf.get(limit) == "20000"
    finally:
        spark.conf.unset(limit)
