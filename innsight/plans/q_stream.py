"""Registered queries: sources, sinks, pipeline run, incremental loading and
the review stream (SRC1-SRC3, SRC9-SRC13, STR1-STR6)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import warehouse as W
from ..session import scratch_path
from ..sources import files as FS
from ..streaming import incremental as INC
from ..streaming.loads import COUNTS, CommittedTable, counts_with_late_rows, monday_week, upsert_stream
from ..streaming.reviews_stream import weekly_review_counts
from . import oracle as O
from .registry import register

MARK_CUTOFF = "2025-09-24"  # the stored table holds scrapes up to this day


def _scratch(lk, name):
    return scratch_path(lk.spark, f"{name}-{uuid.uuid4().hex}")


@register("src1_csv_roundtrip", O.with_ctes("SELECT * FROM listings_raw"))
def src1_csv_roundtrip(lk):
    """SRC1: raw listings written as CSV and scanned back with an explicit
    schema (header, multi-line, quote escape) -- no inference."""
    path = _scratch(lk, "listings-csv")
    FS.write_csv(lk.listings_raw, path)
    return FS.read_csv(lk.spark, path, FS.raw_schema(lk.listings_raw))


_RAW = ("listings_raw", "reviews_raw", "calendar_raw")


def _types_sql() -> str:
    """A column's narrowest type by the share of its values that fit, each
    value rendered as text."""
    number = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    fits = {"int": "regexp_full_match(v, '[+-]?[0-9]+') AND TRY_CAST(v AS INTEGER) IS NOT NULL",
            "bigint": "regexp_full_match(v, '[+-]?[0-9]+') AND TRY_CAST(v AS BIGINT) IS NOT NULL",
            "double": f"regexp_full_match(v, '{number}') OR v IN ('NaN', 'Infinity', '-Infinity')",
            "date": "regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND TRY_CAST(v AS DATE) IS NOT NULL",
            "timestamp": "regexp_matches(v, '^[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}|$)') AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL",
            "boolean": "lower(v) IN ('true', 'false')"}
    rungs = " ".join(f"WHEN count(*) FILTER (WHERE {test}) = count(v) THEN '{t}'" for t, test in fits.items())
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, column_name, CASE WHEN count(v) = 0 THEN 'string' {rungs} ELSE 'string' END AS data_type "
        f"FROM (SELECT column_name, nullif(v, '') AS v FROM (SELECT CAST(COLUMNS(*) AS VARCHAR) FROM {t}) x UNPIVOT INCLUDE NULLS (v FOR column_name IN (*))) y "
        f"GROUP BY column_name"
        for t in _RAW)


@register("src1_inferred_types", O.with_ctes(_types_sql()))
def src1_inferred_types(lk):
    """SRC1: the types of the raw CSV files' columns, found from their text."""
    out = None
    for t in _RAW:
        path = _scratch(lk, t + "-text")
        FS.write_csv(getattr(lk, t), path)
        part = FS.inferred_types(FS.read_text_csv(lk.spark, path)).select(F.lit(t).alias("table_name"), "column_name", "data_type")
        out = part if out is None else out.unionByName(part)
    return out


@register("src2_csv_projection", O.with_ctes(
    "SELECT listing_id, TRY_CAST(date AS DATE) AS date, available FROM calendar_raw"))
def src2_csv_projection(lk):
    """SRC2: CSV scan of three columns with date parsing."""
    path = _scratch(lk, "calendar-csv")
    FS.write_csv(lk.calendar_raw, path)
    return FS.read_csv(lk.spark, path, FS.raw_schema(lk.calendar_raw), ["listing_id", "date", "available"], ["date"], multi_line=False)


@register("src3_land_cities", O.with_ctes(
    "SELECT CASE WHEN date < '1998-01-01' THEN 'Cape Town' ELSE 'Stellenbosch' END AS city, count(*) AS reviews "
    "FROM reviews_raw GROUP BY 1"))
def src3_land_cities(lk):
    """SRC3: land gzip CSVs per city from a config table; a missing source is
    isolated (reported, skipped) and the rest go on."""
    root = _scratch(lk, "landing")
    r = lk.reviews_raw
    FS.write_csv(r.where(F.col("date") < "1998-01-01"), f"{root}/cape_town", compression="gzip")
    FS.write_csv(r.where(F.coalesce(F.col("date") >= "1998-01-01", F.lit(True))), f"{root}/stellenbosch", compression="gzip")
    config = [("Cape Town", f"{root}/cape_town"), ("Stellenbosch", f"{root}/stellenbosch"),
              ("Paarl", f"{root}/paarl_not_landed")]
    df, _ = FS.land_sources(lk.spark, config, FS.raw_schema(r), f"{root}/landed")
    return df.groupBy("city").agg(F.count(F.lit(1)).alias("reviews"))


@register("src10_named_sql_query", O.rounded(
    "SELECT host_is_superhost, avg(review_scores_rating) AS avg_rating, count(*) AS listing_count "
    "FROM gold GROUP BY host_is_superhost", ["avg_rating"]))
def src10_named_sql_query(lk):
    """SRC9 + SRC10: warehouse frames registered as views, a named SQL query
    run by ``spark.sql`` (Q3 text)."""
    return W.run_analysis(lk.spark, lk.warehouse())["q3"]


@register("src10_named_sql_q1", O.rounded(
    "SELECT neighbourhood_cleansed, any_value(median_price) AS median_price, any_value(listing_count) AS listing_count FROM gold "
    "GROUP BY 1 ORDER BY 2 DESC NULLS LAST, 1 LIMIT 10", ["median_price"]))
def src10_named_sql_q1(lk):
    """SRC10: Q1 by its SQL text."""
    return W.run_analysis(lk.spark, lk.warehouse())["q1"]


@register("src10_named_sql_q2", O.rounded(
    "SELECT room_type, avg(occupancy_rate_upper_bound) AS avg_occupancy_upper_bound FROM gold GROUP BY 1", ["avg_occupancy_upper_bound"]))
def src10_named_sql_q2(lk):
    """SRC10: Q2 by its SQL text."""
    return W.run_analysis(lk.spark, lk.warehouse())["q2"]


@register("src10_named_sql_q4", O.rounded(
    "SELECT isodow(date) >= 6 AS is_weekend, count(*) FILTER (available_bool) / count(*) AS avg_availability_rate "
    "FROM calendar_silver WHERE date IS NOT NULL GROUP BY 1", ["avg_availability_rate"]))
def src10_named_sql_q4(lk):
    """SRC10: Q4 by its SQL text."""
    return W.run_analysis(lk.spark, lk.warehouse())["q4"]


@register("src8_saved_tables", O.with_ctes(
    "SELECT 'dim_listing' AS name, count(*) AS rows FROM gold UNION ALL SELECT 'fact_calendar', count(*) FROM calendar_silver "
    "UNION ALL SELECT 'fact_review', count(*) FROM reviews_silver UNION ALL SELECT 'dim_date', count(*) FROM dim_date"))
def src8_saved_tables(lk):
    """SRC8: the warehouse saved as tables and counted from there."""
    tables, db = lk.warehouse(), f"innsight_{uuid.uuid4().hex}"
    lk.spark.sql(f"CREATE DATABASE {db} LOCATION '{_scratch(lk, db)}'")
    W.save_tables(tables, db)
    counts = [lk.spark.table(f"{db}.{k}").agg(F.lit(k).alias("name"), F.count(F.lit(1)).alias("rows")) for k in tables]
    out = counts[0]
    for c in counts[1:]:
        out = out.union(c)
    return out


@register("src13_pipeline_run", O.with_ctes(
    "SELECT 'silver' AS stage, 'success' AS status, "
    "(SELECT count(*) FROM listings_raw) + (SELECT count(*) FROM calendar_raw) + (SELECT count(*) FROM reviews_raw) AS rows_in, "
    "(SELECT count(*) FROM listings_silver) + (SELECT count(*) FROM calendar_silver) + (SELECT count(*) FROM reviews_silver) AS rows_out "
    "UNION ALL SELECT 'gold', 'success', (SELECT count(*) FROM listings_silver), (SELECT count(*) FROM gold) "
    "UNION ALL SELECT 'warehouse', 'success', NULL, (SELECT count(*) FROM gold) + (SELECT count(*) FROM calendar_silver) "
    "+ (SELECT count(*) FROM reviews_silver) + (SELECT count(*) FROM dim_date)"))
def src13_pipeline_run(lk):
    """SRC11 + SRC13 (+ SRC7): full run into a fresh folder; the run log
    without its wall-clock columns."""
    from .medallion import run_pipeline
    runs = run_pipeline(lk.spark, lk.sf_dir, _scratch(lk, "pipeline"))
    return runs.select("stage", "status", "rows_in", "rows_out")


@register("str1_high_water_mark", O.with_ctes(
    "SELECT id, last_scraped FROM listings_raw WHERE last_scraped > "
    f"(SELECT max(last_scraped) FROM listings_raw WHERE last_scraped <= '{MARK_CUTOFF}')"))
def str1_high_water_mark(lk):
    """STR1: only rows newer than the high-water mark that the last load committed."""
    rows = lk.listings_raw.select("id", "last_scraped")
    loaded = CommittedTable(lk.spark, _scratch(lk, "scrapes"))
    loaded.append(rows.where(F.col("last_scraped") <= MARK_CUTOFF), "first", mark_col="last_scraped")
    return loaded.newer(rows, "last_scraped")


_STR2 = O.with_ctes(
    "SELECT id, last_scraped, availability_365 FROM listings_raw WHERE last_scraped <= '2025-09-26' "
    "AND id NOT IN (SELECT id FROM listings_raw WHERE last_scraped >= '2025-09-24') "
    "UNION ALL SELECT id, last_scraped, availability_365 + 1 FROM listings_raw WHERE last_scraped >= '2025-09-24'")


@register("str2_upsert", _STR2)
def str2_upsert(lk):
    """STR2: upsert keyed on id (anti-join + union)."""
    r = lk.listings_raw.select("id", "last_scraped", "availability_365")
    current = r.where(F.col("last_scraped") <= "2025-09-26")
    batch = r.where(F.col("last_scraped") >= "2025-09-24").withColumn("availability_365", F.col("availability_365") + 1)
    return INC.upsert(current, batch)


@register("str2_upsert_stream", _STR2)
def str2_upsert_stream(lk):
    """STR2 in a stream: the newer snapshot arrives first, then the older one."""
    r = lk.listings_raw.select("id", "last_scraped", "availability_365")
    old = r.where(F.col("last_scraped") <= "2025-09-26").withColumn("seq", F.lit(1))
    new = r.where(F.col("last_scraped") >= "2025-09-24").withColumn("availability_365", F.col("availability_365") + 1).withColumn("seq", F.lit(2))
    run = _scratch(lk, "upserts")
    table = CommittedTable(lk.spark, f"{run}/table")
    for part in (new, old):
        part.write.mode("append").parquet(f"{run}/source")
        upsert_stream(lk.spark.readStream.schema(part.schema).parquet(f"{run}/source"), table, f"{run}/checkpoint", "id", "seq")
    return table.read(old.schema).drop("seq")


@register("str3_append_partitioned", O.with_ctes(
    "SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, count(*) AS days "
    "FROM calendar_silver GROUP BY 1, 2"))
def str3_append_partitioned(lk):
    """STR3 + SRC12: append-only calendar facts partitioned by city, year,
    month, as a committed load; read back with partition discovery."""
    path = _scratch(lk, "calendar-facts")
    facts = lk.calendar.withColumn("city", F.lit("Cape Town")).withColumn("year", F.year("date")).withColumn(
        "month", F.month("date"))
    table = CommittedTable(lk.spark, path)
    for _ in range(2):  # a load that is run again adds nothing
        table.append(facts, "calendar", ["city", "year", "month"])
    back = table.read(facts.schema)
    return back.groupBy(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month")).agg(
        F.count(F.lit(1)).alias("days"))


_CDC_COLS = ["price", "availability_365", "room_type"]


@register("str4_change_capture", O.with_ctes(
    "SELECT coalesce(o.id, n.id) AS id, CASE WHEN o.id IS NULL THEN 'insert' WHEN n.id IS NULL THEN 'delete' "
    "WHEN o.price IS NOT DISTINCT FROM n.price AND o.availability_365 IS NOT DISTINCT FROM n.availability_365 "
    "AND o.room_type IS NOT DISTINCT FROM n.room_type THEN 'unchanged' ELSE 'update' END AS change "
    "FROM (SELECT id, price, availability_365, room_type FROM listings_raw WHERE last_scraped <= '2025-09-26') o "
    "FULL OUTER JOIN (SELECT id, price, CASE WHEN number_of_reviews > 30 THEN availability_365 + 1 "
    "ELSE availability_365 END AS availability_365, room_type FROM listings_raw WHERE last_scraped >= '2025-09-22') n "
    "ON o.id = n.id"))
def str4_change_capture(lk):
    """STR4: insert / update / unchanged / delete between two snapshots by an
    MD5 row hash and a full outer join."""
    r = lk.listings_raw
    old = r.where(F.col("last_scraped") <= "2025-09-26").select("id", *_CDC_COLS)
    new = (r.where(F.col("last_scraped") >= "2025-09-22")
           .withColumn("availability_365", F.when(F.col("number_of_reviews") > 30, F.col("availability_365") + 1)
                       .otherwise(F.col("availability_365"))).select("id", *_CDC_COLS))
    return INC.change_capture(old, new, "id", _CDC_COLS)


@register("str5_city_metrics", O.rounded(
    "SELECT r_name AS city, count(*) AS listings, avg(price_clean) AS mean_price, "
    "quantile_cont(price_clean, 0.5) AS median_price FROM listings_silver l "
    "JOIN nation n ON lower(n.n_name) = lower(l.neighbourhood_cleansed) JOIN region ON r_regionkey = n_regionkey "
    "GROUP BY r_name", ["mean_price", "median_price"]))
def str5_city_metrics(lk):
    """STR5: many markets through the same job (market = region of the
    neighbourhood), grouped by the city column."""
    from ..sources.fixtures import table
    n = table(lk.spark, lk.sf_dir, "nation").select(F.lower("n_name").alias("_nb"), "n_regionkey")
    r = table(lk.spark, lk.sf_dir, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("city"))
    df = (lk.listings.drop("city").withColumn("_nb", F.lower("neighbourhood_cleansed")).join(n, "_nb").join(r, "n_regionkey"))
    return INC.city_metrics(df)


@register("str6_weekly_review_stream", O.with_ctes(
    "SELECT CAST(date_trunc('week', date) AS DATE) AS week_start, CAST(date_trunc('week', date) AS DATE) + 6 AS week_end, "
    "count(*) AS reviews FROM reviews_silver WHERE date IS NOT NULL GROUP BY 1, 2"))
def str6_weekly_review_stream(lk):
    """STR6: Structured Streaming weekly counts with a watermark."""
    return weekly_review_counts(lk.reviews.where(F.col("date").isNotNull()))


@register("str6_late_rows", O.with_ctes(
    "SELECT batch, count(*) AS rows_in, count(*) FILTER (NOT late) AS counted, count(*) FILTER (late) AS late FROM ("
    "SELECT batch, batch = 2 AND week_end < (SELECT max(date) FROM reviews_silver WHERE id % 20 <> 1) - 7 AS late FROM ("
    "SELECT CAST(CASE WHEN id % 20 = 1 THEN 2 WHEN date < DATE '1995-07-01' THEN 0 ELSE 1 END AS BIGINT) AS batch, "
    "CAST(date_trunc('week', date) AS DATE) + 6 AS week_end FROM reviews_silver WHERE date IS NOT NULL) a) b GROUP BY batch"))
def str6_late_rows(lk):
    """STR6: reviews in three arrivals, the last one of stragglers; rows in by
    the stream's progress, counted by week, and set aside as late."""
    r = lk.reviews.where(F.col("date").isNotNull()).select("listing_id", "id", "date")
    straggler = F.col("id") % 20 == 1
    run = _scratch(lk, "late-reviews")
    counts, late = CommittedTable(lk.spark, f"{run}/counts"), CommittedTable(lk.spark, f"{run}/late")
    seen = []
    for part in (r.where(~straggler & (F.col("date") < "1995-07-01")), r.where(~straggler & (F.col("date") >= "1995-07-01")), r.where(straggler)):
        part.write.mode("append").parquet(f"{run}/source")
        stream = lk.spark.readStream.schema(r.schema).parquet(f"{run}/source")
        seen += counts_with_late_rows(stream, "date", monday_week, 7, counts, late, f"{run}/checkpoint")
    rows_in = lk.spark.createDataFrame([(p["batchId"], p["numInputRows"]) for p in seen], "batch long, rows_in long")
    counted = counts.read(COUNTS).groupBy("batch").agg(F.sum("rows").alias("counted"))
    aside = late.read(r.schema.add("batch", "long")).groupBy("batch").agg(F.count("*").alias("late"))
    out = rows_in.join(counted, "batch", "left").join(aside, "batch", "left")
    return out.select("batch", "rows_in", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("counted", "late")])
