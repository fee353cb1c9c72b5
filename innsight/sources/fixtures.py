"""Raw (Bronze) rental tables derived from the driver's parquet tables.

The driver ships TPC-H-like tables, not rental data.  These views reshape them
into the raw listing / calendar / review / neighbourhood shapes the cleaning
jobs expect, with messy text (money strings, percent strings, t/f flags, JSON
and list literals, bad dates, nulls) injected by deterministic rules.

Every column is one SQL expression string that runs unchanged on Spark and on
DuckDB, so the oracle SQL (``plans/oracle.py``) builds byte-identical inputs.
The Spark side joins with the DataFrame API so the optimizer sees plain
equi-joins (dimension tables are small and get broadcast by AQE when their
runtime size is under the threshold; nothing is forced).

Roles: listing = order, host = customer, neighbourhood = nation name,
room type = order priority, review / calendar day = lineitem.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
          "lineitem", "events", "documents", "embeddings", "pages",
          "benchmark", "labels", "conversations")

# The rental-domain constants the results depend on.
SCRAPE_DATE = "2025-09-28"
CITY_NAME = "Cape Town"

_PRICE = ("CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE concat('$', "
          "cast(cast(floor(round(o_totalprice * 100) / 100000) AS bigint) AS string), ',', "
          "lpad(cast(cast(floor(round(o_totalprice * 100) / 100) AS bigint) % 1000 AS string), 3, '0'), '.', "
          "lpad(cast(cast(round(o_totalprice * 100) AS bigint) % 100 AS string), 2, '0')) END")

# integer arithmetic first, then one double division: bit-identical on both engines
_RATING = "CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE cast(300 + o_orderkey % 201 AS double) / 100 END"


def _sub_score(k: int, m: int) -> str:
    # correlated with the overall rating, different noise per sub-score
    return (f"CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE "
            f"cast(300 + o_orderkey % 201 - (o_orderkey * {k}) % {m} AS double) / 100 END")


# (column, SQL expression) in output order.  Same text on both engines.
LISTINGS_COLUMNS: list[tuple[str, str]] = [
    ("id", "o_orderkey"),
    ("host_id", "o_custkey"),
    ("host_since", "cast(date '2009-01-01' + cast((o_custkey * 37) % 6000 AS integer) AS string)"),
    ("last_scraped", "cast(date '2025-09-20' + cast(o_orderkey % 9 AS integer) AS string)"),
    ("price", _PRICE),
    ("room_type", "o_orderpriority"),
    ("property_type",
     "CASE WHEN o_orderkey % 211 = 0 THEN 'Treehouse' WHEN o_orderkey % 151 = 0 THEN 'Boat' "
     "WHEN o_orderkey % 127 = 0 THEN 'Castle' WHEN o_orderkey % 8 = 7 THEN NULL "
     "WHEN o_orderkey % 4 = 0 THEN 'Entire rental unit' WHEN o_orderkey % 4 = 1 THEN 'Entire home' "
     "WHEN o_orderkey % 4 = 2 THEN 'Private room in home' ELSE 'Entire guesthouse' END"),
    ("host_is_superhost", "CASE o_orderstatus WHEN 'F' THEN 't' WHEN 'O' THEN 'f' END"),
    ("host_has_profile_pic", "CASE WHEN o_orderkey % 50 = 0 THEN 'f' ELSE 't' END"),
    ("host_identity_verified", "CASE o_orderkey % 7 WHEN 0 THEN 'f' WHEN 1 THEN NULL ELSE 't' END"),
    ("instant_bookable", "CASE WHEN o_orderkey % 2 = 0 THEN 't' ELSE 'f' END"),
    ("neighbourhood_cleansed", "concat(' ', lower(n_name), ' ')"),
    ("neighbourhood_group_cleansed", "cast(NULL AS string)"),
    ("host_neighbourhood", "cast(NULL AS string)"),
    ("license", "cast(NULL AS string)"),
    ("calendar_updated", "cast(NULL AS string)"),
    ("bathrooms_text",
     "CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'Half-bath' WHEN 2 THEN '1.5 baths' "
     "WHEN 3 THEN '2 shared baths' ELSE '1 bath' END"),
    ("bathrooms", "CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE cast(o_orderkey % 4 AS double) END"),
    ("amenities",
     "CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN '[bad' "
     "WHEN o_orderkey % 2 = 0 THEN '[\"Wifi\", \"Pool\"]' ELSE '[\"Wifi\"]' END"),
    ("host_verifications",
     "CASE WHEN o_orderkey % 17 = 0 THEN '[''email'', None]' WHEN o_orderkey % 19 = 0 THEN NULL "
     "WHEN o_orderkey % 3 = 0 THEN '[''email'', ''phone'', ''work_email'']' ELSE '[''email'', ''phone'']' END"),
    ("host_response_rate",
     "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE concat(cast(o_orderkey % 101 AS string), '%') END"),
    ("host_acceptance_rate",
     "CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE concat(cast((o_orderkey * 3) % 101 AS string), '%') END"),
    ("minimum_nights", "CASE WHEN o_orderkey % 997 = 0 THEN 400 ELSE 1 + o_orderkey % 30 END"),
    ("maximum_nights", "365 + (o_orderkey % 3) * 365"),
    ("bedrooms", "cast(o_orderkey % 5 AS double)"),
    ("beds", "cast(1 + o_orderkey % 4 AS double)"),
    ("accommodates", "1 + o_orderkey % 16"),
    ("latitude", "cast(-33.9 - (o_custkey % 100) * 0.002 - (o_orderkey % 13) * 0.0001 AS double)"),
    ("longitude", "cast(18.4 + (o_custkey % 100) * 0.003 + (o_orderkey % 17) * 0.0001 AS double)"),
    ("availability_365", "(o_orderkey * 7) % 366"),
    ("number_of_reviews", "CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE (o_orderkey * 13) % 60 END"),
    ("number_of_reviews_ltm", "CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE (o_orderkey * 5) % 20 END"),
    ("first_review",
     "CASE WHEN o_orderkey % 4 = 0 THEN NULL "
     "ELSE cast(cast(o_orderdate AS date) - cast(o_orderkey % 400 AS integer) AS string) END"),
    ("last_review",
     "CASE WHEN o_orderkey % 4 = 0 THEN NULL WHEN o_orderkey % 499 = 0 THEN 'unknown' "
     "ELSE cast(cast(o_orderdate AS date) AS string) END"),
    ("review_scores_rating", _RATING),
    ("review_scores_accuracy", _sub_score(3, 41)),
    ("review_scores_cleanliness", _sub_score(7, 61)),
    ("review_scores_checkin", _sub_score(11, 31)),
    ("review_scores_communication", _sub_score(13, 29)),
    ("review_scores_location", _sub_score(17, 97)),
    ("review_scores_value", _sub_score(19, 37)),
    ("calculated_host_listings_count", "host_listings"),
]

CALENDAR_COLUMNS: list[tuple[str, str]] = [
    ("listing_id", "l_orderkey"),
    ("date", "cast(cast(l_shipdate AS date) AS string)"),
    ("available", "CASE WHEN l_linestatus = 'O' THEN 't' ELSE 'f' END"),
    ("price", "cast(NULL AS string)"),
    ("adjusted_price", "cast(NULL AS string)"),
    ("minimum_nights", "cast(l_linenumber AS double)"),
    ("maximum_nights", "cast(CASE WHEN l_partkey % 500 = 0 THEN 0 ELSE 365 END AS double)"),
]

REVIEWS_COLUMNS: list[tuple[str, str]] = [
    ("listing_id", "l_orderkey"),
    ("id", "l_orderkey * 10 + l_linenumber"),
    ("date", "cast(cast(l_shipdate AS date) AS string)"),
    ("reviewer_id", "l_suppkey"),
    ("reviewer_name", "concat('Guest ', cast(l_suppkey AS string))"),
    ("comments",
     "CASE WHEN l_partkey % 50 = 0 THEN NULL WHEN l_partkey % 40 = 0 THEN 'ok' ELSE p_name END"),
]

NEIGHBOURHOODS_COLUMNS: list[tuple[str, str]] = [
    ("neighbourhood_group", "cast(NULL AS string)"),
    # one in six names is spelt differently from the listings, so the lookup
    # check (JOI8) finds mismatches in both directions
    ("neighbourhood",
     "CASE WHEN n_nationkey % 6 = 0 THEN replace(concat(upper(substr(n_name, 1, 1)), lower(substr(n_name, 2))), '_', ' ') "
     "ELSE concat(upper(substr(n_name, 1, 1)), lower(substr(n_name, 2))) END"),
]


def _select(cols: list[tuple[str, str]]) -> str:
    return ",\n  ".join(f"{e} AS {n}" for n, e in cols)


# SQL bodies (DuckDB and Spark SQL) of the four raw views.
LISTINGS_RAW_SQL = (
    "SELECT\n  " + _select(LISTINGS_COLUMNS) +
    "\nFROM orders JOIN customer ON o_custkey = c_custkey"
    "\nJOIN nation ON c_nationkey = n_nationkey"
    "\nJOIN (SELECT o_custkey AS hl_custkey, count(*) AS host_listings FROM orders GROUP BY o_custkey) hl"
    "\n  ON hl.hl_custkey = o_custkey")
CALENDAR_RAW_SQL = "SELECT\n  " + _select(CALENDAR_COLUMNS) + "\nFROM lineitem"
REVIEWS_RAW_SQL = ("SELECT\n  " + _select(REVIEWS_COLUMNS) +
                   "\nFROM lineitem JOIN part ON l_partkey = p_partkey")
NEIGHBOURHOODS_RAW_SQL = "SELECT\n  " + _select(NEIGHBOURHOODS_COLUMNS) + "\nFROM nation"

RAW_VIEWS_SQL = {
    "listings_raw": LISTINGS_RAW_SQL,
    "calendar_raw": CALENDAR_RAW_SQL,
    "reviews_raw": REVIEWS_RAW_SQL,
    "neighbourhoods_raw": NEIGHBOURHOODS_RAW_SQL,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _project(df: DataFrame, cols: list[tuple[str, str]]) -> DataFrame:
    return df.select(*[F.expr(e).alias(n) for n, e in cols])


def listings_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # listings per host: partial aggregation before the shuffle, so a host
    # holding a third of all orders costs one partial row per map task
    hl = o.groupBy(F.col("o_custkey").alias("hl_custkey")).agg(F.count(F.lit(1)).alias("host_listings"))
    base = (o.join(c, o.o_custkey == c.c_custkey)
             .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
             .join(hl, F.col("hl_custkey") == F.col("o_custkey")))
    # one small file is one task; the wide text expressions run in as many as there are shuffle partitions
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return _project(base.repartition(n, "o_orderkey"), LISTINGS_COLUMNS)


def calendar_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "lineitem"), CALENDAR_COLUMNS)


def reviews_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return _project(li.join(p, li.l_partkey == p.p_partkey), REVIEWS_COLUMNS)


def neighbourhoods_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _project(table(spark, sf_dir, "nation"), NEIGHBOURHOODS_COLUMNS)


RAW_BUILDERS = {
    "listings_raw": listings_raw,
    "calendar_raw": calendar_raw,
    "reviews_raw": reviews_raw,
    "neighbourhoods_raw": neighbourhoods_raw,
}
