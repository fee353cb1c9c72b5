"""Bronze / Silver / Gold plans over one input folder.

``Lake`` builds each layer's DataFrame plan once (lazily) so several queries
share the same plans and the same eager scalars (price cap).  Silver and Gold
are Parquet tables in the shared folder, so what reads them prunes columns and
pushes filters down.  Silver tables are bucketed by the listing key, so the
facts' summaries and the Gold join need no exchange.  With a ``root`` each
layer is written there, once, and ``rows_in`` / ``rows_out`` tell how many
rows went in and out: the former from the count of keys that goes before the
buckets, the latter observed while writing.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import gold as G
from ..operators import silver as S
from ..operators import warehouse as W
from ..session import bucketed, materialize
from ..sources import fixtures as FX

_LAKES: dict[tuple[int, str], "Lake"] = {}


class Lake:
    def __init__(self, spark: SparkSession, sf_dir: str, root: str | None = None):
        self.spark, self.sf_dir, self.root = spark, sf_dir, root
        self.rows_in: dict[str, int] = {}
        self.rows_out: dict[str, int] = {}

    def _silver(self, name: str, df: DataFrame, key: str, counted: DataFrame, rows: Column) -> DataFrame:
        if self.root is None:
            return bucketed(df, key, counted=counted)
        obs = Observation(name)
        out = bucketed(df.observe(obs, rows.alias("rows")), key, counted=counted, path=f"{self.root}/silver/{name}",
                       seen=lambda n: self.rows_in.update({name: n}))
        self.rows_out[name] = int(obs.get["rows"])
        return out

    def _gold(self, name: str, df: DataFrame) -> DataFrame:
        if self.root is None:
            return materialize(df)
        obs = Observation(name)
        out = materialize(df.observe(obs, F.count(F.lit(1)).alias("rows")), f"{self.root}/gold/{name}")
        self.rows_out[name] = int(obs.get["rows"])
        return out

    # Bronze
    @cached_property
    def listings_raw(self) -> DataFrame:
        return FX.listings_raw(self.spark, self.sf_dir)

    @cached_property
    def calendar_raw(self) -> DataFrame:
        return FX.calendar_raw(self.spark, self.sf_dir)

    @cached_property
    def calendar_typed(self) -> DataFrame:
        """Every calendar row with its date typed, before the Silver filter."""
        return self.calendar_raw.withColumn("date", F.col("date").try_cast("date"))

    @cached_property
    def reviews_raw(self) -> DataFrame:
        return FX.reviews_raw(self.spark, self.sf_dir)

    @cached_property
    def neighbourhoods_raw(self) -> DataFrame:
        return FX.neighbourhoods_raw(self.spark, self.sf_dir)

    # Silver
    @cached_property
    def priced(self) -> DataFrame:
        """The listings with a valid price, every other column raw."""
        return S.priced_listings(self.listings_raw, lambda n: self.rows_in.update(listings_raw=n))

    @cached_property
    def listings(self) -> DataFrame:
        return self._silver("listings", S.finish_listings(self.priced), "id", self.priced, F.count(F.lit(1)))

    @cached_property
    def calendar(self) -> DataFrame:
        return self._silver("calendar", S.clean_calendar(self.calendar_raw), "listing_id", self.calendar_raw, F.count(F.lit(1)))

    @cached_property
    def reviews_flagged(self) -> DataFrame:
        return self._silver("reviews", S.flag_reviews(self.reviews_raw), "listing_id", self.reviews_raw, F.count_if(~F.col("is_low_quality")))

    @cached_property
    def reviews(self) -> DataFrame:
        return self.reviews_flagged.where(~F.col("is_low_quality"))

    # Gold
    @cached_property
    def review_summary(self) -> DataFrame:
        return G.review_summary(self.reviews_flagged)

    @cached_property
    def calendar_summary(self) -> DataFrame:
        return G.calendar_summary(self.calendar)

    @cached_property
    def neighbourhoods(self) -> DataFrame:
        return self._gold("neighbourhood_aggregates", G.neighbourhood_aggregates(self.listings))

    @cached_property
    def gold(self) -> DataFrame:
        return self._gold("listing_master", G.build_master(self.listings, self.review_summary, self.calendar_summary, self.neighbourhoods))

    @cached_property
    def dim_date(self) -> DataFrame:
        return W.dim_date(self.calendar)

    @cached_property
    def eda(self) -> DataFrame:
        """Gold without price outliers (FLT4), the base of the EDA notebooks."""
        return self.gold.where(~F.col("is_price_outlier"))

    def warehouse(self) -> dict[str, DataFrame]:
        return W.star_schema(self.gold, self.calendar, self.reviews)


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    """Shared plans per (session, folder); rebuilt for a new or stopped session."""
    key = (id(spark), sf_dir)
    cur = _LAKES.get(key)
    if cur is None or cur.spark is not spark:
        _LAKES[key] = Lake(spark, sf_dir)
    return _LAKES[key]
