"""Named queries: a Spark plan per inventory item plus its DuckDB oracle.

Each entry is ``name -> (builder(spark, sf_dir) -> DataFrame, oracle SQL or
None)``.  Builders read the driver's tables through ``Lake`` (so their work
grows with the tables) and finish by rounding double columns to 6 decimals;
the oracle SQL rounds the same columns (``oracle.rounded``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import compiled, ship_package
from .lake import lake

Builder = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f"`{f.name}`"), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def register(name: str, oracle: str | None = None):
    """Decorator: ``fn(lake) -> DataFrame`` becomes a registered query."""
    def deco(fn):
        def builder(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            with compiled(spark):  # layers and whatever else is written or looked up on the way
                return finish(fn(lake(spark, sf_dir)))
        builder.__name__ = f"q_{name}"
        builder.__doc__ = fn.__doc__
        REGISTRY[name] = (builder, oracle)
        return fn
    return deco


def load_all() -> dict[str, tuple[Builder, str | None]]:
    # importing the modules fills REGISTRY
    from . import q_core, q_quality, q_analytics, q_stats, q_stream  # noqa: F401
    return REGISTRY
