"""A training corpus from ``documents``: quality rules, line dedup, SimHash
near-dedup, mixing to source weights, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the
stage before kept; ``run`` writes each stage's result as Parquet in the shared
folder and reads it again.  A stage's edge cases are its operator's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from innsight.llm import lines, mixing, packing, quality, simhash
from innsight.llm.common import fresh, table, written
from innsight.llm.queries import KNOTS


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go, and documents that lose every line."""
    return lines.dedup(docs, drop_emptied=True)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays."""
    return simhash.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes, in training order."""
    return mixing.mix(docs, KNOTS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mixed documents with their token ids and places, and
    the position of their sequence in training, sorted by it."""
    (at,) = fresh(docs, "position")
    return packing.pack(mixing.positions(docs, KNOTS, at), order=at)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]
#: Fingerprints and token ids are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
