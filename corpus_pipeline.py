"""The training-data pipeline: documents through five stages to packed token windows.

Each stage takes all that its predecessor kept, as a Parquet table in the shared folder, and its
decisions take effect: rejected and duplicate documents and boilerplate lines are gone, mixing leaves out or repeats
documents by their rates, and packing lays the rest into windows.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyspark.llm import exact_dedup, mixing, packing, quality_rules, simhash_dedup
from tallyspark.operators.materialize import materialize


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept, without boilerplate lines (operator 2)."""
    return quality_rules.clean(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the largest id (operator 10)."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component, the smallest id (operator 5)."""
    return simhash_dedup.keep_one(docs)


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rates say; the token total stays (operator 1)."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mixing.mix(docs, mixing.label_domain(labels))


def pack_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in windows (operator 8)."""
    packed = packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packed.withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_rules", keep_quality),
    ("exact_dedup", drop_exact_copies),
    ("simhash_dedup", drop_near_copies),
    ("source_mixing", mix_to_targets),
    ("packing", pack_windows),
]

# A SimHash component, a fitted classifier and a vocabulary are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        rows = materialize(stage(spark, rows, sf_dir))
    return rows


QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
