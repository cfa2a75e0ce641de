"""From documents to shards: quality rules, near-duplicates, decontamination, mixing, sharding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexspark.llm import decontamination, mixing, quality, rendezvous, simhash
from lexspark.plans.lineage import cut_lineage


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie in their language's perplexity band."""
    return quality.passing(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near-duplicates."""
    return simhash.deduplicated(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every document of the mix in the shards."""
    return rendezvous.shard_rows(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
    ("sharding", sharding_stage),
]

# the language model and the fingerprints cannot be said in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``; each stage's are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
