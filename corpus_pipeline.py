"""The corpus pipeline: quality, near-dedup, decontamination, mixing, sharding.

Every stage takes (spark, docs, sf_dir), works on all its predecessor kept, and gives a DataFrame that is
written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyseq.llm import benchmark_leaks, jump_sharding, mixing, simhash_vptree, site_quality
from tallyseq.session import delete, scratch, shared_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the site-aware classifier rejects go."""
    return site_quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays.

    Three bits of one 3-word fingerprint find few copies at a five-word similarity of 0.8, so the stage
    takes distinct words as features and several tables: three bits in any, and a close match over all.
    These links are candidates; a document goes only by links at an exact five-word Jaccard of 0.8.
    """
    return simhash_vptree.keep_one(docs, size=0, tables=8, radius=3, total=96, min_jaccard=0.8)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return benchmark_leaks.drop_leaking(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target weight asks."""
    return mixing.repeat_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with all its columns, its shard and its slot there."""
    return jump_sharding.place_rows(docs)


STAGES = [
    ("quality classifier", quality),
    ("simhash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing to weights", mix),
    ("jump sharding", shard),
]
#: The classifier's fit, XXH64 fingerprints and component search have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; the result is written by shard. What a stage leaves besides its output is deleted, and so
    is its input, once its output is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = shared_path(spark, name.replace(" ", "-"))
        with scratch(spark):
            out = stage(spark, docs, sf_dir)
            by = ["shard"] if stage is shard else []
            out.write.partitionBy(*by).parquet(path)
        if before:
            delete(spark, before)
        docs, before = spark.read.schema(out.schema).parquet(path), path
    return docs
