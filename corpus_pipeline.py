"""A corpus pipeline: rules, near-duplicates, benchmark leaks, mix, shards.

Each stage takes ``(spark, docs, sf_dir)`` and returns the rows it keeps; what it returns
is written as Parquet and read again as the next one's ``docs``. The mix is the order of
the rows in the files it is written to; sharding numbers a shard's slots in that order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerwatch.llm import latent, mixing, quality, sharding, simhash
from ledgerwatch.llm.common import staged

#: Sources and their parts of the mix.
TARGETS = mixing.TARGETS
SHARDS = sharding.SHARDS


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the certified cutoffs."""
    return quality.good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return latent.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix."""
    return mixing.mixed(docs, TARGETS)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with ``shard`` and ``slot``; slots follow the mix."""
    ordered = mixing.written_order(docs)
    return sharding.shard_documents(ordered, SHARDS, ("__lw_file", "__lw_row")).drop(
        "__lw_file", "__lw_row")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
    ("shards", shards),
]

#: Learned cutoffs, fingerprint groups and latent search are beyond SQL; the tests
#: compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
