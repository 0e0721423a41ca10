"""Registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (chosen_path, collocations, latent, license_scan, line_dedup, merkle, mixing, quality, sharding, simhash,
               suffix_dedup, token_files, url_filter)
from .oracles import ORACLES


__all__ = ["ORACLES", "QUERIES"]


def _over(table: str, report: Callable[[DataFrame], DataFrame]):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return report(spark.read.parquet(f"{folder}/{table}.parquet"))
    return query


def _tokens(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers
    return token_files.token_report(spark.read.parquet(f"{folder}/documents.parquet"),
                                    public_tokenizers.path("byte_bpe_50k.json"))


def _leaks(spark: SparkSession, folder: str) -> DataFrame:
    return latent.leak_report(spark.read.parquet(f"{folder}/documents.parquet"),
                              spark.read.parquet(f"{folder}/benchmark.parquet"))


def _quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_report(spark.read.parquet(f"{folder}/documents.parquet"),
                                  spark.read.parquet(f"{folder}/labels.parquet"))


QUERIES = {
    "op1_url_filter": _over("pages", url_filter.page_verdicts),
    "op2_decontamination": _leaks,
    "op3_simhash": _over("documents", simhash.simhash_report),
    "op4_token_files": _tokens,
    "op5_suffix_dedup": _over("documents", suffix_dedup.suffix_report),
    "op6_quality_rules": _quality,
    "op7_line_dedup": _over("documents", line_dedup.line_report),
    "op8_mixing": _over("documents", mixing.mix_report),
    "op9_license_scan": _over("documents", license_scan.license_report),
    "op10_sharding": _over("documents", sharding.shard_report),
    "op11_merkle_manifest": _over("documents", merkle.manifest_report),
    "op12_collocations": _over("documents", collocations.collocation_report),
    "op13_minhash": _over("documents", chosen_path.similar_report),
}
