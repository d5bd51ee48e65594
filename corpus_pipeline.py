"""Corpus pipeline: quality rules, near-duplicates, personal data, mixing, packing; each stage works on what the last kept."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from harborline.llm import mixing, near_dedup, packing, private, quality
from harborline.llm.store import written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass all rules of the policy."""
    return quality.passing(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return near_dedup.without_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked and n_chars counted anew."""
    return private.mask(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, as often as it takes them, in mixed order."""
    return mixing.mix(docs).select(docs.columns)


def pack_lengths(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with bucket, batch, slot and padding."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix_sources", mix_sources),
    ("pack_lengths", pack_lengths),
]

#: Near-duplicates (components) and packing (dynamic programming, tokens) are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
