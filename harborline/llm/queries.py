"""The subpackage's entries for the driver: queries by name, and SQL where SQL can express them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from harborline.llm import imatch, infill, lexical, mixing, near_dedup, packing, private, quality, quotes, rans, secrets, sharding, substrings


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.find_secrets(_table(spark, sf_dir, "documents")))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(substrings.remove_repeats(_table(spark, sf_dir, "documents")))


def op3_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.digest(private.find_private(_table(spark, sf_dir, "documents")))


def op4_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.digest(imatch.edited_neighbours(_table(spark, sf_dir, "documents")))


def op5_length_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(_table(spark, sf_dir, "documents")))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(quality.ledger(_table(spark, sf_dir, "documents")))


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.digest(near_dedup.near_duplicates(_table(spark, sf_dir, "documents")))


def op8_rans_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rans.read_ids(*rans.write_ids(_table(spark, sf_dir, "documents")))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(mixing.schedule(_table(spark, sf_dir, "documents")))


def op10_quotation_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.reply_ordered(_table(spark, sf_dir, "conversations"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(_table(spark, sf_dir, "documents"))


def op13_duckdb_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digest(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_private_data": op3_private_data,
    "op4_imatch_fingerprints": op4_imatch_fingerprints,
    "op5_length_packing": op5_length_packing,
    "op6_quality_rules": op6_quality_rules,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_rans_token_ids": op8_rans_token_ids,
    "op9_mix_sources": op9_mix_sources,
    "op10_quotation_chats": op10_quotation_chats,
    "op11_ranked_search": op11_ranked_search,
    "op12_minimax_shards": op12_minimax_shards,
    "op13_duckdb_infill": op13_duckdb_infill,
}

ORACLE_SQL: dict[str, str] = {
    "op6_quality_rules": quality.ORACLE_SQL,
    "op9_mix_sources": mixing.ORACLE_SQL,
    "op11_ranked_search": lexical.ORACLE_SQL,
    "op13_duckdb_infill": infill.ORACLE_SQL,
}
